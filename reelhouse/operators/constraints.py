"""What a database would enforce on the warehouse tables, as counts, as a failing write, or both."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.schemas import RAW_TYPES, TABLES, Table

_SHORT_MIN, _SHORT_MAX = -(2**15), 2**15 - 1


def _finding(table: str, rule: str, columns: str, violations: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.lit(columns).alias("columns"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
    )


def _row_checks(name: str, table: Table) -> list[tuple[str, str, Column]]:
    """(rule, column, predicate of a bad row)."""
    checks = []
    for f in table.columns:
        if not f.nullable:
            checks.append(("not_null", f.name, F.col(f.name).isNull()))
        if isinstance(f.dataType, T.VarcharType):
            n = f.dataType.length
            checks.append((f"varchar({n})", f.name, F.length(f.name) > n))
        if isinstance(f.dataType, T.ShortType):
            checks.append(("smallint", f.name, ~F.col(f.name).between(_SHORT_MIN, _SHORT_MAX)))
    return checks


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Values of `column` that more than one row holds, with their count."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


Link = tuple[str, str, str, str]  # child, its column, parent, its key


def key_counts(
    tables: dict[str, DataFrame], unique: Sequence[tuple[str, str]], links: Sequence[Link]
) -> DataFrame:
    """One row: `u<i>`, the values that more than one row holds in `unique[i]` (table, column), and `o<i>`, the
    rows of the child of `links[i]` whose value is no key of the parent; NULL refers to nothing.

    Each table is read once, and gives a row for every part one of its columns plays, as a key or as a
    reference. One grouping by key, counted before the shuffle, meets them all, so that a value held by very
    many rows counts once per task.
    """
    keys = list(dict.fromkeys([*unique, *[(parent, key) for *_, parent, key in links]]))
    tags = {key: i for i, key in enumerate(keys)}
    roles: dict[str, list[tuple[int, int, str]]] = {}
    for (name, column), tag in tags.items():
        roles.setdefault(name, []).append((tag, -1, column))
    for i, (child, column, parent, key) in enumerate(links):
        roles.setdefault(child, []).append((tags[parent, key], i, column))
    kinds = {tables[name].schema[column].dataType.simpleString() for name, told in roles.items() for *_, column in told}
    kind = kinds.pop() if len(kinds) == 1 else "string"
    parts = []
    for name, told in roles.items():
        played = [
            F.when(F.col(column).isNotNull() | F.lit(role < 0), F.struct(
                F.lit(tag).alias("tag"), F.lit(role).alias("role"), F.col(column).cast(kind).alias("value")))
            for tag, role, column in told
        ]
        # NULLs go behind the generator: filtering the array by a lambda is not compiled and takes longer
        parts.append(tables[name].select(F.inline(F.array(*played))).filter(F.col("tag").isNotNull()))
    counted = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("tag", "value")
        .agg(
            F.count_if(F.col("role") < 0).alias("held"),
            *[F.count_if(F.col("role") == i).alias(f"c{i}") for i in range(len(links))],
        )
    )
    tag, held = F.col("tag"), F.col("held")
    return counted.agg(
        *[F.count_if((tag == tags[key]) & (held > 1)).alias(f"u{i}") for i, key in enumerate(unique)],
        *[
            F.coalesce(F.sum(F.when((tag == tags[parent, key]) & (held == 0), F.col(f"c{i}"))), F.lit(0)).alias(f"o{i}")
            for i, (*_, parent, key) in enumerate(links)
        ],
    )


def check_constraints(
    tables: dict[str, DataFrame],
    kinds: Sequence[str] = ("rows", "unique", "references"),
    spec: dict[str, Table] = TABLES,
) -> DataFrame:
    """table_name, rule, columns, violations; one row per constraint of the tables given.

    Violations are rows for row checks and references, and key values for uniqueness. All row checks of
    a table share one pass, and all keys and references of all tables share another.
    """
    parts, unique, links = [], [], []
    for name, df in tables.items():
        table = spec[name]
        checks = _row_checks(name, table) if "rows" in kinds else []
        if checks:
            counts = [F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(checks)]
            found = [
                _finding(name, rule, column, F.col(f"v{i}"))
                for i, (rule, column, _) in enumerate(checks)
            ]
            parts.append(df.agg(*counts).select(F.inline(F.array(*found))))
        unique += [(name, column) for column in table.unique if "unique" in kinds]
        links += [
            (name, column, parent, "id")
            for column, parent in table.references.items()
            if "references" in kinds and parent in tables
        ]
    if unique or links:
        found = [_finding(name, "unique", column, F.col(f"u{i}")) for i, (name, column) in enumerate(unique)]
        found += [
            _finding(child, f"references {parent}", column, F.col(f"o{i}"))
            for i, (child, column, parent, _) in enumerate(links)
        ]
        parts.append(key_counts(tables, unique, links).select(F.inline(F.array(*found))))
    if not parts:
        raise ValueError("no constraint to check")
    return reduce(DataFrame.unionByName, parts)


def orphan_report(tables: dict[str, DataFrame], links: Sequence[Link]) -> DataFrame:
    """child, columns, parent, orphans for each link (child, its column, parent, its key); every table is
    read once."""
    found = [
        F.struct(
            F.lit(child).alias("child"),
            F.lit(column).alias("columns"),
            F.lit(parent).alias("parent"),
            F.col(f"o{i}").cast("bigint").alias("orphans"),
        )
        for i, (child, column, parent, _) in enumerate(links)
    ]
    return key_counts(tables, [], links).select(F.inline(F.array(*found)))


def cast_losses(files: dict[str, DataFrame], types: dict[str, dict[str, str]] = RAW_TYPES) -> DataFrame:
    """table_name, column_name, type, present, lost for the typed columns of decoded raw files.

    `lost` counts values that are there as text and NULL once cast. One pass per file.
    """
    parts = []
    for name, df in files.items():
        kinds = types[name]
        known = [F.count(c).alias(f"p{i}") for i, c in enumerate(kinds)]
        gone = [
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"l{i}")
            for i, (c, t) in enumerate(kinds.items())
        ]
        found = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.lit(t).alias("type"),
                F.col(f"p{i}").alias("present"),
                F.col(f"l{i}").alias("lost"),
            )
            for i, (c, t) in enumerate(kinds.items())
        ]
        parts.append(df.agg(*known, *gone).select(F.inline(F.array(*found))))
    return reduce(DataFrame.unionByName, parts)


def require_not_null(df: DataFrame, columns: Sequence[str], label: str = "table") -> DataFrame:
    """The same rows; reading one with a NULL in `columns` fails the job."""
    return df.select(
        *[
            F.coalesce(F.col(c), F.raise_error(F.lit(f"{label}.{c} is null"))).alias(c)
            if c in columns
            else F.col(c)
            for c in df.columns
        ]
    )


def conform(df: DataFrame, name: str, spec: dict[str, Table] = TABLES) -> DataFrame:
    """Columns and types of a warehouse table. A value that does not fit fails the job."""

    def fit(field: T.StructField) -> Column:
        c, label = F.col(field.name), f"{name}.{field.name}"
        if isinstance(field.dataType, T.VarcharType):
            value = c.cast("string")
            unfit = F.length(value) > field.dataType.length
        else:
            value = c.try_cast(field.dataType)
            unfit = c.isNotNull() & value.isNull()
        value = F.when(unfit, F.raise_error(F.lit(f"{label} does not fit its type"))).otherwise(value)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"{label} is null")))
        return value.alias(field.name)

    return df.select(*[fit(f) for f in spec[name].columns])
