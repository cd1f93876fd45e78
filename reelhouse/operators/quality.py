"""Suites compiled to aggregations: one scan for all rules of a suite, and one shuffle if any asks for uniqueness."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.functions.columns import decode
from reelhouse.operators.joins import HOT_ROWS, hottest, skew_join

_GROUPED = ("unique", "unique_together")


def _columns(rule: dict) -> list[str]:
    return list(rule.get("columns") or [rule["column"]])


def _value(rule: dict, sentinel_is_null: bool) -> Column:
    """The value a rule looks at; range rules see the marker as missing in any case."""
    c = F.col(rule["column"])
    return decode(c.cast("string")) if sentinel_is_null or rule["type"] == "between" else c


def _unexpected(rule: dict, sentinel_is_null: bool = False) -> Column:
    """True for a row that breaks a row rule; NULL values break `not_null` only."""
    kind, value = rule["type"], _value(rule, sentinel_is_null)
    if kind == "not_null":
        return value.isNull()
    if kind in ("matches", "matches_any"):
        tests = rule.get("regexes") or [rule["regex"]]
        broken = ~reduce(or_, [value.rlike(t) for t in tests])
    elif kind == "between":
        number = value.try_cast("decimal(38,10)")
        broken = _outside(number, rule, lambda bound: F.lit(Decimal(str(bound)))) | number.isNull()
    elif kind == "length_between":
        broken = _outside(F.length(value), rule, F.lit)
    elif kind == "distinct_set":
        broken = ~value.isin(*rule["members"])
    else:
        raise ValueError(f"no row rule: {kind!r}")
    return value.isNotNull() & broken


def _outside(number: Column, rule: dict, literal) -> Column:
    tests = [F.lit(False)]
    if rule.get("min") is not None:
        tests.append(number < literal(rule["min"]))
    if rule.get("max") is not None:
        tests.append(number > literal(rule["max"]))
    return reduce(or_, tests)


def _result(
    suite: str,
    position: int,
    rule: dict,
    elements: Column,
    missing: Column,
    unexpected: Column,
    absent: Column,
    success: Column,
) -> Column:
    judged = elements if rule["type"] == "not_null" else elements - missing
    percent = (unexpected * 100).cast("double") / F.nullif(judged, F.lit(0)).cast("double")
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(position).alias("position"),
        F.lit(rule["type"]).alias("expectation"),
        F.lit(",".join(_columns(rule))).alias("columns"),
        elements.cast("bigint").alias("element_count"),
        missing.cast("bigint").alias("missing_count"),
        unexpected.cast("bigint").alias("unexpected_count"),
        percent.alias("unexpected_percent"),
        absent.cast("bigint").alias("absent_members"),
        success.alias("success"),
    )


def _planned(columns: Sequence[str], suite: str, rules: Sequence[dict]) -> tuple[dict[int, dict], list[Column]]:
    """The rules that have values to look at, by position, and a result for every rule from their measures."""
    none = F.lit(None).cast("bigint")
    judged, rows = {}, []
    for position, rule in enumerate(rules, 1):
        present = all(c in columns for c in _columns(rule))
        if rule["type"] == "column_exists" or not present:
            rows.append(_result(suite, position, rule, none, none, none, none, F.lit(present)))
            continue
        judged[position] = rule
        absent, success = none, F.col(f"u{position}") == 0
        if rule["type"] == "distinct_set":
            absent = F.col(f"a{position}")
            success = success & (absent == 0)
        rows.append(
            _result(
                suite, position, rule, F.col("elements"),
                F.col(f"m{position}"), F.col(f"u{position}"), absent, success,
            )
        )
    return judged, rows


def _run_suite(df: DataFrame, suite: str, rules: Sequence[dict], sentinel_is_null: bool) -> DataFrame:
    judged, rows = _planned(df.columns, suite, rules)
    if any(rule["type"] in _GROUPED for rule in judged.values()):
        measured = _by_events(df, judged, sentinel_is_null)
    else:
        measured = df.agg(*_row_measures(judged, sentinel_is_null))
    return measured.select(F.inline(F.array(*rows)))


def _row_measures(rules: dict[int, dict], sentinel_is_null: bool) -> list[Column]:
    """elements, and m, u, a with the position of each rule: aggregates that need no shuffle of any row."""
    return _measures(rules, _row_tests(rules, sentinel_is_null))


def _row_tests(rules: dict[int, dict], sentinel_is_null: bool, among: Column | None = None) -> dict[str, Column]:
    """What `_measures` counts, as tests of a row; only rows `among` (all, if None) pass them."""
    among = F.lit(True) if among is None else among
    tests = {"elements": among}
    for position, rule in rules.items():
        value = _value(rule, sentinel_is_null)
        tests[f"m{position}"] = among & value.isNull()
        tests[f"u{position}"] = among & _unexpected(rule, sentinel_is_null)
        if rule["type"] == "distinct_set":
            tests |= {f"s{position}_{i}": among & (value == m) for i, m in enumerate(rule["members"])}
    return tests


def _measures(rules: dict[int, dict], tests: dict[str, Column]) -> list[Column]:
    measures = [F.count_if(tests["elements"]).alias("elements")]
    for position, rule in rules.items():
        measures += [F.count_if(tests[name]).alias(name) for name in (f"m{position}", f"u{position}")]
        if rule["type"] == "distinct_set":
            held = [tests[f"s{position}_{i}"] for i in range(len(rule["members"]))]
            seen = [F.coalesce(F.max(test.cast("int")), F.lit(0)) for test in held]
            measures.append((len(seen) - sum(seen[1:], seen[0])).alias(f"a{position}"))
    return measures


class Watch:
    """Rules judged while rows pass on their way to a table, without a scan of their own.

    `over` gives the rows on unchanged, to be written once; then `results` has what `run_suites` tells of
    them, without run and time. Rules that compare rows (uniqueness) need a shuffle and are refused. One watch
    serves one write; a write that breaks off leaves it without results.
    """

    def __init__(self, suite: str, rules: Sequence[dict], sentinel_is_null: bool = False):
        if any(rule["type"] in _GROUPED for rule in rules):
            raise ValueError("uniqueness is judged by run_suites")
        self.suite, self.rules, self.sentinel_is_null = suite, list(rules), sentinel_is_null
        self._seen, self._columns = Observation(), None

    def over(self, df: DataFrame, among: Column | None = None) -> DataFrame:
        """The rows of `df`, those `among` being judged."""
        self._columns = df.columns
        judged, _ = _planned(df.columns, self.suite, self.rules)
        # the tests are columns for a moment, as Spark compiles a projection, while it interprets what is observed
        tests = {f"_test_{name}": test for name, test in _row_tests(judged, self.sentinel_is_null, among).items()}
        measures = _measures(judged, {name.removeprefix("_test_"): F.col(name) for name in tests})
        return df.withColumns(tests).observe(self._seen, *measures).drop(*tests)

    def wait(self) -> None:
        """Return once the measures of the write have arrived."""
        _ = self._seen.get

    def results(self, spark: SparkSession) -> DataFrame:
        """A row per rule; waits for the write to end."""
        if self._columns is None:
            raise ValueError("nothing was watched")
        _, rows = _planned(self._columns, self.suite, self.rules)
        counted = [F.lit(n).cast("bigint").alias(name) for name, n in self._seen.get.items()]
        return spark.range(1).select(*counted).select(F.inline(F.array(*rows)))


def row_rules(rules: Sequence[dict]) -> list[dict]:
    """The rules of a suite that look at one row at a time, as a watch takes them."""
    return [rule for rule in rules if rule["type"] not in _GROUPED]


def _key_text(c: Column, kind: T.DataType) -> Column:
    """A value as text that differs whenever the values do."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0.0)).cast("string")  # 0 and -0 are one value
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


_KEY, _MISSING, _UNEXPECTED, _MEMBER = range(4)  # kinds of events


def _told(df: DataFrame, events: Sequence[Column]) -> DataFrame:
    """The events of all rows, where an event is a struct with a position, or NULL where a row has none. These
    are left out behind the generator, as filtering the array by a lambda is not compiled and takes longer."""
    return df.select(F.inline(F.array(*events))).filter(F.col("position").isNotNull())


def _by_events(df: DataFrame, rules: dict[int, dict], sentinel_is_null: bool) -> DataFrame:
    """The same where keys have to be compared: rows become events, and one grouping counts them all.

    An event is a key that a uniqueness rule looks at, a value that is missing or unexpected, or a member of
    a set that is there. All but the keys come down to a few groups before the shuffle, and so does a key
    held by very many rows. Every row has a key or a missing one for each uniqueness rule, so these count the rows.
    """
    grouped = [position for position, rule in rules.items() if rule["type"] in _GROUPED]
    width = max(len(_columns(rules[position])) for position in grouped)

    def event(position: int, kind: int, *keys: Column) -> Column:
        text = [*keys, *[F.lit(None).cast("string")] * (width - len(keys))]
        return F.struct(
            F.lit(position).alias("position"), F.lit(kind).alias("kind"), *[k.alias(f"k{i}") for i, k in enumerate(text)]
        )

    events, counted = [], [(_sum_of(grouped[0], _KEY) + _sum_of(grouped[0], _MISSING)).alias("elements")]
    for position, rule in rules.items():
        missing, unexpected = _sum_of(position, _MISSING), _sum_of(position, _UNEXPECTED)
        if rule["type"] in _GROUPED:
            held = [decode(F.col(c).cast("string")) if sentinel_is_null else F.col(c) for c in _columns(rule)]
            kinds = [T.StringType() if sentinel_is_null else df.schema[c].dataType for c in _columns(rule)]
            known = reduce(or_, [c.isNotNull() for c in held])
            keys = [_key_text(c, kind) for c, kind in zip(held, kinds)]
            events.append(F.when(known, event(position, _KEY, *keys)).otherwise(event(position, _MISSING)))
            unexpected = _sum_of(position, _KEY, F.col("n") > 1)
        else:
            value = _value(rule, sentinel_is_null)
            events.append(F.when(value.isNull(), event(position, _MISSING)))
            events.append(F.when(_unexpected(rule, sentinel_is_null), event(position, _UNEXPECTED)))
        if rule["type"] == "distinct_set":
            events.append(F.when(value.isin(*rule["members"]), event(position, _MEMBER, value.cast("string"))))
            seen = F.count_if((F.col("position") == position) & (F.col("kind") == _MEMBER))
            counted.append((len(set(rule["members"])) - seen).alias(f"a{position}"))
        counted += [missing.alias(f"m{position}"), unexpected.alias(f"u{position}")]
    told = _told(df, events)
    return told.groupBy(*told.columns).agg(F.count(F.lit(1)).alias("n")).agg(*counted)


def _sum_of(position: int, kind: int, also: Column | None = None) -> Column:
    fits = (F.col("position") == position) & (F.col("kind") == kind)
    return F.coalesce(F.sum(F.when(fits if also is None else fits & also, F.col("n"))), F.lit(0))


def run_suites(
    batches: dict[str, DataFrame],
    suites: dict[str, Sequence[dict]],
    run_name: str,
    run_time: datetime.datetime,
    sentinel_is_null: bool = False,
) -> DataFrame:
    """One row per expectation of every suite that has a batch. Broken rules are reported, not raised.

    element_count, missing_count and unexpected_count are rows; unexpected_percent refers to the rows
    that were judged; absent_members are the members of a required set that no row holds. A rule on a
    column that the batch lacks fails with empty counts.
    """
    results = [
        _run_suite(batch, name, suites[name], sentinel_is_null)
        for name, batch in batches.items()
        if suites.get(name)
    ]
    if not results:
        raise ValueError("no suite has a batch")
    return reduce(DataFrame.unionByName, results).select(
        F.lit(run_name).alias("run_name"), F.lit(run_time).alias("run_time"), "*"
    )


def examples(
    batches: dict[str, DataFrame],
    suites: dict[str, Sequence[dict]],
    most: int = 20,
    sentinel_is_null: bool = False,
) -> DataFrame:
    """The `most` most frequent unexpected values of every rule: suite, position, expectation, columns, place
    (from 1), value as text, and rows, how many hold it; values of equal frequency come in their order.

    For uniqueness rules these are the values that several rows share, of several columns as a JSON array.
    Rules on missing values or columns have none. Each batch is read once; values are counted before they are
    shuffled, and each task hands on `most` of them per rule at most.
    """
    told = [_unexpected_values(batch, name, suites[name], sentinel_is_null) for name, batch in batches.items() if suites.get(name)]
    if not told:
        raise ValueError("no suite has a batch")
    best = W.partitionBy("suite", "position").orderBy(F.col("rows").desc(), "value")
    ranked = reduce(DataFrame.unionByName, told).withColumn("place", F.row_number().over(best))
    rules = {name: suites[name] for name in batches if suites.get(name)}
    expectation = _of_rule(rules, lambda rule: rule["type"])
    columns = _of_rule(rules, lambda rule: ",".join(_columns(rule)))
    return ranked.filter(F.col("place") <= most).select(
        "suite", "position", expectation.alias("expectation"), columns.alias("columns"), "value", "rows", "place"
    )


def _of_rule(suites: dict[str, Sequence[dict]], told: Callable[[dict], str]) -> Column:
    """What is told of the rule at `suite` and `position`."""
    listed = [F.array(*[F.lit(told(rule)) for rule in rules]) for rules in suites.values()]
    of_suite = [F.when(F.col("suite") == name, F.element_at(x, F.col("position"))) for name, x in zip(suites, listed)]
    return F.coalesce(*of_suite)


def _unexpected_values(df: DataFrame, suite: str, rules: Sequence[dict], sentinel_is_null: bool) -> DataFrame:
    """Every unexpected value of a batch with the position of its rule and the number of rows."""
    events, shared = [F.lit(None).cast("struct<position:int,value:string>")], []
    for position, rule in enumerate(rules, 1):
        columns = _columns(rule)
        if rule["type"] in ("column_exists", "not_null") or any(c not in df.columns for c in columns):
            continue
        if rule["type"] in _GROUPED:
            shared.append(position)
            held = [decode(F.col(c).cast("string")) if sentinel_is_null else F.col(c) for c in columns]
            kinds = [T.StringType() if sentinel_is_null else df.schema[c].dataType for c in columns]
            texts = [_key_text(c, kind) for c, kind in zip(held, kinds)]
            broken = reduce(or_, [c.isNotNull() for c in held])
            value = texts[0] if len(texts) == 1 else F.to_json(F.array(*texts), {"ignoreNullFields": "false"})
        else:
            broken, value = _unexpected(rule, sentinel_is_null), _value(rule, sentinel_is_null).cast("string")
        events.append(F.when(broken, F.struct(F.lit(position).alias("position"), value.alias("value"))))
    counted = _told(df, events).groupBy("position", "value").agg(F.count(F.lit(1)).alias("rows"))
    counted = counted.filter((F.col("rows") > 1) | ~F.col("position").isin(*shared))
    return counted.select(F.lit(suite).alias("suite"), "position", "value", "rows")


def failing_rows(
    df: DataFrame, rule: dict, sentinel_is_null: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The rows that break one rule. A key held by very many rows is split over tasks."""
    if rule["type"] not in _GROUPED:
        return df.filter(_unexpected(rule, sentinel_is_null))
    columns = _columns(rule)
    held = [decode(F.col(c).cast("string")) if sentinel_is_null else F.col(c) for c in columns]
    judged = reduce(or_, [c.isNotNull() for c in held])
    keyed = df.filter(judged).withColumn("_key", F.struct(*held))
    shared = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1)
    hot = hottest(shared, "_key", "_rows", hot_rows)
    return skew_join(keyed, shared.select("_key"), "_key", hot).select(*df.columns)


def store_results(results: DataFrame, path: str) -> None:
    """Append results to the results table."""
    results.withColumn("run_date", F.to_date("run_time")).write.mode("append").partitionBy(
        "run_date"
    ).parquet(path)
