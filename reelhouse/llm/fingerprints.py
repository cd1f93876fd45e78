"""Document fingerprints that can be subtracted: invertible Bloom lookup tables over paragraph digests.

A text is the set of 64-bit digests of its paragraphs. Each digest goes to one cell in each of three
sub-tables; a cell holds a count and the XOR of its digests and of their check values. The cells of two
versions subtract, which cancels what both have. In what is left, a cell with a single digest gives it
away; taking it out of its other cells sets more free. If cells are left over at the end, the tables were
too small for the difference and are made anew, twice as large.

All of this is grouping: cells are rows, subtracting is a sum, and a step of peeling handles one sub-table,
in which no digest can turn up twice. As rows are dealt out by document beforehand, no step shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.llm.common import kept, read, spread

TABLES = 3
SMALL = 8  # cells of a sub-table of the fingerprint, the fewest of any
PIECE = 400  # characters; longer paragraphs are cut into such pieces
STEPS = 9  # of peeling
TRIES = 6


def digests(text: Column) -> Column:
    """The distinct digests of the paragraphs: lines, cut further after the ends of sentences or cells."""
    parts = F.split(text, r"\n+|(?<=[.!?…|])\s+")
    cut = F.transform(
        F.transform(parts, F.trim),
        lambda p: F.when(F.length(p) <= PIECE, F.array(p)).otherwise(
            F.regexp_extract_all(p, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
        ),
    )
    some = F.filter(F.flatten(cut), lambda p: p != "")
    return F.array_distinct(F.transform(some, lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def _cell(digest: Column, table: int, size: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(salt * TABLES + table)), size).cast("int") + table * size


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check")
    )


def cells(rows: DataFrame, by: list[str], salt: int = 0) -> DataFrame:
    """Cells of `rows` (`by`, `size`, `digest`, `n`): one row per `by`, `size` and `cell`, with the sums."""
    at = [_cell(F.col("digest"), t, F.col("size"), salt) for t in range(TABLES)]
    placed = rows.select(
        *by, "size", F.explode(F.array(*at)).alias("cell"), "n", "digest", _check(F.col("digest")).alias("check")
    )
    return _summed(placed, [*by, "size", "cell"])


def peel(table: DataFrame, by: list[str], salt: int = 0, listed: bool = True) -> DataFrame:
    """What is in subtracted cells: rows of `by`, `cell` -1, `found`, a digest, and `n`, 1 if the first
    version alone has it and -1 if the second. Rows with another `cell` could not be peeled. Unless
    `listed`, there is one row of `cell` -1 for all digests, and `n` is their number."""
    rows = table.withColumn("found", F.lit(None).cast("long"))
    keys = [*by, "size", "cell", "found"]
    for step in range(STEPS):
        t = step % TABLES
        pure = (
            (F.col("cell") >= 0)
            & (F.floor(F.col("cell") / F.col("size")) == t)
            & (F.abs("n") == 1)
            & (F.col("check") == _check(F.col("digest")))
        )
        none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
        names = ("cell", "found", "n", "digest", "check")

        def row(*values):
            return F.struct(*[v.alias(name) for name, v in zip(names, values)])

        taken = [
            row(_cell(F.col("digest"), o, F.col("size"), salt), none, -F.col("n"), F.col("digest"), F.col("check"))
            for o in range(TABLES)
            if o != t
        ]
        out = row(
            F.lit(-1),
            F.col("digest") if listed else none,
            F.col("n") if listed else F.lit(1).cast("long"),
            zero,
            zero,
        )
        same = row(*[F.col(name) for name in names])
        sent = F.when(pure, F.array(*taken, out)).otherwise(F.array(same))
        rows = rows.select(*by, "size", F.explode(sent).alias("_r")).select(*by, "size", "_r.*")
        rows = _summed(rows, keys).filter("cell < 0 or n <> 0 or digest <> 0")
    return rows.select(*by, "cell", "found", "n")


def differences(pairs: DataFrame, by: list[str], listed: bool = True) -> DataFrame:
    """`by`, `differing` (the number of digests that only one version has) and, if `listed`, `digests` (an
    array of structs digest, n) for rows `by`, `a`, `b` (arrays of digests).

    Pairs that did not peel are tried again with tables four times as large; after TRIES, what is left
    counts by the digests still in the cells. Equal versions differ by nothing.
    """
    done: list[DataFrame] = []
    work = pairs
    for attempt in range(TRIES):
        total = F.greatest(F.size("a") + F.size("b"), F.lit(SMALL))
        size = (F.pow(2.0, F.ceil(F.log2(total.cast("double")))) * 4**attempt).cast("int")
        signed = F.concat(
            F.transform("a", lambda d: F.struct(d.alias("digest"), F.lit(1).cast("long").alias("n"))),
            F.transform("b", lambda d: F.struct(d.alias("digest"), F.lit(-1).cast("long").alias("n"))),
        )
        rows = work.select(*by, size.alias("size"), F.explode(signed).alias("_s")).select(
            *by, "size", "_s.*"
        )
        subtracted = cells(rows, by, attempt).filter("n <> 0 or digest <> 0")
        found, out = peel(subtracted, by, attempt, listed), F.col("cell") < 0
        counted = found.groupBy(*by).agg(
            F.count(F.when(~out, 1)).alias("_left"),
            F.sum(F.when(out, F.abs("n"))).alias("differing"),
            F.sum(F.when(~out, F.abs("n"))).alias("_rest"),
            *([F.collect_list(F.when(out, F.struct(F.col("found").alias("digest"), "n"))).alias("digests")] * listed),
        )
        result = kept(counted, "peeled")
        last = attempt == TRIES - 1
        done.append(result if last else result.filter("_left = 0"))
        failed = result.filter("_left > 0").select(*by)
        if last or failed.isEmpty():
            break
        work = pairs.join(failed, by, "left_semi")
    peeled = done[0]
    for more in done[1:]:
        peeled = peeled.unionByName(more)
    rest = F.ceil(F.coalesce("_rest", F.lit(0)) / TABLES)
    some = pairs.select(*by).join(peeled, by, "left")
    differing = (F.coalesce("differing", F.lit(0)) + rest).alias("differing")
    if not listed:
        return some.select(*by, differing)
    return some.select(
        *by, differing, F.coalesce("digests", F.array().cast("array<struct<digest:bigint,n:bigint>>")).alias("digests")
    )


def likeness(differing: Column, a: Column, b: Column) -> Column:
    """Shared digests over all digests of two texts; two texts without any are alike."""
    return F.when(a + b == 0, F.lit(1.0)).otherwise((a + b - differing) / (a + b + differing))


def _sketch(rows: DataFrame, by: list[str], digests_col: str) -> DataFrame:
    """`by` and `cells`, the small table as text."""
    one = rows.select(
        *by, F.lit(SMALL).alias("size"), F.explode(digests_col).alias("digest"), F.lit(1).cast("long").alias("n")
    )
    listed = F.sort_array(F.collect_list(F.struct("cell", "n", "digest", "check")))
    said = F.transform(
        listed, lambda c: F.concat_ws(".", c["cell"], c["n"], F.hex(c["digest"]), F.hex(c["check"]))
    )
    return cells(one, by).groupBy(*by).agg(F.concat_ws(",", said).alias("cells"))


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`_row` (a unique number), `_key`, `_text` and `_next`, the text that follows by descending key;
    after the last comes the first. Null keys come last; rows of one key are in the order of their texts.

    Rows are dealt out by key ranges and each range is ordered by itself; where one ends, the first text
    of the range below is looked up. There are as many such texts as ranges.
    """
    rows = df.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ranges = spread(df, 4)
    bounds = rows.agg(
        F.percentile_approx("_key", [i / ranges for i in range(1, ranges)], 20 * ranges)
    ).first()[0]
    bounds = sorted(set(bounds or []))
    steps = [1 << i for i in reversed(range(max(1, len(bounds).bit_length())))]
    range_ = F.lit(0)
    if bounds:  # how many bounds the key reaches, by bisection
        listed = F.array(*[F.lit(b) for b in bounds])
        range_ = F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda at, s: at + F.when(F.get(listed, at + s - 1) <= F.col("_key"), s).otherwise(0),
        )
    rows = rows.withColumn("_range", F.when(F.col("_key").isNull(), -1).otherwise(range_))
    order = [F.col("_key").desc(), F.xxhash64("_text"), F.col("_text")]
    inside = W.partitionBy("_range").orderBy(*order)
    numbered = rows.withColumns(
        {
            "_place": F.row_number().over(inside),
            "_lead": F.lead("_text").over(inside),
        }
    )
    tops = rows.groupBy(F.col("_range").alias("_at")).agg(F.max("_key").alias("_top"))
    firsts = (
        rows.join(
            F.broadcast(tops), (F.col("_range") == F.col("_at")) & F.col("_key").eqNullSafe(F.col("_top"))
        )
        .groupBy("_range")
        .agg(F.min(F.struct(F.xxhash64("_text").alias("h"), F.col("_text").alias("t"))).alias("_first"))
        .select("_range", F.col("_first.t").alias("_first"))
    )
    down = W.orderBy(F.col("_range").desc())
    after = firsts.select(
        "_range",
        F.coalesce(
            F.lead("_first").over(down),
            F.first("_first").over(down.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        ).alias("_below"),
    )
    return numbered.join(after, "_range").select(
        (F.shiftleft(F.col("_range").cast("long") + 1, 36) + F.col("_place")).alias("_row"),
        "_key",
        "_text",
        F.coalesce("_lead", "_below").alias("_next"),
    )


def fingerprint(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) characters replaced by the first as many of the next
    document's. Null texts count as empty; a text without paragraphs has a fingerprint without cells. One
    row comes for each row, repeated ones too; an empty table gives none.
    """
    rows = with_next(df, key, text)
    n = F.length("_text")
    tail = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substr("_text", F.lit(1), n - tail), F.substr("_next", F.lit(1), tail)
    )
    rows = rows.withColumn("_edited", edited)
    narrow = kept(
        rows.select(
            "_row",
            "_key",
            n.cast("long").alias("n_chars"),
            F.sha2("_edited", 256).alias("edited_sha256"),
            F.xxhash64("_text").alias("_own"),
            F.xxhash64("_edited").alias("_other"),
            digests(F.col("_text")).alias("_a"),
            digests(F.col("_edited")).alias("_b"),
            digests(F.col("_next")).alias("_c"),
        ),
        "digests",
    ).repartition(spread(df), "_row")

    versions = narrow.select(
        "_row",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("v"), F.col(c).alias("d")) for i, c in enumerate(("_a", "_b"))])
        ).alias("_v"),
    ).select("_row", "_v.v", "_v.d")
    sketches = _sketch(versions, ["_row", "v"], "d")
    sketches = sketches.groupBy("_row").agg(
        *[F.max(F.when(F.col("v") == i, F.col("cells"))).alias(f"_cells{i}") for i in range(2)]
    )
    pairs = narrow.select(
        "_row",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("v"), F.col("_a").alias("a"), F.col(c).alias("b"))
                    for i, c in enumerate(("_b", "_c"))
                ]
            )
        ).alias("_v"),
    ).select("_row", "_v.*")
    differing = differences(pairs, ["_row", "v"], listed=False).groupBy("_row").agg(
        *[F.max(F.when(F.col("v") == i, F.col("differing"))).alias(f"_differ{i}") for i in range(2)]
    )

    def named(digest: str, count: str, table: str) -> Column:
        return F.concat_ws(":", F.hex(digest), F.size(count), F.coalesce(table, F.lit("")))

    whole = narrow.join(sketches, "_row", "left").join(differing, "_row", "left")
    a, b, c = (F.size(x) for x in ("_a", "_b", "_c"))
    return whole.select(
        F.col("_key").alias(key),
        "n_chars",
        "edited_sha256",
        named("_own", "_a", "_cells0").alias("fingerprint"),
        named("_other", "_b", "_cells1").alias("edited_fingerprint"),
        likeness(F.col("_differ0"), a, b).alias("near_edited"),
        likeness(F.col("_differ1"), a, c).alias("near_next"),
    )


def op3_bloom_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(read(spark, sf_dir, "documents"))
