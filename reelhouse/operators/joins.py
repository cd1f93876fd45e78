"""A look-up join for a large table in which a few keys may hold most rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 250_000  # rows one task should get of one key; a key with more is split
BUCKETS = 1 << 16  # hash values by which rows are counted before keys are
SHARE = 1_000_000  # nor is a key split that holds less than one row in so many


def hottest(
    counts: DataFrame, key: str, n: str, hot_rows: int = HOT_ROWS, whole: DataFrame | None = None
) -> DataFrame:
    """The heavy keys of a table of counts and into how many pieces each is to be split. `whole` has the counts of
    all rows, by whatever they are counted, if `counts` leaves light keys out.

    Heavy is what has more than `hot_rows` rows and more than one row in SHARE. Fewer than SHARE keys can
    have that, so the list is bounded by arithmetic and none is cut off it; no piece, and no key that is
    left whole, has more rows than the larger of the two.
    """
    least = _least(counts if whole is None else whole, n, hot_rows)
    heavy = counts.select(key, F.col(n).alias("_rows"), least.alias("_least")).filter("_rows > _least")
    return heavy.select(key, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_pieces"))


def _least(counts: DataFrame, n: str, hot_rows: int) -> Column:
    """What a heavy key has more rows than."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("_n")).select(F.ceil(F.col("_n") / SHARE)).scalar()
    return F.greatest(F.lit(hot_rows).cast("bigint"), total.cast("bigint"))


def bucket(key: str) -> Column:
    """One of BUCKETS hash values of a key."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def heavy_buckets(counts: DataFrame, n: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Of the rows counted by `_bucket`, those in which a key can be heavy by one of the counts `n`; a bucket has all
    rows of its keys, so every heavy key lies in one of these, and there are BUCKETS of them at most."""
    heavy = [F.col(c) > F.col(f"_least_{c}") for c in n]
    least = {f"_least_{c}": _least(counts, c, hot_rows) for c in n}
    return counts.withColumns(least).filter(reduce(or_, heavy)).select("_bucket")


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The heavy keys of a table, counted exactly."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return hottest(counts, key, "_n", hot_rows)


def skew_join(
    large: DataFrame, lookup: DataFrame, key: str, hot: DataFrame, single: bool = False
) -> DataFrame:
    """Inner join on `key`, in which the rows of a key listed in `hot` go to many tasks.

    The look-up rows of a listed key are repeated once per piece, all others stay single. A key that is
    not listed joins as usual, so the result is the plain inner join for any list. The piece of a row
    hangs on its content and its partition number, which a lost and repeated task reproduces.

    `single` says that the look-up has one narrow row per key: its even share of a shuffle is then hashed, and neither
    side sorted.
    """
    listed = F.broadcast(hot)
    pieces = F.col("_pieces")
    spot = F.hash(*large.columns).cast("bigint") + F.spark_partition_id()
    large = (
        large.filter(F.col(key).isNotNull())
        .join(listed, key, "left")
        .withColumn("_piece", F.when(pieces.isNotNull(), F.pmod(spot, pieces).cast("int")).otherwise(F.lit(0)))
        .drop("_pieces")
    )
    every = F.sequence(F.lit(0), F.coalesce(pieces, F.lit(1)) - 1)
    lookup = (
        lookup.join(listed, key, "left").withColumn("_piece", F.explode(every)).drop("_pieces")
    )
    if single:
        lookup = lookup.hint("shuffle_hash")
    return large.join(lookup, [key, "_piece"]).drop("_piece")
