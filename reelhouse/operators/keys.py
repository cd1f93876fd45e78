"""Surrogate keys without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Two bytes of the hash: at most 65,536 buckets, whatever the data, so the offset table is bounded.
BUCKET_BYTES = 2


def assign_keys(
    df: DataFrame, key: str, id_col: str = "id", existing: DataFrame | None = None
) -> DataFrame:
    """Add a dense id, 1 to n, to a table that is unique in the text column `key`.

    Rows are numbered in the order of (md5(key), key). The leading hash bytes cut that order into even
    buckets for any key shape; a bucket is numbered by itself and moved up by the rows in the buckets
    before it. Ids depend on the set of keys alone: not on partitioning, retries or run.

    With `existing` (`key`, `id_col`), known keys keep their id and new ones follow its highest.
    Of a wide table, number the keys alone and join them back: they move twice, the rest once.
    """
    digest = F.coalesce(F.unhex(F.md5(F.col(key))), F.lit(b""))
    tagged = df.withColumn("_hash", digest).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_BYTES)
    )
    if existing is None:
        tagged, base = tagged.withColumn("_old", F.lit(None).cast("long")), F.lit(0)
    else:
        known = existing.select(key, F.col(id_col).alias("_old"))
        tagged = tagged.join(known, key, "left")
        base = F.coalesce(existing.agg(F.max(id_col)).scalar(), F.lit(0))

    is_new = F.col("_old").isNull().cast("long")
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_bucket")
        .agg(F.sum(is_new).alias("_new"))
        .select("_bucket", F.coalesce(F.sum("_new").over(before), F.lit(0)).alias("_offset"))
    )
    inside = W.partitionBy("_bucket").orderBy("_hash", key).rowsBetween(W.unboundedPreceding, 0)
    numbered = tagged.withColumn("_place", F.sum(is_new).over(inside)).join(
        F.broadcast(offsets), "_bucket"
    )
    new_id = base + F.col("_offset") + F.col("_place")
    return numbered.select(*df.columns, F.coalesce("_old", new_id).cast("long").alias(id_col))
