"""One row per key, chosen by value and not by chance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The row with the highest `order` columns for each key; ties go to the highest whole row.

    A maximum and no window: it is combined before the shuffle, so a key with very many rows sends one
    row per task instead of gathering them all in one sort.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )
