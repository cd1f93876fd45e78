"""Episode counts per series and season."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.columns import to_type


def episode_summary(raw: DataFrame) -> DataFrame:
    """tconst, season, total_episodes (bigint).

    With both numbers: the highest episode number of each season. With neither: the rows of the series,
    season NULL. An episode with only one of the two counts nowhere. One scan and one aggregation serve
    both kinds, as a season is NULL in exactly one of them.
    """
    season, episode = F.col("season"), F.col("episode")
    numbered = raw.select(
        F.col("parentTconst").alias("tconst"),
        to_type(F.col("seasonNumber"), "smallint").alias("season"),
        to_type(F.col("episodeNumber"), "smallint").alias("episode"),
    ).filter(season.isNull() == episode.isNull())
    totals = numbered.groupBy("tconst", "season").agg(
        F.count(F.lit(1)).alias("rows"), F.max("episode").cast("long").alias("highest")
    )
    return totals.select(
        "tconst", "season", F.coalesce("highest", "rows").alias("total_episodes")
    )


def with_title_ids(summary: DataFrame, title_ids: DataFrame) -> DataFrame:
    """title_id, season, total_episodes for the series among `title_ids` (id, tconst)."""
    known = title_ids.select("tconst", F.col("id").alias("title_id"))
    return summary.join(known.hint("shuffle_hash"), "tconst").select("title_id", "season", "total_episodes")


def episodes(raw: DataFrame, title_ids: DataFrame) -> DataFrame:
    """The same from the raw file."""
    return with_title_ids(episode_summary(raw), title_ids)
