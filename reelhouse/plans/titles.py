"""Snapshot dimension and titles."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions.columns import adult_flag, list_item, to_type
from reelhouse.operators.keys import assign_keys


def snapshot_row(spark: SparkSession, date: datetime.date) -> DataFrame:
    """The date of one drop as a one-row table."""
    return spark.createDataFrame([(date,)], "snapshot_date date")


def snapshot_dim(dates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Drop dates (`snapshot_date`) to id, year, month, day, one row per date."""
    day = F.col("snapshot_date")
    rows = dates.filter(day.isNotNull()).select(day).distinct().select(
        F.date_format(day, "yyyy-MM-dd").alias("iso"),
        F.year(day).cast("smallint").alias("year"),
        F.month(day).cast("smallint").alias("month"),
        F.dayofmonth(day).cast("smallint").alias("day"),
    )
    if existing is not None:
        made = F.make_date("year", "month", "day")
        existing = existing.select("id", F.date_format(made, "yyyy-MM-dd").alias("iso"))
    return assign_keys(rows, "iso", "id", existing).select("id", "year", "month", "day")


def snapshot_id(snapshots: DataFrame, date: datetime.date | None = None):
    """Id of a drop date, or of the latest one, as a scalar subquery; an unknown date fails the job."""
    if date is None:
        found = snapshots.agg(F.max(F.struct("year", "month", "day", "id")).alias("m")).select("m.id")
    else:
        same_day = (
            (F.col("year") == date.year) & (F.col("month") == date.month) & (F.col("day") == date.day)
        )
        found = snapshots.filter(same_day).agg(F.min("id"))
    return F.coalesce(found.scalar(), F.raise_error(F.lit(f"no snapshot for {date or 'any date'}")))


def ratings(raw: DataFrame) -> DataFrame:
    """Typed title.ratings."""
    return raw.select(
        "tconst",
        to_type(F.col("averageRating"), "decimal(10,1)").alias("av_rating"),
        to_type(F.col("numVotes"), "int").alias("num_votes"),
    )


def typed_titles(basics: DataFrame) -> DataFrame:
    """Typed title.basics, the genre list spread over three columns."""
    return basics.select(
        "tconst",
        F.col("titleType").alias("type"),
        F.col("primaryTitle").alias("primary_title"),
        F.col("originalTitle").alias("original_title"),
        adult_flag(F.col("isAdult")).alias("is_adult"),
        to_type(F.col("startYear"), "smallint").alias("start_year"),
        to_type(F.col("endYear"), "smallint").alias("end_year"),
        to_type(F.col("runtimeMinutes"), "smallint").alias("runtime_minutes"),
        *[list_item(F.col("genres"), i).alias(f"genre_{i + 1}") for i in range(3)],
    )


def titles(
    basics: DataFrame,
    raw_ratings: DataFrame,
    snapshots: DataFrame | None = None,
    snapshot_date: datetime.date | None = None,
) -> DataFrame:
    """Rated titles, typed; with `snapshots`, `download_date_id` names the drop they came from."""
    rated = typed_titles(basics).join(ratings(raw_ratings).hint("shuffle_hash"), "tconst")  # narrow: spares two sorts
    if snapshots is None:
        return rated
    return rated.withColumn("download_date_id", snapshot_id(snapshots, snapshot_date))
