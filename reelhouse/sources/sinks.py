"""Loads into parquet tables that can be run again."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from reelhouse.operators.latest import latest_rows
from reelhouse.schemas import TABLES

SNAPSHOT = "snapshot_date"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet table, or None while nothing was written to it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def new_rows(df: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows, one per key, whose key the target lacks."""
    if target is not None:
        df = df.join(target.select(*keys), list(keys), "left_anti").select(*df.columns)
    return latest_rows(df, keys)


def load(
    df: DataFrame,
    path: str,
    mode: str = "append",
    keys: Sequence[str] = (),
    snapshot: datetime.date | None = None,
) -> None:
    """Write to a parquet table.

    `append` adds all rows. `append_new` adds the rows whose keys are not there yet, so a second run
    adds nothing. `overwrite_snapshot` replaces the partitions of the snapshot dates in `df` and leaves
    the others; with `snapshot`, the partition of that date alone, whether or not `df` has any rows. Each write is committed as a whole; after a failure, run it again.
    """
    if mode == "append":
        df.write.mode("append").parquet(path)
    elif mode == "append_new":
        new_rows(df, read_table(df.sparkSession, path), keys).write.mode("append").parquet(path)
    elif mode == "overwrite_snapshot" and snapshot is not None:
        df.drop(SNAPSHOT).write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}={snapshot.isoformat()}")
    elif mode == "overwrite_snapshot":
        (
            df.write.option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .partitionBy(SNAPSHOT)
            .parquet(path)
        )
    else:
        raise ValueError(f"unknown mode {mode!r}")


def create_warehouse(
    spark: SparkSession, database: str, reset: bool = False, location: str | None = None
) -> None:
    """Create the seven tables where they are missing, in a database at `location` if it is new.

    Tables that are loaded drop by drop are partitioned by the drop's date. `reset=True` drops the whole
    database before.
    """
    if reset:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, table in TABLES.items():
        columns = [
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in table.columns
        ]
        dated = name != "download_date"
        listed = ", ".join(columns + [f"{SNAPSHOT} date"] * dated)
        parts = f" PARTITIONED BY ({SNAPSHOT})" if dated else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({listed}) USING parquet{parts}")
