"""Database tables over JDBC, for those who keep a database beside the parquet warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str, password: str, driver: str | None = None) -> dict:
    """Connection options for both directions."""
    options = {"url": url, "dbtable": table, "user": user, "password": password}
    if driver:
        options["driver"] = driver
    return options


def read_jdbc(
    spark: SparkSession,
    options: dict,
    id_col: str = "id",
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table, read in `partitions` id ranges at once when the lowest and highest id are given."""
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", fetch_size)
    if bounds:
        reader = reader.options(
            partitionColumn=id_col,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def append_jdbc(df: DataFrame, options: dict, partitions: int = 16, batch_size: int = 10_000) -> None:
    """Append with a bounded number of connections."""
    (
        df.write.format("jdbc")
        .options(**options)
        .option("numPartitions", partitions)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )
