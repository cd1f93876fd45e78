"""Landing of new drops: every file once, as parquet partitioned by its drop date."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.operators.quality import Watch
from reelhouse.schemas import raw_schema
from reelhouse.sources.files import (
    BAD_LINE,
    FORMS,
    SOURCE_FILE,
    drop_files,
    list_files,
    marked,
    matching,
    one_form,
    raw_options,
    snapshot_path,
    with_bad_line,
)
from reelhouse.sources.sinks import SNAPSHOT, load, read_table

_DATED = r"/(\d{4}-\d{2})/(\d{2})/"


def drop_date(path) -> F.Column:
    """Date of the dated folder that a file lies in; null where its name is no date."""
    stamp = F.concat_ws("-", F.regexp_extract(path, _DATED, 1), F.regexp_extract(path, _DATED, 2))
    return F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd")).cast("date")


def land_stream(arriving: DataFrame, target: str, checkpoint: str) -> None:
    """Write what arrived since the last run, partitioned by `snapshot_date`, then stop.

    The checkpoint remembers the files taken; with the sink's own log each file lands exactly once,
    also when a run is broken off and repeated.
    """
    query = (
        arriving.writeStream.format("parquet")
        .partitionBy(SNAPSHOT)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def stream_drops(
    spark: SparkSession,
    name: str,
    source: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    decode_sentinel: bool = True,
) -> None:
    """Land the raw files of one kind from the dated folders below `source`.

    A backlog is taken in batches; a run that breaks off goes on after the last one. With
    `decode_sentinel=False` the marker stays, for suites that are to run on the landed rows. Lines that do
    not fit are landed apart (`read_quarantine`); a file both plain and zipped is refused.
    """
    one_form(matching(spark, drop_files(source, name)))
    arriving = (
        spark.readStream.schema(with_bad_line(raw_schema(name)))
        .options(**raw_options(decode_sentinel, "keep"))
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(drop_files(source, name))
    )
    land_stream(_dated(arriving), target, checkpoint)


def _dated(rows: DataFrame) -> DataFrame:
    """Rows read with `bad_line`, marked and stamped with the date of their folder."""
    return marked(rows).withColumn(SNAPSHOT, drop_date(F.col("_metadata.file_path")))


def pending_files(listing: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Files of a listing (`path`) that the manifest does not hold."""
    return listing if manifest is None else listing.join(manifest.select("path"), "path", "left_anti")


def land(
    spark: SparkSession,
    name: str,
    source: str,
    target: str,
    manifest: str,
    decode_sentinel: bool = True,
    watch: Watch | None = None,
) -> int:
    """The same without a stream: a table of files done is kept at `manifest`. Returns new files.

    Dates with a new file are landed whole, replacing what they held, and only then is the listing that
    was taken at the start added to the manifest. So a run that broke off in between is repeated
    without harm, and a file that arrives meanwhile counts as new the next time. Lines that do not fit are
    landed apart (`read_quarantine`), in the same pass; a file both plain and zipped is refused. A watch
    judges the lines that fit, in that pass too; it has results if there were new files.
    """
    one_form(matching(spark, drop_files(source, name)))
    listing = list_files(spark, drop_files(source, name)).withColumn(SNAPSHOT, drop_date(F.col("path")))
    listing = listing.filter(F.col(SNAPSHOT).isNotNull())  # a folder like 2021-13/99 is no drop
    fresh = pending_files(listing, read_table(spark, manifest))
    by_date = fresh.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per day
    if not by_date:
        return 0
    dates = [row[SNAPSHOT] for row in by_date]
    rows = (
        spark.read.schema(with_bad_line(raw_schema(name)))
        .options(**raw_options(decode_sentinel, "keep"))
        .csv([f"{snapshot_path(source, date)}/{name}.{FORMS}" for date in dates])
    )
    # of one date it is known: nothing is read off the path row by row, and nothing is sorted by date for the write
    dated = _dated(rows) if len(dates) > 1 else marked(rows).withColumn(SNAPSHOT, F.lit(dates[0]))
    load(dated if watch is None else watch.over(dated, F.col(BAD_LINE).isNull()), target, "overwrite_snapshot")
    if watch is not None:
        watch.wait()
    load(listing.filter(F.col(SNAPSHOT).isin(dates)).select("path"), manifest, "append_new", ["path"])
    return sum(row["n"] for row in by_date)


def _landed(spark: SparkSession, target: str, name: str) -> DataFrame:
    strings = [T.StructField(c, T.StringType()) for c in (BAD_LINE, SOURCE_FILE)]
    schema = T.StructType([*raw_schema(name), *strings, T.StructField(SNAPSHOT, T.DateType())])
    return spark.read.schema(schema).parquet(target)


def read_landed(spark: SparkSession, target: str, name: str, snapshot_date: datetime.date) -> DataFrame:
    """One drop of what was landed at `target`, under the schema of the raw file, without the lines that do
    not fit; a drop that was not landed has no rows. What `load_drop` reads, so that text is parsed once."""
    rows = _landed(spark, target, name).filter(F.col(SNAPSHOT) == F.lit(snapshot_date))
    return rows.filter(F.col(BAD_LINE).isNull()).select(*raw_schema(name).fieldNames())


def read_quarantine(
    spark: SparkSession, target: str, name: str, snapshot_date: datetime.date | None = None
) -> DataFrame:
    """bad_line, source_file and snapshot_date of the lines that were landed apart, of one drop or of all.

    With the rows of `read_landed` they make up all lines of the files, headers and blank lines aside.
    """
    rows = _landed(spark, target, name).filter(F.col(BAD_LINE).isNotNull())
    if snapshot_date is not None:
        rows = rows.filter(F.col(SNAPSHOT) == F.lit(snapshot_date))
    return rows.select(BAD_LINE, SOURCE_FILE, SNAPSHOT)
