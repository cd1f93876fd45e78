"""What the operators of this subpackage share: words, hash parts of ids, tables put down on the way."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.session import shared_folder

# Fixed value: a word is a longest run of characters other than blank, tab, LF, VT, FF and CR.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    plain = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def part_of(key: Column, parts: int = 5) -> Column:
    """crc32 of the key as text, modulo `parts`; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


# Working tables of the stage that runs, and of those before it, by application.
_working: dict[str, list[str]] = {}
_running: list[str] = []


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written below `spark.checkpoint.dir` and read again: cuts lineage, survives executors."""
    path = shared_folder(df.sparkSession, purpose)
    if _running:
        _working.setdefault(_running[-1], []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def done_with(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete `kept` tables that nothing reads any more, and the shuffles of finished queries.

    Spark deletes a shuffle once the driver has collected what refers to it, which a driver with memory to spare
    may not do before the job is over; the disks then hold the shuffles of all steps at once.
    """
    context = spark.sparkContext
    for folder in sorted({unquote(f).rpartition("/")[0] for table in tables for f in table.inputFiles()}):
        _delete(context, folder)
    context._jvm.System.gc()


def _delete(context: SparkContext, path: str) -> None:
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage of a pipeline: `function(spark, docs, sf_dir)`.

    A stage's working tables are needed until its result is written, which is so once the next stage is called
    on what was read again; then they are deleted, so that the shared folder holds those of one stage only.
    Tables that `docs` still reads stay.
    """

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        _release(spark, docs, application)
        _running.append(application)
        try:
            return function(spark, docs, sf_dir)
        finally:
            _running.pop()

    return run


def _release(spark: SparkSession, docs: DataFrame, application: str) -> None:
    context = spark.sparkContext
    held = {unquote(urlparse(f).path) for f in docs.inputFiles()}
    left = []
    for path in _working.get(application, []):
        folder = unquote(urlparse(path).path).rstrip("/") + "/"
        if any(f.startswith(folder) for f in held):
            left.append(path)
            continue
        _delete(context, path)
    _working[application] = left


def spread(df: DataFrame, factor: int = 1) -> int:
    """A number of partitions in step with the session's setting."""
    return factor * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def map_rows(
    df: DataFrame,
    start: Callable[[], Callable[[dict[str, list] | pa.RecordBatch], dict[str, list | pa.Array]]],
    schema: str,
    lists: bool = True,
) -> DataFrame:
    """Apply a function of column lists to each batch; `start` makes it once per task.

    Batches stay small, so that a few very long texts do not meet in one. Without `lists` the function is given
    the batch itself. It returns lists or Arrow arrays.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    types = _arrow_types(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                out = work(some.to_pydict() if lists else some)
                yield pa.RecordBatch.from_arrays([_column(out[n], t) for n, t in zip(names, types)], names=names)

    return df.mapInArrow(run, schema)


def _column(values: list | pa.Array, to: pa.DataType) -> pa.Array:
    return values.cast(to) if isinstance(values, pa.Array) else pa.array(values, type=to)


def _arrow_types(spark: SparkSession, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields]
