"""Raw drops: dated folders of tab-separated files, plain or gzipped."""

from __future__ import annotations

import datetime
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.schemas import SENTINEL, raw_schema

# No quoting: a field may start with an unbalanced quote, which would swallow the tabs after it.
TSV = {"sep": "\t", "header": "true", "quote": ""}


FORMS = "{tsv,tsv.gz}"  # a file, zipped or not, or a folder of parts; no other ending is read


def matching(spark: SparkSession, glob: str) -> list[str]:
    """Paths that fit a glob, on whatever file system it names."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def snapshot_stamp(date: datetime.date) -> str:
    """Folder of one drop, `2021-06/26`."""
    return date.strftime("%Y-%m/%d")


def snapshot_path(root: str, date: datetime.date, name: str = "") -> str:
    """`root/2021-06/26/title.basics.tsv`; without a name the folder of the drop."""
    folder = f"{root.rstrip('/')}/{snapshot_stamp(date)}"
    return f"{folder}/{name}.tsv" if name else folder


BAD_LINE, SOURCE_FILE = "bad_line", "source_file"


def raw_options(decode_sentinel: bool = True, malformed: str = "fail") -> dict:
    """Reader options of a raw file: headers are checked, the marker is read as NULL if wanted.

    `malformed` says what becomes of a line with too few or too many fields, which would otherwise be padded
    or cut in silence: "fail" fails the job, "keep" puts the line into the column `bad_line`.
    """
    if malformed not in ("fail", "keep"):
        raise ValueError(f"malformed must be 'fail' or 'keep', not {malformed!r}")
    # a line is checked in full only if all its fields are parsed
    options = {**TSV, "enforceSchema": "false", "columnPruning": "false"}
    options |= {"mode": "FAILFAST"} if malformed == "fail" else {"columnNameOfCorruptRecord": BAD_LINE}
    return {**options, "nullValue": SENTINEL} if decode_sentinel else options


def with_bad_line(schema: T.StructType, malformed: str = "keep") -> T.StructType:
    """The schema to read with: `bad_line` takes the lines that do not fit."""
    return T.StructType([*schema, T.StructField(BAD_LINE, T.StringType())]) if malformed == "keep" else schema


def marked(rows: DataFrame) -> DataFrame:
    """Rows read with `bad_line`: a line that does not fit keeps its text and its file, and no values."""
    names = [c for c in rows.columns if c != BAD_LINE]
    # Spark parses no line for this column alone, so it always asks for a value as well
    line = F.when(F.length(F.coalesce(F.col(names[0]), F.lit(""))) >= 0, F.col(BAD_LINE))
    good = line.isNull()
    values = [F.when(good, F.col(c)).alias(c) for c in names]
    return rows.select(*values, line.alias(BAD_LINE), F.when(~good, F.col("_metadata.file_path")).alias(SOURCE_FILE))


def read_raw(
    spark: SparkSession,
    root: str,
    name: str,
    snapshot_date: datetime.date | None = None,
    decode_sentinel: bool = True,
    malformed: str = "fail",
) -> DataFrame:
    """One raw file as strings, under its declared schema: `name.tsv`, gzipped, or a folder of parts.

    `root` is a folder; with `snapshot_date` the file is looked up in the dated folder below it. A
    header that differs from the schema fails the job, and so does a line with too few or too many
    fields, so columns can never be misread. With `malformed="keep"` such lines come along in `bad_line`, with their
    `source_file`; both are NULL for all other rows, so one pass gives good and bad. The suites read
    with `decode_sentinel=False`, since they judge the marker too.
    """
    folder = snapshot_path(root, snapshot_date) if snapshot_date else root.rstrip("/")
    reader = spark.read.schema(with_bad_line(raw_schema(name), malformed))
    found = matching(spark, f"{folder}/{name}.{FORMS}")
    one_form(found)
    rows = reader.options(**raw_options(decode_sentinel, malformed)).csv(found[0] if found else f"{folder}/{name}.tsv")
    return marked(rows) if malformed == "keep" else rows


def one_form(paths: list[str]) -> None:
    """Refuse a file that is there both plain and zipped, as its rows would count twice."""
    plain = Counter(path.rstrip("/").removesuffix(".gz") for path in paths)
    twice = sorted(path for path, n in plain.items() if n > 1)
    if twice:
        raise ValueError(f"one file in several forms, which would count its rows twice: {twice}")


def headers(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """file and header (its first line that is not blank) of text files; a pass that parses nothing."""
    lines = spark.read.options(**options).text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id().alias("at")).alias("place"),
    )
    return lines.filter(F.trim("value") != "").groupBy("file").agg(F.min_by("value", "place").alias("header"))


def read_by_header(
    spark: SparkSession, paths: str | list[str], malformed: str = "fail", **options: str
) -> DataFrame:
    """Text files whose headers may differ: each is read under its own, and columns meet by name.

    Files of one header are read together; a column that a file lacks is NULL in its rows. Columns come in the
    order of the first file's header, then those that later ones add. Files without a header have no rows.
    """
    groups: dict[str, list[str]] = {}
    for row in headers(spark, paths, **options).orderBy("file").collect():  # a row per file
        groups.setdefault(row["header"], []).append(row["file"])
    parts = []
    for header, files in groups.items():
        names = header.split(TSV["sep"])
        if len(set(names)) < len(names):
            raise ValueError(f"a column stands twice in the header of {files[0]}: {names}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        reader = spark.read.schema(with_bad_line(schema, malformed)).options(**raw_options(False, malformed))
        rows = reader.csv(files)
        parts.append(marked(rows) if malformed == "keep" else rows)
    if not parts:
        return spark.createDataFrame([], T.StructType([]))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    last = [c for c in (BAD_LINE, SOURCE_FILE) if malformed == "keep"]
    return whole.select(*[c for c in whole.columns if c not in last], *last)


def read_asset(spark: SparkSession, folder: str, glob: str = "*.tsv", malformed: str = "fail") -> DataFrame:
    """Every file below a folder whose name fits the glob, columns named by the headers, which may differ."""
    return read_by_header(spark, folder, malformed, pathGlobFilter=glob, recursiveFileLookup="true")


def drop_files(root: str, name: str) -> str:
    """Glob for one raw file in every dated folder below `root`."""
    return f"{root.rstrip('/')}/[0-9][0-9][0-9][0-9]-[0-9][0-9]/[0-9][0-9]/{name}.{FORMS}"


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """Path, size and time of the files that fit; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .load(glob)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def as_batch(spark: SparkSession, source: DataFrame | str, kind: str = "path") -> DataFrame:
    """A batch to validate: a DataFrame as it is, or a path (parquet, or one raw file), a folder of
    text, a table or a query by `kind`."""
    if isinstance(source, DataFrame):
        return source
    if kind == "path":
        if source.rstrip("/").endswith((".tsv", ".tsv.gz")):
            return read_by_header(spark, source)
        return spark.read.parquet(source)
    if kind == "text":
        return read_asset(spark, source, "*.tsv*")
    if kind == "table":
        return spark.table(source)
    if kind == "query":
        return spark.sql(source)
    raise ValueError(f"kind must be 'path', 'text', 'table' or 'query', not {kind!r}")
