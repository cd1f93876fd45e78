"""Published versions of a warehouse: readers see a load whole or not at all.

A load writes every table into folders of its own and only then publishes a manifest: one small file
that names the folders which make up the warehouse from now on. What was not published is in no manifest, so a
load that breaks off leaves readers with the version before, and is simply run again. Folders are never
changed once they are published.

A manifest holds a row per table and part. A part is a drop (replaced as a whole by a later load) or, for
tables that only grow, what one load added; for key tables `high` is the highest id so far.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = "number long, load string, name string, part string, path string, high long"
MOST_PARTS = 64  # of a growing table; one more load merges them


class StaleWriter(RuntimeError):
    """Another load was published since this one began."""


@dataclass(frozen=True)
class Entry:
    name: str
    part: str
    path: str
    high: int | None = None


@dataclass(frozen=True)
class Version:
    """What the warehouse at `root` consists of; number 0 is the empty one."""

    root: str
    number: int = 0
    load: str = ""
    entries: tuple[Entry, ...] = ()

    def of(self, name: str, part: str | None = None) -> list[Entry]:
        return [e for e in self.entries if e.name == name and part in (None, e.part)]

    def read(self, spark: SparkSession, name: str, schema: T.StructType, part: str | None = None) -> DataFrame:
        """The rows of a table, or of one part; none if there is no such part."""
        paths = [f"{self.root}/{e.path}" for e in self.of(name, part)]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true").parquet(f"{root}/versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def latest(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The version published last, or the one of that number.

    Of two manifests with one number, which only loads that publish at the same moment can leave, the
    earlier file counts, and its twin was refused.
    """
    root = root.rstrip("/")
    found = _manifests(spark, root)
    if found is None:
        return Version(root)
    if number is None:
        number = found.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    rows = found.filter(F.col("number") == number).select("*", "_metadata.file_modification_time").collect()
    if not rows:
        return Version(root)  # a row per table and drop
    first = min((r["file_modification_time"], r["load"]) for r in rows)[1]
    entries = [Entry(r["name"], r["part"], r["path"], r["high"]) for r in rows if r["load"] == first and r["name"]]
    return Version(root, number, first, tuple(sorted(entries, key=lambda e: (e.name, e.part))))


@dataclass
class Load:
    """A load that is being made on top of a version."""

    spark: SparkSession
    base: Version
    id: str = field(default_factory=lambda: uuid.uuid4().hex)
    staged: list[Entry] = field(default_factory=list)
    merged: set[str] = field(default_factory=set)

    @classmethod
    def begun(cls, spark: SparkSession, root: str) -> Load:
        return cls(spark, latest(spark, root))

    def path(self, name: str) -> str:
        """A folder of this load, relative to the root."""
        return f"loads/{self.id}/{name}"

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        """Write rows into a folder of this load, and go on from what was written."""
        path = f"{self.base.root}/{self.path(name)}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def replace(self, name: str, part: str, rows: DataFrame) -> DataFrame:
        """A part of a table, in place of the one of that name."""
        written = self.write(name, rows)
        self.staged.append(Entry(name, part, self.path(name)))
        return written

    def grow(self, name: str, rows: DataFrame, high: str | None = None) -> DataFrame:
        """The whole table after adding rows to it; without rows nothing is added. `high` is a column whose
        highest value the manifest keeps."""
        whole = self.base.read(self.spark, name, rows.schema)
        written = self.write(name, rows)
        counted = [F.count(F.lit(1)), F.max(high) if high else F.lit(None)]
        n, top = written.agg(*counted).first()
        if n == 0:
            return whole
        whole = whole.unionByName(written)
        path = self.path(name)
        if len(self.base.of(name)) >= MOST_PARTS:
            path = self.path(f"{name}.merged")
            whole = self.write(f"{name}.merged", whole)
            self.merged.add(name)
        self.staged.append(Entry(name, self.id, path, top))
        return whole

    def high(self, name: str) -> int:
        """The highest id of a key table before this load."""
        return max((e.high or 0 for e in self.base.of(name)), default=0)

    def publish(self) -> Version:
        """Make this load what readers see. A load that began before another one was published is refused."""
        root, number = self.base.root, self.base.number + 1
        replaced = {(e.name, e.part) for e in self.staged}
        kept = [e for e in self.base.entries if (e.name, e.part) not in replaced and e.name not in self.merged]
        rows = [(number, self.id, e.name, e.part, e.path, e.high) for e in [*kept, *self.staged]]
        rows = rows or [(number, self.id, None, None, None, None)]
        if latest(self.spark, root).load != self.base.load:
            raise StaleWriter(f"version {self.base.number} of {root} is no longer the latest")
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)  # one file: seen whole or not at all
        manifest.write.parquet(f"{root}/versions/{number:09d}-{self.id}")
        published = latest(self.spark, root, number)
        if published.load != self.id:
            raise StaleWriter(f"version {number} of {root} was published by another load")
        return published
