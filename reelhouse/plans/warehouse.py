"""The whole catalogue: plans of all tables, written out once, or loaded drop by drop."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.operators.constraints import conform
from reelhouse.operators.joins import hottest
from reelhouse.operators.keys import assign_keys
from reelhouse.plans import credits, episodes, titles
from reelhouse.schemas import TABLES
from reelhouse.sources.sinks import SNAPSHOT, create_warehouse, load
from reelhouse.sources.versions import Load, Version, latest

RAW_FILES = ("title.basics", "title.ratings", "title.episode", "title.principals", "name.basics")


def with_episode_key(rows: DataFrame) -> DataFrame:
    """Add the key of an episode row; a title has one row per season and one without."""
    season = F.coalesce(F.col("season").cast("string"), F.lit(""))
    return rows.withColumn("_key", F.concat_ws("|", F.col("title_id").cast("string"), season))


def _number(_: str, keys: DataFrame, key: str) -> DataFrame:
    return assign_keys(keys, key)


def _plan_only(_: str, rows: DataFrame) -> DataFrame:
    return rows


def written(spark: SparkSession, root: str) -> Callable[[str, DataFrame], DataFrame]:
    """A `keep` that writes each table below `root` and goes on from what it wrote."""

    def keep(name: str, rows: DataFrame) -> DataFrame:
        load(rows, f"{root}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{root}/{name}")

    return keep


# What can be put together side by side, each group from what the groups before it made.
SIDE_BY_SIDE = (
    ("download_date", "rated_titles", "_episode_totals", "_by_person", "_title_buckets"),
    ("_title_ids", "cast_people", "crew_people"),
    ("titles", "episodes", "_cast_ids", "_crew_ids"),
    ("casts", "crew", "titles_casts", "titles_crew"),
)


class Catalogue:
    """The warehouse tables over decoded raw files, each put together when first asked for.

    `read` gives a raw file by name. `keep` says what becomes of a finished table: by default it stays a
    plan, and with `written` later tables read it back, so that its work is done once. `number` adds
    ids to rows that are unique in a key: the keys of titles, casts and crew, and the episodes. `rated_titles`, `cast_people` and
    `crew_people` are these tables without ids, for reports that join nothing. Titles are stamped with the
    drop of the date `drop`, or with the latest.
    """

    def __init__(
        self,
        read: Callable[[str], DataFrame],
        dates: DataFrame,
        as_of_year: int,
        parse: str = "split",
        keep: Callable[[str, DataFrame], DataFrame] = _plan_only,
        number: Callable[[str, DataFrame, str], DataFrame] = _number,
        drop: datetime.date | None = None,
    ):
        self._read, self._keep, self._number, self._drop = cache(read), keep, number, drop
        self._dates, self._as_of_year, self._parse = dates, as_of_year, parse

    @cached_property
    def download_date(self) -> DataFrame:
        return self._keep("download_date", titles.snapshot_dim(self._dates))

    @cached_property
    def rated_titles(self) -> DataFrame:
        return self._keep("rated_titles", titles.titles(self._read("title.basics"), self._read("title.ratings")))

    def _ids(self, name: str, rows: DataFrame, key: str) -> DataFrame:
        return self._keep(name, self._number(name, rows.select(key).distinct(), key))

    @cached_property
    def _title_ids(self) -> DataFrame:
        return self._ids("title_ids", self.rated_titles, "tconst")

    @cached_property
    def titles(self) -> DataFrame:
        drop = titles.snapshot_id(self.download_date, self._drop)
        # ids are narrow and have one row per key: hashed, so that the titles need no sort
        ids = self._title_ids.hint("shuffle_hash")
        return self._keep("titles", self.rated_titles.join(ids, "tconst").withColumn("download_date_id", drop))

    @cached_property
    def _episode_totals(self) -> DataFrame:
        return self._keep("episode_totals", episodes.episode_summary(self._read("title.episode")))

    @cached_property
    def episodes(self) -> DataFrame:
        # one row per title and season, so the rows are numbered themselves and need not meet their ids again
        keyed = with_episode_key(episodes.with_title_ids(self._episode_totals, self._title_ids))
        numbered = self._number("episode_ids", self._keep("episodes_keyed", keyed), "_key")
        return self._keep("episodes", numbered.drop("_key"))

    @cached_property
    def _people(self) -> DataFrame:
        return credits.people(self._read("name.basics"), self._as_of_year)

    @cached_property
    def _by_person(self) -> DataFrame:
        counts = credits.credit_counts(self._read("title.principals"), "nconst")
        return self._keep("credits_by_person", counts)

    @cached_property
    def _title_buckets(self) -> DataFrame:
        counts = credits.bucket_counts(self._read("title.principals"), "tconst")
        return self._keep("credits_by_title_bucket", counts)

    def _hot(self, n: str) -> dict[str, DataFrame]:
        by_title = credits.heavy_credit_counts(self._read("title.principals"), "tconst", self._title_buckets)
        return {
            "hot_persons": hottest(self._by_person, "nconst", n),
            "hot_titles": hottest(by_title, "tconst", n, whole=self._title_buckets),
        }

    @cached_property
    def cast_people(self) -> DataFrame:
        held = credits.person_dim(self._by_person.filter("cast_rows > 0"), self._people)
        return self._keep("cast_people", held)

    @cached_property
    def crew_people(self) -> DataFrame:
        held = credits.person_dim(self._by_person.filter("crew_rows > 0"), self._people)
        return self._keep("crew_people", held)

    @cached_property
    def _cast_ids(self) -> DataFrame:
        return self._ids("cast_ids", self.cast_people, "nconst")

    @cached_property
    def _crew_ids(self) -> DataFrame:
        return self._ids("crew_ids", self.crew_people, "nconst")

    @cached_property
    def casts(self) -> DataFrame:
        return self._keep("casts", self.cast_people.join(self._cast_ids, "nconst"))

    @cached_property
    def crew(self) -> DataFrame:
        return self._keep("crew", self.crew_people.join(self._crew_ids, "nconst"))

    @cached_property
    def titles_casts(self) -> DataFrame:
        held = credits.cast_credits(self._read("title.principals"))
        hot = self._hot("cast_rows")
        rows = credits.titles_casts(held, self._cast_ids, self._title_ids, self._parse, **hot)
        return self._keep("titles_casts", rows)

    @cached_property
    def titles_crew(self) -> DataFrame:
        held = credits.crew_credits(self._read("title.principals"))
        hot = self._hot("crew_rows")
        rows = credits.titles_crew(held, self._crew_ids, self._title_ids, **hot)
        return self._keep("titles_crew", rows)


def load_drop(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    root: str,
    snapshot_date: datetime.date,
    as_of_year: int | None = None,
    parse: str = "split",
    database: str | None = None,
) -> Version:
    """Load one drop into the warehouse at `root`; running it again changes nothing.

    The load is published as a whole at its end: until then, and if it breaks off, readers see the version
    before. Ids live in key tables that only grow, so a title or person keeps its id in every drop; only keys
    that are new are ranked, from the highest id on. Each other table holds one part per drop, replaced as a
    whole; download_date grows by a row per drop. An earlier drop may be loaded again at any time, and a
    corrected one replaces what it held, also where nothing is left of a table. Of two loads that overlap,
    the later to finish is refused. With `database`, the declared tables there are filled from what was published.
    """
    load = Load.begun(spark, root)
    part = snapshot_date.isoformat()

    def number(kind: str, rows: DataFrame, key: str) -> DataFrame:
        name = f"keys/{kind}"
        schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("id", T.LongType())])
        alone = rows.columns == [key]
        if not load.base.of(name):
            numbered = assign_keys(rows, key)
            if not alone:
                numbered = load.write(f"{name}.met", numbered)
            grown = load.grow(name, numbered.select(key, "id"), "id")
            return grown if alone else numbered
        known = load.base.read(spark, name, schema).hint("shuffle_hash")
        # one join finds the ids of the known keys and which keys are new
        met = load.write(f"{name}.met", rows.join(known, key, "left"))
        fresh = assign_keys(met.filter("id IS NULL").select(key), key)
        fresh = fresh.withColumn("id", F.col("id") + load.high(name))
        added = load.grow(name, fresh, "id").filter(F.col("id") > load.high(name))
        if not alone:
            added = met.filter("id IS NULL").drop("id").join(added, key)
        return met.filter("id IS NOT NULL").unionByName(added)

    def keep(name: str, rows: DataFrame) -> DataFrame:
        if name == "download_date":
            known = load.base.read(spark, name, plain_schema(name))
            dim = conform(titles.snapshot_dim(dates, known), name)
            return load.grow(name, dim.join(known, ["year", "month", "day"], "left_anti").select(*dim.columns))
        if name in TABLES:
            return load.replace(name, part, conform(rows, name))
        return rows if name.endswith("_ids") else load.write(name, rows)

    dates = titles.snapshot_row(spark, snapshot_date)
    year = as_of_year or snapshot_date.year
    catalogue = Catalogue(read, dates, year, parse, keep, number, snapshot_date)
    with ThreadPoolExecutor(max(map(len, SIDE_BY_SIDE))) as pool:  # small jobs of one group share the cluster
        for group in SIDE_BY_SIDE:
            list(pool.map(lambda name: getattr(catalogue, name), group))
    published = load.publish()
    if database:
        fill_tables(spark, published, database, snapshot_date)
    return published


def fill_tables(spark: SparkSession, version: Version, database: str, snapshot_date: datetime.date) -> None:
    """Fill the declared tables of a database from a published drop: its partition is replaced, columns go by
    name, and Spark's store assignment holds them to the declared types and text lengths."""
    create_warehouse(spark, database)
    for name in TABLES:
        rows = read_version(spark, version, name, snapshot_date)
        listed = ", ".join(TABLES[name].names)
        dated = "" if name == "download_date" else f"PARTITION ({SNAPSHOT} = DATE'{snapshot_date.isoformat()}')"
        spark.sql(f"INSERT OVERWRITE TABLE {database}.{name} {dated} ({listed}) SELECT {listed} FROM {{rows}}", rows=rows)


def plain_schema(name: str) -> T.StructType:
    """The declared columns of a table as files hold them: text without its length."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType)
            for f in TABLES[name].columns
        ]
    )


def register_views(spark: SparkSession, root: str, snapshot_date: datetime.date | None = None) -> None:
    """The warehouse tables under their own names, for dashboards that bring their SQL."""
    version = latest(spark, root)
    for name in TABLES:
        read_version(spark, version, name, snapshot_date).createOrReplaceTempView(name)


def read_version(spark: SparkSession, version: Version, name: str, snapshot_date: datetime.date | None = None) -> DataFrame:
    """A table of a version: one drop of it, or the latest."""
    schema = plain_schema(name)
    if name == "download_date":
        return version.read(spark, name, schema)
    if snapshot_date is not None:
        return version.read(spark, name, schema, snapshot_date.isoformat())
    parts = [e.part for e in version.of(name)]
    return version.read(spark, name, schema, max(parts) if parts else "")


def read_drop(
    spark: SparkSession,
    root: str,
    name: str,
    snapshot_date: datetime.date | None = None,
    number: int | None = None,
) -> DataFrame:
    """A warehouse table: the rows of one drop, or of the latest, as published last or as version `number`
    had them. All tables of one report are best read from one `versions.latest`."""
    return read_version(spark, latest(spark, root, number), name, snapshot_date)
