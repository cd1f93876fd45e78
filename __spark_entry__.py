"""Registered queries, and the SQL that each is checked against."""

from __future__ import annotations

import datetime
import importlib
import sys
from collections.abc import Callable
from functools import partial, reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from reelhouse.functions.columns import decode_all  # noqa: E402
from reelhouse.operators import constraints, quality  # noqa: E402
from reelhouse.operators.keys import assign_keys  # noqa: E402
from reelhouse.operators.latest import latest_rows  # noqa: E402
from reelhouse.operators.suites import SUITES  # noqa: E402
from reelhouse.plans import credits, episodes, reports, titles, warehouse  # noqa: E402
from reelhouse.schemas import RAW_TYPES, TABLES  # noqa: E402
from reelhouse.session import shared_folder  # noqa: E402
from reelhouse.sources.files import TSV, as_batch, read_asset, read_raw, snapshot_path  # noqa: E402
from reelhouse.sources.sinks import create_warehouse, load  # noqa: E402
from reelhouse.sources.standins import raw_view, table  # noqa: E402
from reelhouse.streaming.drops import (  # noqa: E402
    land,
    land_stream,
    pending_files,
    read_landed,
    read_quarantine,
)

AS_OF_YEAR = 2021
DROP = datetime.date(2021, 6, 26)
DAYS = (DROP, DROP + datetime.timedelta(days=1))

Query = Callable[[SparkSession, str], DataFrame]


def _known(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return decode_all(raw_view(spark, sf_dir, name))


def _small(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A smaller drop: the titles with fewer votes, the first credits of each."""
    fewer = {"title.ratings": "cast(numVotes as int) < 300000", "title.principals": "cast(ordering as int) <= 3"}
    return _known(spark, sf_dir, name).filter(fewer.get(name, "true"))


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate").alias("snapshot_date")
    return table(spark, sf_dir, "orders").select(day)


def _catalogue(spark: SparkSession, sf_dir: str, **settings) -> warehouse.Catalogue:
    return warehouse.Catalogue(
        lambda name: _known(spark, sf_dir, name), _dates(spark, sf_dir), AS_OF_YEAR, **settings
    )


def _plan(name: str, report: Callable[..., DataFrame] | None = None) -> Query:
    """A table, or a report over one, as a single plan from the raw files."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = getattr(_catalogue(spark, sf_dir), name)
        return report(rows) if report else rows

    return run


_written: dict[tuple[str, str], warehouse.Catalogue] = {}


def _warehouse(spark: SparkSession, sf_dir: str) -> warehouse.Catalogue:
    """The warehouse of one session and data folder; a table is written when first asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        keep = warehouse.written(spark, shared_folder(spark, "warehouse"))
        _written[key] = _catalogue(spark, sf_dir, keep=keep)
    return _written[key]


def _report(report: Callable[..., DataFrame], *names: str, **settings) -> Query:
    """A report over written tables, as dashboards ask for it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = _warehouse(spark, sf_dir)
        return report(*[getattr(tables, n) for n in names], **settings)

    return run


def _raw(build: Callable[..., DataFrame], *names: str, **settings) -> Query:
    """A builder over decoded raw files."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(*[_known(spark, sf_dir, n) for n in names], **settings)

    return run


def _suite(name: str, **settings) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        batch = {name: raw_view(spark, sf_dir, name)}
        now = datetime.datetime.now(datetime.timezone.utc)
        return quality.run_suites(batch, SUITES, "check", now, **settings).drop("run_name", "run_time")

    return run


def _snapshot_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format(F.make_date("year", "month", "day"), "yyyy-MM/dd")
    return titles.snapshot_dim(_dates(spark, sf_dir)).withColumn("stamp", stamp)


def _age_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = _catalogue(spark, sf_dir)
    return reports.age_distribution(catalogue.cast_people, catalogue.crew_people)


def _title_keys_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, every = (
        _known(spark, sf_dir, name).select("tconst").distinct()
        for name in ("title.ratings", "title.basics")
    )
    return assign_keys(every, "tconst", "id", assign_keys(rated, "tconst"))


def _stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "results")
    batch = {"title.ratings": raw_view(spark, sf_dir, "title.ratings")}
    now = datetime.datetime.now(datetime.timezone.utc)
    quality.store_results(quality.run_suites(batch, SUITES, "check", now), path)
    return spark.read.parquet(path).drop("run_name", "run_time", "run_date")


def _failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = {"type": "length_between", "column": "region", "min": 2, "max": 4}
    form = {"type": "matches", "column": "region", "regex": "^[A-Z]{2}$"}
    born = {"type": "between", "column": "birthYear", "min": 1900, "max": 1999}
    found = [
        quality.failing_rows(raw_view(spark, sf_dir, view), rule).select(
            F.lit(label).alias("broken"), F.col(key).alias("key"), F.col(rule["column"]).alias("value")
        )
        for label, view, key, rule in (
            ("region length", "title.akas", "titleId", region),
            ("region form", "title.akas", "titleId", form),
            ("birth year range", "name.basics", "nconst", born),
        )
    ]
    return reduce(DataFrame.unionByName, found)


def _repeated_principals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"type": "unique_together", "columns": ["tconst", "nconst"]}
    return quality.failing_rows(raw_view(spark, sf_dir, "title.principals"), rule)


def _constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over written tables, as each takes part in several checks."""
    tables = _warehouse(spark, sf_dir)
    return constraints.check_constraints({name: getattr(tables, name) for name in TABLES})


def _cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.cast_losses({name: _known(spark, sf_dir, name) for name in RAW_TYPES})


def _orphan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = (
        ("title.ratings", "tconst", "title.basics", "tconst"),
        ("title.episode", "parentTconst", "title.ratings", "tconst"),
        ("title.principals", "tconst", "title.ratings", "tconst"),
        ("title.principals", "nconst", "name.basics", "nconst"),
        ("title.crew", "tconst", "title.ratings", "tconst"),
    )
    views = {n: raw_view(spark, sf_dir, n) for link in links for n in (link[0], link[2])}
    return constraints.orphan_report(views, links)


def _latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    drops = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("tt"), F.lpad(F.col("l_orderkey").cast("string"), 7, "0")).alias("tconst"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.col("l_quantity").cast("int").alias("votes"),
        F.col("l_linenumber").alias("ordering"),
    )
    return latest_rows(drops, ["tconst"], ["snapshot_date"])


def _idempotent_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier drop, then the whole one, twice."""
    rows = titles.titles(_known(spark, sf_dir, "title.basics"), _known(spark, sf_dir, "title.ratings"))
    path = shared_folder(spark, "titles")
    for drop in (rows.filter("start_year < 1999"), rows, rows):
        load(drop, path, "append_new", ["tconst"])
    return spark.read.parquet(path)


def _incremental_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by order date are on offer, files by ship date are done."""

    def files(name: str, day: str) -> DataFrame:
        stamp = F.date_format(F.col(day), "yyyy-MM/dd")
        return table(spark, sf_dir, name).select(
            F.concat(stamp, F.lit("/title.basics.tsv")).alias("path")
        ).distinct()

    return pending_files(files("orders", "o_orderdate"), files("lineitem", "l_shipdate"))


def _streamed_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order table as an arriving file, landed by two runs of which the second finds nothing."""
    schema = table(spark, sf_dir, "orders").schema
    source = f"{sf_dir.rstrip('/')}/orders.parquet*"  # a file or a folder of them
    root = shared_folder(spark, "stream")
    for _ in range(2):
        arriving = spark.readStream.schema(schema).parquet(source).select(
            F.concat(F.lit("tt"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0")).alias("tconst"),
            F.col("o_orderpriority").alias("type"),
            F.to_date(F.trunc("o_orderdate", "year")).alias("snapshot_date"),
        )
        land_stream(arriving, f"{root}/landed", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/landed")


def _tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop written as gzipped text, read back under its schema."""
    root = shared_folder(spark, "drop")
    view = raw_view(spark, sf_dir, "title.basics")
    view.write.options(**TSV, compression="gzip").csv(snapshot_path(root, DROP, "title.basics"))
    return read_raw(spark, root, "title.basics", DROP)


def _titles_of_a_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles stamped with a given drop date: the earliest there is."""
    dates = _dates(spark, sf_dir)
    first = dates.agg(F.min("snapshot_date")).first()[0]
    raw = [_known(spark, sf_dir, name) for name in ("title.basics", "title.ratings")]
    return titles.titles(*raw, titles.snapshot_dim(dates), first)


def _landed_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles built from gzipped text that was landed before."""
    root = shared_folder(spark, "landed")
    names = ("title.basics", "title.ratings")
    for name in names:
        view = raw_view(spark, sf_dir, name)
        view.write.options(**TSV, compression="gzip").csv(snapshot_path(f"{root}/raw", DROP, name))
        land(spark, name, f"{root}/raw", f"{root}/{name}", f"{root}/done/{name}")
    return titles.titles(*[read_landed(spark, f"{root}/{name}", name, DROP) for name in names])


def _watched_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules on single rows of all suites, judged while the files are landed."""
    root = shared_folder(spark, "watched")
    found = []
    for name, rules in SUITES.items():
        raw_view(spark, sf_dir, name).write.options(**TSV).csv(snapshot_path(f"{root}/raw", DROP, name))
        watch = quality.Watch(name, quality.row_rules(rules))
        land(spark, name, f"{root}/raw", f"{root}/{name}", f"{root}/done/{name}", decode_sentinel=False, watch=watch)
        found.append(watch.results(spark))
    return reduce(DataFrame.unionByName, found)


def _written_lines(spark: SparkSession, sf_dir: str, root: str) -> None:
    """title.ratings as text of two dates; some lines lack a field, others have one too many."""
    votes = F.col("numVotes").cast("int")
    fields = F.concat_ws("\t", "tconst", "averageRating", "numVotes")
    line = (
        F.when(votes % 7 == 0, F.concat_ws("\t", "tconst", "averageRating"))
        .when(votes % 11 == 0, F.concat_ws("\t", fields, F.lit("more")))
        .otherwise(fields)
    )
    view = raw_view(spark, sf_dir, "title.ratings")
    first = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)) == 0  # of a file, as each task writes one
    header = F.lit("\t".join(view.columns) + "\n")
    for i, day in enumerate(DAYS):
        rows = view.filter(F.pmod(votes, F.lit(2)) == i).select(line.alias("line"))
        rows.select(F.concat(F.when(first, header).otherwise(""), "line")).write.text(
            snapshot_path(root, day, "title.ratings")
        )


def _quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a landed file by drop and number of fields: good ones, and those that were set apart."""
    root = shared_folder(spark, "quarantine")
    _written_lines(spark, sf_dir, f"{root}/raw")
    land(spark, "title.ratings", f"{root}/raw", f"{root}/landed", f"{root}/done")
    found = []
    for i, day in enumerate(DAYS, 1):
        good = read_landed(spark, f"{root}/landed", "title.ratings", day)
        bad = read_quarantine(spark, f"{root}/landed", "title.ratings", day)
        found += [
            good.select(F.lit(i).alias("drop_id"), F.concat_ws("\t", *good.columns).alias("line")),
            bad.select(F.lit(i).alias("drop_id"), F.col("bad_line").alias("line")),
        ]
    lines = reduce(DataFrame.unionByName, found)
    return lines.groupBy("drop_id", F.size(F.split("line", "\t")).alias("fields")).agg(
        F.count(F.lit(1)).alias("n"), F.min("line").alias("first_line"), F.max("line").alias("last_line")
    )


def _mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files whose headers differ: in another order, with one column more, with one less."""
    root = shared_folder(spark, "mixed")
    view = raw_view(spark, sf_dir, "title.ratings")
    votes = F.col("numVotes").cast("int")
    kinds = (["tconst", "averageRating", "numVotes"], ["numVotes", "tconst", "averageRating"],
             ["tconst", "numVotes", "parity"], ["averageRating", "tconst"])
    for i, columns in enumerate(kinds):
        rows = view.withColumn("parity", F.pmod(votes, F.lit(2)).cast("string"))
        rows.filter(F.pmod(votes, F.lit(4)) == i).select(*columns).write.options(**TSV).csv(f"{root}/part_{i}.tsv")
    return read_asset(spark, root, "part-*")


def _declared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables of a database after two drops: of each drop, told apart by partition."""
    root = shared_folder(spark, "declared")
    database = "films_" + root.rsplit("-", 1)[1]
    create_warehouse(spark, database, location=f"{root}/tables")
    for i, day in enumerate(DAYS):
        drop = _small if i == 0 else _known
        warehouse.load_drop(spark, partial(drop, spark, sf_dir), f"{root}/house", day, AS_OF_YEAR, database=database)
    found = []
    for name, columns in {
        "titles": "id tconst type primary_title is_adult start_year av_rating num_votes genre_1",
        "casts": "id nconst name age is_alive",
        "titles_crew": "title_id crew_id role",
    }.items():
        rows = spark.table(f"{database}.{name}")
        drop_id = F.when(F.col("snapshot_date") == F.lit(DAYS[0]), 1).otherwise(2)
        line = F.concat_ws("|", *[F.col(c).cast("string") for c in columns.split()])
        found.append(rows.select(F.lit(name).alias("table_name"), drop_id.alias("drop_id"), line.alias("line")))
    return reduce(DataFrame.unionByName, found)


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent unexpected values under the shipped suites and two stricter rules."""
    region = {"type": "matches", "column": "region", "regex": "^[A-Z]{2}$"}
    birth = {"type": "between", "column": "birthYear", "min": 1900, "max": 1999}
    suites = {**SUITES, "title.akas": [*SUITES["title.akas"], region], "name.basics": [*SUITES["name.basics"], birth]}
    return quality.examples({name: raw_view(spark, sf_dir, name) for name in suites}, suites)


def _all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suites in one run over folders of text."""
    root = shared_folder(spark, "texts")
    batches = {}
    for name in SUITES:
        raw_view(spark, sf_dir, name).write.options(**TSV).csv(f"{root}/{name}.tsv")
        batches[name] = as_batch(spark, f"{root}/{name}.tsv")
    now = datetime.datetime.now(datetime.timezone.utc)
    return quality.run_suites(batches, SUITES, "check", now).drop("run_name", "run_time")


def _two_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all tables, ids included, after a small drop, a larger one, and the small one again."""
    root = shared_folder(spark, "two_drops")
    for day, drop in ((DAYS[0], _small), (DAYS[1], _known), (DAYS[0], _small)):
        warehouse.load_drop(spark, partial(drop, spark, sf_dir), root, day, AS_OF_YEAR)
    columns = {
        "titles": "id tconst type primary_title original_title is_adult start_year end_year runtime_minutes "
        "av_rating num_votes genre_1 genre_2 genre_3 download_date_id",
        "episodes": "id title_id season total_episodes",
        "casts": "id nconst name age is_alive",
        "crew": "id nconst name age is_alive",
        "titles_casts": "title_id cast_id character",
        "titles_crew": "title_id crew_id role",
    }
    found = [
        warehouse.read_drop(spark, root, name, day).select(
            F.lit(name).alias("table_name"),
            F.lit(i).alias("drop_id"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in listed.split()]).alias("line"),
        )
        for name, listed in columns.items()
        for i, day in enumerate(DAYS, 1)
    ]
    dates = warehouse.read_drop(spark, root, "download_date").select(
        F.lit("download_date").alias("table_name"),
        F.col("id").cast("int").alias("drop_id"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in ("id", "year", "month", "day")]).alias("line"),
    )
    return reduce(DataFrame.unionByName, [*found, dates])


def _warehouse_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after loading one drop twice."""
    root = shared_folder(spark, "drops")
    for _ in range(2):
        warehouse.load_drop(spark, lambda name: _known(spark, sf_dir, name), root, DROP)
    counts = [
        warehouse.read_drop(spark, root, name).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), "n"
        )
        for name in ("titles", "episodes", "casts", "crew", "titles_casts", "titles_crew")
    ]
    return reduce(DataFrame.unionByName, counts)


def _keys(name: str, key: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return assign_keys(_known(spark, sf_dir, name).select(key).distinct(), key)

    return run


def _optional(name: str, wanted: str) -> dict:
    """A table of queries or SQL of an optional module; nothing if it, or what it needs, cannot be imported."""
    try:
        return dict(getattr(importlib.import_module(name), wanted))
    except ImportError:
        return {}


def _extra() -> dict[str, Query]:
    """What the optional parts add, if they can be imported: the text operators and the corpus pipeline."""
    found: dict[str, Query] = _optional("reelhouse.llm.registry", "QUERIES")
    if found:
        try:
            found["pipeline"] = importlib.import_module("corpus_pipeline").run
        except ImportError:
            pass
    return found


def entry(spark: SparkSession) -> DataFrame:
    """The fifty best rated titles of the smallest tables."""
    return queries()["top_rated"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Name to (spark, sf_dir) -> DataFrame."""
    return {**_library(), **_extra()}


def _library() -> dict[str, Query]:
    people = ("casts", "crew", "titles_casts", "titles_crew")
    return {
        "titles_typed": _raw(titles.titles, "title.basics", "title.ratings"),
        "titles_dim": _plan("titles"),
        "titles_of_a_date": _titles_of_a_date,
        "landed_build": _landed_build,
        "snapshot_dim": _snapshot_dim,
        "episode_summary": _raw(episodes.episode_summary, "title.episode"),
        "episodes_dim": _plan("episodes"),
        "people_age_alive": _raw(credits.people, "name.basics", as_of_year=AS_OF_YEAR),
        "cast_characters": _raw(
            lambda p: credits.explode_characters(credits.cast_credits(p)), "title.principals"
        ),
        "cast_characters_json": _raw(
            lambda p: credits.explode_characters(credits.cast_credits(p), "json"), "title.principals"
        ),
        "crew_roles": _raw(credits.crew_credits, "title.principals"),
        "cast_dim": _plan("casts"),
        "crew_dim": _plan("crew"),
        "casts_checked": _plan("casts", lambda casts: constraints.conform(casts, "casts")),
        "titles_required": _plan(
            "rated_titles",
            lambda t: constraints.require_not_null(t, ["tconst", "primary_title", "original_title"]),
        ),
        "cast_bridge": _plan("titles_casts"),
        "crew_bridge": _plan("titles_crew"),
        "title_keys": _keys("title.basics", "tconst"),
        "person_keys": _keys("name.basics", "nconst"),
        "title_keys_append": _title_keys_append,
        "age_distribution": _age_distribution,
        "genre_counts": _plan("rated_titles", reports.genre_counts),
        "adult_split": _plan("rated_titles", reports.adult_split),
        "adult_pair": _plan("rated_titles", reports.adult_pair),
        "top_rated": _plan("rated_titles", reports.top_rated),
        "top_episode_counts": _report(reports.top_episode_counts, "titles", "episodes"),
        "cast_appearances": _report(
            reports.top_names, "casts", "titles_casts", person_col="cast_id", limit=100
        ),
        "crew_appearances": _report(
            reports.top_names, "crew", "titles_crew", person_col="crew_id", limit=50
        ),
        "cast_titles_by_person": _report(
            reports.top_names, "casts", "titles_casts", person_col="cast_id", limit=100, by="person"
        ),
        "crew_titles_by_person": _report(
            reports.top_names, "crew", "titles_crew", person_col="crew_id", limit=50, by="person"
        ),
        "people_of_top_titles": _report(reports.people_of_top_titles, "titles", *people),
        **{f"dq_{name.replace('.', '_')}": _suite(name) for name in SUITES},
        "dq_title_basics_marker_is_null": _suite("title.basics", sentinel_is_null=True),
        "dq_all_files": _all_files,
        "dq_examples": _examples,
        "dq_stored_results": _stored_results,
        "dq_failing_rows": _failing_rows,
        "dq_repeated_principals": _repeated_principals,
        "constraint_report": _constraint_report,
        "cast_losses": _cast_losses,
        "orphan_report": _orphan_report,
        "latest_snapshot": _latest_snapshot,
        "idempotent_load": _idempotent_load,
        "incremental_manifest": _incremental_manifest,
        "streamed_drops": _streamed_drops,
        "tsv_round_trip": _tsv_round_trip,
        "warehouse_reload": _warehouse_reload,
        "two_drops": _two_drops,
        "declared_tables": _declared_tables,
        "quarantined_lines": _quarantined_lines,
        "watched_landing": _watched_landing,
        "mixed_headers": _mixed_headers,
    }


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL over the same tables."""
    from oracle_queries import QUERIES

    return {**QUERIES, **_optional("reelhouse.llm.registry", "SQL")}
