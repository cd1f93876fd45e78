import datetime

import pytest
from pyspark.sql import functions as F

from reelhouse.plans import warehouse
from reelhouse.schemas import TABLES
from reelhouse.sources import sinks
from reelhouse.sources.files import drop_files, list_files, read_raw
from reelhouse.streaming import drops
from tests.conftest import DROP, FILM, N, rows, write_tsv

NEXT = datetime.date(2021, 6, 27)


def test_append_and_append_new(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read_table(spark, path) is None
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    sinks.load(first, path, "append_new", ["k"])
    sinks.load(first, path, "append_new", ["k"])
    sinks.load(first.withColumn("k", F.lit("c")), path, "append_new", ["k"])
    assert rows(spark.read.parquet(path)) == [("a", 2), ("b", 1), ("c", 2)]
    assert spark.read.parquet(path).columns == ["k", "v"]
    sinks.load(first, path)
    assert spark.read.parquet(path).count() == 6


def test_new_rows_keep_the_column_order(spark):
    df = spark.createDataFrame([(1, "a")], "v int, k string")
    assert sinks.new_rows(df, df, ["k"]).columns == ["v", "k"]


def test_unknown_mode(spark, tmp_path):
    path, first = str(tmp_path / "t"), spark.range(1)
    with pytest.raises(ValueError):
        sinks.load(first, path, "other")


def test_overwrite_snapshot_leaves_other_dates(spark, tmp_path):
    path = str(tmp_path / "t")

    def day(date, *values):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        return df.withColumn("snapshot_date", F.lit(date))

    sinks.load(day(DROP, 1, 2), path, "overwrite_snapshot")
    sinks.load(day(NEXT, 3), path, "overwrite_snapshot")
    sinks.load(day(NEXT, 4), path, "overwrite_snapshot")
    assert rows(spark.read.parquet(path), "v") == [(1,), (2,), (4,)]


def test_create_warehouse(spark):
    for _ in range(2):
        sinks.create_warehouse(spark, "films")
    shown = spark.sql("SHOW TABLES IN films").filter("not isTemporary")
    names = {r.tableName for r in shown.collect()}
    assert names == set(TABLES)
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE films.titles").collect()}
    assert described["tconst"] == "varchar(20)" and described["start_year"] == "smallint"
    spark.sql("INSERT INTO films.crew VALUES (1, 'Ann', 50, false, 'nm1', DATE'2021-06-26')")
    sinks.create_warehouse(spark, "films")
    assert spark.table("films.crew").count() == 1
    sinks.create_warehouse(spark, "films", reset=True)
    assert spark.table("films.crew").count() == 0


def tables_of(spark, root, date=None):
    return {n: rows(warehouse.read_drop(spark, root, n, date)) for n in TABLES}


@pytest.fixture(scope="module")
def loaded(spark, film, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    warehouse.load_drop(spark, film.__getitem__, root, DROP)
    return root, tables_of(spark, root)


def test_load_drop(loaded):
    _, tables = loaded
    counts = {n: len(r) for n, r in tables.items()}
    assert counts == {
        "download_date": 1, "titles": 6, "episodes": 4, "casts": 4, "crew": 3,
        "titles_casts": 7, "titles_crew": 5,
    }


def test_loading_twice_changes_nothing(spark, film, loaded):
    root, before = loaded
    warehouse.load_drop(spark, film.__getitem__, root, DROP)
    assert tables_of(spark, root, DROP) == before


def test_ids_outlive_a_drop(spark, film, loaded):
    root, before = loaded
    extra = spark.createDataFrame([["aa00", "movie", "New", "New", "0", "2021", None, "9", None]],
                                  film["title.basics"].schema)
    rated = spark.createDataFrame([["aa00", "9.9", "1"]], film["title.ratings"].schema)
    later = dict(film)
    later["title.basics"] = film["title.basics"].filter("tconst <> 'tt01'").unionByName(extra)
    later["title.ratings"] = film["title.ratings"].unionByName(rated)
    warehouse.load_drop(spark, later.__getitem__, root, NEXT)

    def ids(date):
        return {r.tconst: r.id for r in warehouse.read_drop(spark, root, "titles", date).collect()}

    old, new = ids(DROP), ids(NEXT)
    assert new.pop("aa00") == max(old.values()) + 1
    assert "tt01" not in new and all(old[k] == i for k, i in new.items())
    assert warehouse.read_drop(spark, root, "titles").count() == 6  # the latest drop
    assert tables_of(spark, root, DROP)["titles"] == before["titles"]
    assert warehouse.read_drop(spark, root, "download_date").count() == 2


def test_dashboards_bring_their_sql(spark, loaded):
    root, _ = loaded
    warehouse.register_views(spark, root, DROP)
    found = spark.sql("""
        SELECT t.primary_title AS `Film`, count(DISTINCT c.cast_id) AS `Cast Size`
        FROM titles t, titles_casts c WHERE t.id = c.title_id
        GROUP BY t.primary_title ORDER BY 2 DESC LIMIT 1""")
    assert found.columns == ["Film", "Cast Size"] and rows(found) == [("One", 2)]


def land_both_ways(spark, source, out):
    """Rows a stream run and a manifest run have landed so far."""
    drops.stream_drops(spark, "title.ratings", source, f"{out}/stream", f"{out}/checkpoint")
    taken = drops.land(spark, "title.ratings", source, f"{out}/batch", f"{out}/manifest")
    stream, batch = spark.read.parquet(f"{out}/stream"), spark.read.parquet(f"{out}/batch")
    assert rows(stream, *sorted(stream.columns)) == rows(batch, *sorted(batch.columns))
    return taken, rows(batch, "tconst", "snapshot_date")


def test_drops_land_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write_tsv(source / "2021-06" / "26" / "title.ratings.tsv.gz", "title.ratings", [["tt1", "1.0", N]], zipped=True)
    write_tsv(source / "2021-06" / "26" / "title.basics.tsv", "title.basics", FILM["title.basics"])
    assert land_both_ways(spark, str(source), out) == (1, [("tt1", DROP)])
    assert land_both_ways(spark, str(source), out) == (0, [("tt1", DROP)])
    write_tsv(source / "2021-06" / "27" / "title.ratings.tsv", "title.ratings", [["tt1", "1.1", "5"]])
    assert land_both_ways(spark, str(source), out) == (1, [("tt1", DROP), ("tt1", NEXT)])


def test_a_run_broken_off_before_the_manifest_is_repeated(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write_tsv(source / "2021-06" / "26" / "title.ratings.tsv", "title.ratings", [["tt1", "1.0", "2"]])
    for manifest in ("lost", "kept"):
        drops.land(spark, "title.ratings", str(source), f"{out}/batch", f"{out}/{manifest}")
    assert spark.read.parquet(f"{out}/batch").count() == 1


def test_a_late_file_replaces_its_date(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    day = source / "2021-06" / "26" / "title.ratings.tsv"
    write_tsv(day / "part-0.tsv", "title.ratings", [["tt1", "1.0", "2"]])
    args = (spark, "title.ratings", str(source), f"{out}/batch", f"{out}/manifest")
    assert drops.land(*args) == 1
    write_tsv(day / "part-1.tsv", "title.ratings", [["tt2", "1.0", "2"]])
    assert drops.land(*args) == 1 and drops.land(*args) == 0
    assert rows(spark.read.parquet(f"{out}/batch"), "tconst") == [("tt1",), ("tt2",)]


def test_pending_files(spark, drop):
    listing = list_files(spark, drop_files(drop, "*"))
    done = listing.limit(2).select("path")
    assert drops.pending_files(listing, None).count() == len(FILM)
    assert drops.pending_files(listing, done).count() == len(FILM) - 2


@pytest.mark.parametrize("decode", [True, False])
def test_landed_rows_are_those_read_raw(spark, drop, tmp_path, decode):
    want = rows(read_raw(spark, drop, "title.basics", DROP, decode))
    drops.stream_drops(
        spark, "title.basics", drop, str(tmp_path / "s"), str(tmp_path / "c"), decode_sentinel=decode
    )
    drops.land(spark, "title.basics", drop, str(tmp_path / "b"), str(tmp_path / "m"), decode)
    for way in ("s", "b"):
        found = spark.read.parquet(str(tmp_path / way))
        assert found.filter("bad_line is not null or source_file is not null").count() == 0
        assert rows(found.drop("snapshot_date", "bad_line", "source_file")) == want


def test_an_earlier_drop_can_be_loaded_again(spark, film, tmp_path):
    root = str(tmp_path)
    for day in (DROP, NEXT, DROP):
        warehouse.load_drop(spark, film.__getitem__, root, day)
    dates = {r.id: r.day for r in warehouse.read_drop(spark, root, "download_date").collect()}
    for day in (DROP, NEXT):
        stamps = warehouse.read_drop(spark, root, "titles", day).select("download_date_id").distinct().collect()
        assert [dates[r[0]] for r in stamps] == [day.day]
    first, second = (warehouse.read_drop(spark, root, "episodes", d) for d in (DROP, NEXT))
    assert rows(first) == rows(second)  # ids included


def test_a_table_that_comes_out_empty_is_replaced(spark, film, tmp_path):
    root = str(tmp_path)
    no_crew = {**film, "title.principals": film["title.principals"].filter("category in ('actor', 'actress')")}
    warehouse.load_drop(spark, film.__getitem__, root, DROP)
    assert warehouse.read_drop(spark, root, "titles_crew").count() > 0
    warehouse.load_drop(spark, no_crew.__getitem__, root, DROP)
    assert warehouse.read_drop(spark, root, "titles_crew").count() == 0
    assert warehouse.read_drop(spark, root, "crew").count() == 0


def test_a_first_drop_with_an_empty_table_can_be_read(spark, film, tmp_path):
    none = {**film, "title.episode": film["title.episode"].limit(0)}
    warehouse.load_drop(spark, none.__getitem__, str(tmp_path), DROP)
    assert warehouse.read_drop(spark, str(tmp_path), "episodes").count() == 0


def test_look_alikes_are_not_read_and_two_forms_fail(spark, tmp_path):
    write_tsv(tmp_path / "title.ratings.tsv", "title.ratings", [["tt1", "1.0", "1"]])
    write_tsv(tmp_path / "title.ratings.tsv.bak", "title.ratings", [["tt2", "1.0", "1"]])
    assert read_raw(spark, str(tmp_path), "title.ratings").count() == 1
    write_tsv(tmp_path / "title.ratings.tsv.gz", "title.ratings", [["tt1", "1.0", "1"]], zipped=True)
    with pytest.raises(ValueError, match="several forms"):
        read_raw(spark, str(tmp_path), "title.ratings")


def test_undated_folders_are_left_alone(spark, tmp_path):
    write_tsv(tmp_path / "x" / "y" / "title.ratings.tsv", "title.ratings", [["tt1", "1.0", "1"]])
    write_tsv(tmp_path / "2021-06" / "26" / "title.ratings.tsv", "title.ratings", [["tt2", "1.0", "1"]])
    landed = drops.land(spark, "title.ratings", str(tmp_path), str(tmp_path / "out"), str(tmp_path / "done"))
    assert landed == 1 and spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_lines_that_do_not_fit_land_apart(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    day = source / "2021-06" / "26" / "title.ratings.tsv"
    write_tsv(day / "a.tsv", "title.ratings", [["tt1", "1.0", N], ["tt2", "2.0"], ["tt3", "3.0", "4", "x"]])
    write_tsv(day / "b.tsv.gz", "title.ratings", [["tt4", "4.0", "1"], ["alone"]], zipped=True)
    write_tsv(source / "2021-06" / "27" / "title.ratings.tsv", "title.ratings", [["tt5", "5.0", "2"]])
    drops.stream_drops(spark, "title.ratings", str(source), f"{out}/stream", f"{out}/checkpoint")
    drops.land(spark, "title.ratings", str(source), f"{out}/batch", f"{out}/manifest")
    for way in ("stream", "batch"):
        good = drops.read_landed(spark, f"{out}/{way}", "title.ratings", DROP)
        assert rows(good) == [("tt1", "1.0", None), ("tt4", "4.0", "1")]
        bad = drops.read_quarantine(spark, f"{out}/{way}", "title.ratings", DROP).collect()
        assert sorted((r.bad_line, r.source_file.rsplit("/", 1)[1]) for r in bad) == [
            ("alone", "b.tsv.gz"), ("tt2\t2.0", "a.tsv"), ("tt3\t3.0\t4\tx", "a.tsv")
        ]
        assert drops.read_quarantine(spark, f"{out}/{way}", "title.ratings", NEXT).count() == 0
        assert drops.read_quarantine(spark, f"{out}/{way}", "title.ratings").count() == 3
    # a corrected file replaces its date, and what was set aside goes
    write_tsv(day / "c.tsv", "title.ratings", [["tt6", "1.0", "1"]])
    (day / "a.tsv").write_text("")
    (day / "b.tsv.gz").unlink()
    drops.land(spark, "title.ratings", str(source), f"{out}/batch", f"{out}/manifest")
    assert drops.read_quarantine(spark, f"{out}/batch", "title.ratings").count() == 0


def test_a_file_in_two_forms_is_not_landed_twice(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    day = source / "2021-06" / "26"
    write_tsv(day / "title.ratings.tsv", "title.ratings", [["tt1", "1.0", "2"]])
    write_tsv(day / "title.ratings.tsv.gz", "title.ratings", [["tt1", "1.0", "2"]], zipped=True)
    with pytest.raises(ValueError, match="several forms"):
        drops.land(spark, "title.ratings", str(source), f"{out}/batch", f"{out}/manifest")
    with pytest.raises(ValueError, match="several forms"):
        drops.stream_drops(spark, "title.ratings", str(source), f"{out}/stream", f"{out}/checkpoint")
