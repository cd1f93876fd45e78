"""One commit for a drop: what breaks off is not seen, what is stale is refused, declared tables are filled."""

import datetime

import pytest
from pyspark.sql import functions as F

from reelhouse.plans import warehouse
from reelhouse.schemas import TABLES
from reelhouse.sources import sinks, versions
from tests.conftest import DROP, rows

NEXT = datetime.date(2021, 6, 27)


def seen(spark, root, date=None):
    return {n: rows(warehouse.read_drop(spark, root, n, date)) for n in TABLES}


@pytest.fixture(scope="module")
def later(spark, film):
    """A second drop: a title and its credits go, a new title and a new person come."""
    basics = spark.createDataFrame(
        [["aa00", "movie", "New", "New", "0", "2021", None, "9", None]], film["title.basics"].schema
    )
    rated = spark.createDataFrame([["aa00", "9.9", "1"]], film["title.ratings"].schema)
    credit = spark.createDataFrame([["aa00", "1", "nm7", "actor", None, None]], film["title.principals"].schema)
    return {
        **film,
        "title.basics": film["title.basics"].filter("tconst <> 'tt01'").unionByName(basics),
        "title.ratings": film["title.ratings"].unionByName(rated),
        "title.principals": film["title.principals"].unionByName(credit),
    }


@pytest.fixture(scope="module")
def whole(spark, film, later, tmp_path_factory):
    """The tables of two drops that were loaded without trouble."""
    root = str(tmp_path_factory.mktemp("whole"))
    warehouse.load_drop(spark, film.__getitem__, root, DROP)
    first = seen(spark, root)
    warehouse.load_drop(spark, later.__getitem__, root, NEXT)
    return first, seen(spark, root), seen(spark, root, DROP)


def test_a_load_that_breaks_off_anywhere_is_not_seen(spark, film, later, whole, tmp_path, monkeypatch):
    root, (first, second, _) = str(tmp_path), whole
    warehouse.load_drop(spark, film.__getitem__, root, DROP)
    write, broken = versions.Load.write, 0
    written = []
    monkeypatch.setattr(versions.Load, "write", lambda load, name, df: (written.append(name), write(load, name, df))[1])
    version = versions.latest(spark, root)
    for stop in [*TABLES, "publish"]:
        def breaking(load, name, df, stop=stop):
            found = write(load, name, df)
            if name == stop:
                raise OSError(f"lost after {name}")
            return found

        def lost(load):
            raise OSError("lost before the manifest")

        with monkeypatch.context() as patch:
            patch.setattr(versions.Load, "write", breaking)
            if stop == "publish":
                patch.setattr(versions.Load, "publish", lost)
            with pytest.raises(OSError, match="lost"):
                warehouse.load_drop(spark, later.__getitem__, root, NEXT)
        assert versions.latest(spark, root) == version
        broken += 1
    assert broken == len(TABLES) + 1 and seen(spark, root) == first
    warehouse.load_drop(spark, later.__getitem__, root, NEXT)
    assert seen(spark, root) == second


def test_an_earlier_version_can_be_read(spark, film, later, whole, tmp_path):
    root, (first, second, kept) = str(tmp_path), whole
    one = warehouse.load_drop(spark, film.__getitem__, root, DROP)
    two = warehouse.load_drop(spark, later.__getitem__, root, NEXT)
    assert (one.number, two.number) == (1, 2)
    assert rows(warehouse.read_drop(spark, root, "titles", number=1)) == first["titles"]
    assert rows(warehouse.read_drop(spark, root, "titles")) == second["titles"]
    assert seen(spark, root, DROP)["titles"] == kept["titles"] == first["titles"]
    assert rows(warehouse.read_drop(spark, root, "titles", number=9)) == []


def test_a_stale_writer_is_refused(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(2)
    early, late = versions.Load.begun(spark, root), versions.Load.begun(spark, root)
    for load in (early, late):
        load.replace("t", "a", df)
    early.publish()
    with pytest.raises(versions.StaleWriter):
        late.publish()
    assert versions.latest(spark, root).load == early.id


def test_of_two_manifests_the_earlier_counts(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    early, late = versions.Load.begun(spark, root), versions.Load.begun(spark, root)
    for load in (early, late):
        load.replace("t", "a", spark.range(2))
    early.publish()
    plain = versions.latest
    monkeypatch.setattr(versions, "latest", lambda s, r, number=None: plain(s, r, number) if number else late.base)
    with pytest.raises(versions.StaleWriter, match="another load"):
        late.publish()
    assert plain(spark, root).load == early.id


def test_tables_that_grow_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "MOST_PARTS", 2)
    root = str(tmp_path)
    for i in range(6):
        load = versions.Load.begun(spark, root)
        load.grow("keys/t", spark.createDataFrame([(f"k{i}", i + 1)] if i != 3 else [], "k string, id long"), "id")
        version = load.publish()
        assert len(version.of("keys/t")) <= 3
    found = version.read(spark, "keys/t", spark.createDataFrame([], "k string, id long").schema)
    assert rows(found, "id") == [(1,), (2,), (3,), (5,), (6,)]
    assert versions.Load.begun(spark, root).high("keys/t") == 6


def test_a_drop_without_new_keys_adds_none(spark, film, tmp_path):
    root = str(tmp_path)
    one = warehouse.load_drop(spark, film.__getitem__, root, DROP)
    two = warehouse.load_drop(spark, film.__getitem__, root, NEXT)
    for kind in ("title_ids", "cast_ids", "crew_ids", "episode_ids"):
        assert one.of(f"keys/{kind}") == two.of(f"keys/{kind}") != []


def test_nothing_to_load_is_a_version_too(spark, tmp_path):
    root = str(tmp_path)
    versions.Load.begun(spark, root).publish()
    assert versions.latest(spark, root).number == 1 and versions.latest(spark, root).entries == ()
    versions.Load.begun(spark, root).publish()
    assert versions.latest(spark, root).number == 2


def test_declared_tables_are_loaded(spark, film, later, tmp_path):
    root, database = str(tmp_path / "house"), "declared_films"
    sinks.create_warehouse(spark, database, reset=True, location=str(tmp_path / "db"))
    for day, drop in ((DROP, film), (NEXT, later), (DROP, film)):
        warehouse.load_drop(spark, drop.__getitem__, root, day, database=database)
    for name in TABLES:
        table = spark.table(f"{database}.{name}")
        for day in (DROP, NEXT):
            held = table if name == "download_date" else table.filter(F.col("snapshot_date") == F.lit(day))
            want = warehouse.read_drop(spark, root, name, day)
            assert rows(held, *want.columns) == rows(want)
    assert spark.sql(f"SHOW PARTITIONS {database}.titles").count() == 2
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|length"):
        spark.sql(
            f"INSERT INTO {database}.casts PARTITION (snapshot_date = DATE'2021-06-28')"
            f" (id, name, age, is_alive, nconst) VALUES (1, 'x', 1, true, repeat('n', 16))"
        )
    sinks.create_warehouse(spark, database, reset=True)
    assert spark.table(f"{database}.titles").count() == 0
    spark.sql(f"DROP DATABASE {database} CASCADE")
