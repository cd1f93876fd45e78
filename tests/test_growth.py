"""Steps that took too long on larger tables: what they must not do again, with the same results."""

import datetime

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import constraints, quality
from reelhouse.operators.joins import hottest
from reelhouse.operators.keys import assign_keys
from reelhouse.operators.suites import SUITES
from reelhouse.plans import credits, titles, warehouse
from reelhouse.streaming import drops
from tests.conftest import DROP, FILM, rows, write_tsv

NOW = datetime.datetime(2021, 6, 26, 12, 0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_of_a_suite_are_compiled(spark, film):
    for name in ("title.principals", "title.basics"):
        assert "lambda" not in plan(quality.run_suites({name: film[name]}, SUITES, "run", NOW))
        assert "lambda" not in plan(quality.examples({name: film[name]}, SUITES))


def test_keys_and_references_are_compiled(spark, film):
    links = (("title.principals", "tconst", "title.basics", "tconst"),)
    tables = {name: film[name] for name in ("title.principals", "title.basics")}
    assert "lambda" not in plan(constraints.orphan_report(tables, links))


def test_rows_are_counted_by_their_keys(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, None), (None, None)], "k string, o string")
    rules = [
        {"type": "not_null", "column": "o"}, {"type": "unique", "column": "k"},
        {"type": "unique_together", "columns": ["k", "o"]},
    ]
    found = quality.run_suites({"s": df}, {"s": rules}, "run", NOW)
    assert rows(found, "position", "element_count", "missing_count", "unexpected_count") == [
        (1, 4, 3, 3), (2, 4, 2, 2), (3, 4, 2, 0),
    ]


def test_events_carry_no_words_through_the_shuffle(spark, film):
    text = plan(quality.examples({"title.principals": film["title.principals"]}, SUITES))
    grouped = [line for line in text.splitlines() if "HashAggregate(keys=" in line and "partial_count" in line]
    assert grouped and all("expectation" not in line and "columns" not in line for line in grouped)


def test_a_single_date_is_landed_without_reading_it_off_each_row(spark, tmp_path, monkeypatch):
    def read_off(df):
        raise AssertionError("the date of a row is known")

    monkeypatch.setattr(drops, "_dated", read_off)
    write_tsv(tmp_path / "raw" / "2021-06" / "26" / "title.ratings.tsv", "title.ratings", FILM["title.ratings"])
    watch = quality.Watch("title.ratings", quality.row_rules(SUITES["title.ratings"]))
    paths = [str(tmp_path / name) for name in ("raw", "out", "done")]
    assert drops.land(spark, "title.ratings", *paths, watch=watch) == 1
    landed = drops.read_landed(spark, paths[1], "title.ratings", DROP)
    assert landed.count() == len(FILM["title.ratings"])
    assert not any(c.startswith("_test") for c in spark.read.parquet(paths[1]).columns)


def test_what_is_observed_has_been_compiled(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    watch = quality.Watch("s", [{"type": "matches", "column": "c", "regex": "a"}])
    text = watch.over(df)._jdf.queryExecution().optimizedPlan().toString()
    observed = next(line for line in text.splitlines() if "CollectMetrics" in line)
    assert "RLIKE" not in observed.upper()


def test_heavy_titles_are_found_by_bucket(spark):
    shares = [("hot", 40), ("warm", 20), *[(f"t{i}", 1 + i % 3) for i in range(200)]]
    listed = [(key, "actor" if i % 4 else "writer") for key, n in shares for i in range(n)]
    principals = spark.createDataFrame([*listed, (None, "actor"), ("hot", None)], "tconst string, category string")
    exact, buckets = credits.credit_counts(principals, "tconst"), credits.bucket_counts(principals, "tconst")
    for least in (1, 10, 25, 1000):
        some = credits.heavy_credit_counts(principals, "tconst", buckets, least)
        for n in ("cast_rows", "crew_rows"):
            assert rows(hottest(some, "tconst", n, least, buckets)) == rows(hottest(exact, "tconst", n, least))
    assert rows(credits.heavy_credit_counts(principals, "tconst", buckets, 25)) == [("hot", 30, 10)]
    assert credits.heavy_credit_counts(principals, "tconst", buckets, 1000).count() == 0


def test_titles_are_not_counted_one_by_one(spark, film):
    kept = {}
    tables = warehouse.Catalogue(
        film.__getitem__, titles.snapshot_row(spark, DROP), 2021, keep=lambda n, df: kept.setdefault(n, df)
    )
    assert tables.titles_crew.count() and "credits_by_title" not in kept
    assert "_bucket" in kept["credits_by_title_bucket"].columns


def test_episodes_are_numbered_as_they_are(spark, film):
    seen = {}

    def number(name, df, key):
        seen[name] = df.columns
        return assign_keys(df, key)

    tables = warehouse.Catalogue(film.__getitem__, titles.snapshot_row(spark, DROP), 2021, number=number)
    found = tables.episodes
    assert set(seen["episode_ids"]) == {"_key", "title_id", "season", "total_episodes"}
    assert found.count() == 4 and sorted(r.id for r in found.collect()) == [1, 2, 3, 4]


def test_ids_are_looked_up_without_sorting(spark, film):
    built = titles.titles(film["title.basics"], film["title.ratings"])
    ids = assign_keys(built, "tconst").select("tconst", "id")
    cast = credits.cast_credits(film["title.principals"])
    people = assign_keys(credits.person_dim(cast, credits.people(film["name.basics"], 2021)), "nconst").select("nconst", "id")
    linked = credits.link(cast, people, ids, "cast_id")
    assert plan(linked).count("ShuffledHashJoin") >= 2
    assert "SortMergeJoin" not in plan(built)


def test_characters_are_decoded_after_they_are_spread(spark):
    df = spark.createDataFrame([('["A","\\\\N"]',), (None,), ("",)], "characters string")
    found = credits.explode_characters(df)
    assert "lambda" not in plan(found)
    assert rows(found.filter(F.col("character").isNotNull())) == [("",), ("A",), ("\\\\N",)]


def test_texts_of_a_task_are_looked_up_at_once():
    pa, orcids = pytest.importorskip("pyarrow"), pytest.importorskip("reelhouse.llm.orcids")
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * (1 << 20)] * 10)], names=["text"])
    assert [some.num_rows for some in orcids._chunks(batch)] == [10]
