import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reelhouse.functions import columns
from reelhouse.operators.joins import hot_keys
from reelhouse.operators.keys import assign_keys
from reelhouse.plans import credits, episodes, titles
from tests.conftest import rows


def typed(film):
    built = titles.titles(film["title.basics"], film["title.ratings"])
    return {r.tconst: r for r in built.collect()}


def test_titles(film):
    got = typed(film)
    assert sorted(got) == ["tt01", "tt02", "tt03", "tt04", "tt05", "tt07"]  # unrated ones drop
    assert got["tt01"].av_rating == Decimal("8.4") and got["tt01"].num_votes == 100
    assert [got["tt01"][f"genre_{i}"] for i in (1, 2, 3)] == ["Drama", "War", "Crime"]
    assert [got["tt02"][f"genre_{i}"] for i in (1, 2, 3)] == ["Drama", "War", None]
    assert got["tt04"].genre_1 is None  # and not the marker
    assert (got["tt04"].start_year, got["tt04"].end_year) == (1993, 1994)
    assert got["tt03"].start_year is None
    assert got["tt05"].start_year is None and got["tt05"].end_year is None  # do not fit, do not parse
    assert got["tt05"].num_votes is None


def test_adult_flag_is_false_for_zero_only(film):
    got = typed(film)
    assert {t: got[t].is_adult for t in ("tt01", "tt02", "tt04", "tt07")} == {
        "tt01": False, "tt02": True, "tt04": True, "tt07": True,
    }


def test_types(film):
    built = titles.titles(film["title.basics"], film["title.ratings"])
    kinds = dict(built.dtypes)
    assert kinds["av_rating"] == "decimal(10,1)" and kinds["num_votes"] == "int"
    assert {kinds[c] for c in ("start_year", "end_year", "runtime_minutes")} == {"smallint"}


def test_numbers_parse_strictly(spark):
    df = spark.createDataFrame([("1",), ("1.5",), (" 2 ",), ("x",), ("",), ("40000",)], "c string")
    got = [r[0] for r in df.select(columns.to_type(F.col("c"), "smallint")).collect()]
    assert got == [1, None, 2, None, None, None]


def test_snapshot_dim_and_lookup(spark, film):
    days = [datetime.date(2021, 6, 26), datetime.date(2020, 1, 5), datetime.date(2021, 6, 26)]
    dates = spark.createDataFrame([(d,) for d in days], "snapshot_date date")
    dim = titles.snapshot_dim(dates)
    assert [f.dataType.simpleString() for f in dim.schema] == ["bigint"] + ["smallint"] * 3
    ids = {(r.year, r.month, r.day): r.id for r in dim.collect()}
    assert sorted(ids) == [(2020, 1, 5), (2021, 6, 26)] and sorted(ids.values()) == [1, 2]

    def stamped(date):
        built = titles.titles(film["title.basics"], film["title.ratings"], dim, date)
        return {r.download_date_id for r in built.collect()}

    assert stamped(datetime.date(2020, 1, 5)) == {ids[2020, 1, 5]}
    assert stamped(None) == {ids[2021, 6, 26]}
    with pytest.raises(PySparkException, match="no snapshot"):
        stamped(datetime.date(1999, 1, 1))


def test_snapshot_row(spark):
    day = datetime.date(2021, 6, 26)
    assert rows(titles.snapshot_dim(titles.snapshot_row(spark, day))) == [(1, 2021, 6, 26)]


def test_episode_summary_keeps_columns_apart(film):
    # Highest number and not count; season and total in their own columns; the rows with only one of
    # the two numbers count nowhere.
    assert rows(episodes.episode_summary(film["title.episode"])) == sorted(
        [("tt05", 1, 7), ("tt05", 2, 3), ("tt05", None, 2), ("tt07", None, 1), ("tt06", 1, 9)], key=repr
    )


def test_episodes_need_a_title(film):
    ids = assign_keys(titles.titles(film["title.basics"], film["title.ratings"]), "tconst")
    built = episodes.episodes(film["title.episode"], ids)
    assert built.columns == ["title_id", "season", "total_episodes"]
    assert built.count() == 4  # tt06 has no rating


def test_people(film):
    got = {r.nconst: (r.age, r.is_alive) for r in credits.people(film["name.basics"], 2021).collect()}
    assert got["nm1"] == (50, False)
    assert got["nm2"] == (61, True)
    assert got["nm3"] == (521, True)
    assert got["nm4"] == (None, None)  # death without birth
    assert got["nm5"] == (None, None)


def test_cast_and_crew_split_principals(film):
    principals = film["title.principals"]
    cast, crew = credits.cast_credits(principals), credits.crew_credits(principals)
    without = principals.filter("category is null").count()
    assert without == 1
    assert cast.count() + crew.count() + without == principals.count()
    assert {r.role for r in crew.collect()} == {"director", "writer", "producer"}


def characters_of(film, tconst, parse="split"):
    cast = credits.cast_credits(film["title.principals"]).filter(F.col("tconst") == tconst)
    return rows(credits.explode_characters(cast, parse), "nconst", "character")


def test_characters(film):
    assert characters_of(film, "tt01") == [("nm1", "Hero"), ("nm2", "Maid"), ("nm2", "Queen")]
    assert characters_of(film, "tt02") == [("nm1", None)]  # the marker
    assert characters_of(film, "tt07") == [("nm2", None)]  # truly missing: the row stays
    assert characters_of(film, "tt03") == [("nm5", " the old"), ("nm5", "King")]
    assert characters_of(film, "tt03", "json") == [("nm5", "King, the [old]")]
    with pytest.raises(ValueError):
        characters_of(film, "tt03", "other")


def test_person_dim_has_one_row_each(spark, film):
    persons = credits.people(film["name.basics"], 2021)
    cast = credits.cast_credits(film["title.principals"])
    crew = credits.crew_credits(film["title.principals"])
    # nm6 acts only in an unrated title and stays; nm9 is unknown; nm7 has no credit.
    assert rows(credits.person_dim(cast, persons), "nconst") == [("nm1",), ("nm2",), ("nm5",), ("nm6",)]
    assert rows(credits.person_dim(crew, persons), "nconst") == [("nm1",), ("nm3",), ("nm4",)]
    twice = persons.unionByName(persons.withColumn("age", F.col("age") + 1))
    again = credits.person_dim(cast, twice)
    assert again.count() == 4
    assert rows(again) == rows(credits.person_dim(cast.repartition(7), twice.repartition(5)))


def build(film, hot_rows=None):
    title_ids = assign_keys(titles.titles(film["title.basics"], film["title.ratings"]), "tconst")
    persons = credits.people(film["name.basics"], 2021)
    cast = credits.cast_credits(film["title.principals"])
    crew = credits.crew_credits(film["title.principals"])
    cast_dim = assign_keys(credits.person_dim(cast, persons), "nconst")
    crew_dim = assign_keys(credits.person_dim(crew, persons), "nconst")

    def hot(held):
        if hot_rows is None:
            return {}
        return {
            "hot_persons": hot_keys(held, "nconst", hot_rows),
            "hot_titles": hot_keys(held, "tconst", hot_rows),
        }

    return (
        title_ids,
        cast_dim,
        crew_dim,
        credits.titles_casts(cast, cast_dim, title_ids, **hot(cast)),
        credits.titles_crew(crew, crew_dim, title_ids, **hot(crew)),
    )


def test_credit_counts(film):
    counts = credits.credit_counts(film["title.principals"], "nconst")
    assert rows(counts) == [
        ("nm1", 2, 1), ("nm2", 2, 0), ("nm3", 0, 3), ("nm4", 0, 1), ("nm5", 1, 0), ("nm6", 1, 0),
        ("nm9", 1, 0),
    ]


@pytest.mark.parametrize("hot_rows", [None, 1, 2])
def test_bridges(film, hot_rows):
    title_ids, cast_dim, crew_dim, casts, crew = build(film, hot_rows)
    title_of = {r.id: r.tconst for r in title_ids.collect()}
    cast_of = {r.id: r.nconst for r in cast_dim.collect()}
    crew_of = {r.id: r.nconst for r in crew_dim.collect()}
    got = sorted((title_of[r.title_id], cast_of[r.cast_id], r.character or "") for r in casts.collect())
    assert got == [
        ("tt01", "nm1", "Hero"),
        ("tt01", "nm2", "Maid"),
        ("tt01", "nm2", "Queen"),
        ("tt02", "nm1", ""),
        ("tt03", "nm5", " the old"),
        ("tt03", "nm5", "King"),
        ("tt07", "nm2", ""),
    ]
    got = sorted((title_of[r.title_id], crew_of[r.crew_id], r.role) for r in crew.collect())
    assert got == [
        ("tt01", "nm3", "director"),
        ("tt02", "nm1", "producer"),
        ("tt02", "nm4", "writer"),
        ("tt03", "nm3", "director"),
        ("tt04", "nm3", "director"),
    ]
