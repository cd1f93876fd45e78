import random

import pytest

from reelhouse.plans import reports
from tests.conftest import rows
from tests.test_builders import build

TITLE = "id long, tconst string, primary_title string, num_votes int, av_rating decimal(10,1)"
PERSON = "id long, nconst string, name string, age int"


@pytest.fixture(scope="module")
def tables(film):
    names = ("titles", "casts", "crew", "titles_casts", "titles_crew")
    return dict(zip(names, build(film)))


def test_age_distribution_counts_both_sides(tables):
    # nm1 (50) is cast and crew; nm3 (521) is implausible.
    assert rows(reports.age_distribution(tables["casts"], tables["crew"])) == [(50, 2), (51, 1), (61, 1)]


def test_genre_counts(tables):
    counted = reports.genre_counts(tables["titles"])
    assert [tuple(r) for r in counted.collect()] == [("Crime", 1), ("Comedy", 2), ("War", 2), ("Drama", 3)]
    genres = tables["titles"].selectExpr(
        "sum(int(genre_1 is not null) + int(genre_2 is not null) + int(genre_3 is not null)) n"
    )
    assert sum(r.n for r in counted.collect()) == genres.first().n


def test_adult(spark, tables):
    assert rows(reports.adult_split(tables["titles"])) == [(False, 3), (True, 3)]
    assert rows(reports.adult_pair(tables["titles"])) == [(3, 3)]
    unknown = spark.createDataFrame([(None,), (True,)], "is_adult boolean")
    assert rows(reports.adult_split(unknown)) == sorted([(None, 0), (True, 1)], key=repr)


def test_top_rated_breaks_ties_by_key(tables):
    ranked = [r.primary_title for r in reports.top_rated(tables["titles"], None).collect()]
    assert ranked == ['"Two', "Three", "One", "Four", "Seven", "Five"]  # no votes comes last
    assert [r.primary_title for r in reports.top_rated(tables["titles"], 2).collect()] == ranked[:2]


def test_top_episode_counts(spark, film, tables):
    from reelhouse.plans.episodes import episodes

    built = episodes(film["title.episode"], tables["titles"])
    got = [tuple(r) for r in reports.top_episode_counts(tables["titles"], built, 3).collect()]
    assert got == [("Five", 7), ("Five", 3), ("Five", 2)]


def test_top_names(tables):
    by_name = reports.top_names(tables["casts"], tables["titles_casts"], "cast_id", None)
    assert [tuple(r) for r in by_name.collect()] == [("Ann", 4), ("Bob", 3)]  # two people named Ann
    by_person = reports.top_names(tables["casts"], tables["titles_casts"], "cast_id", None, "person")
    assert [tuple(r) for r in by_person.collect()] == [("nm1", "Ann", 2), ("nm2", "Bob", 2), ("nm5", "Ann", 1)]
    with pytest.raises(ValueError):
        reports.top_names(tables["casts"], tables["titles_casts"], "cast_id", 1, "other")


def test_top_names_without_a_name(spark):
    people = spark.createDataFrame([(1, "nm1", None, 1)], PERSON)
    bridge = spark.createDataFrame([(1, 1), (1, 1)], "title_id long, cast_id long")
    assert rows(reports.top_names(people, bridge, "cast_id", None)) == [(None, 0)]


def full_product(titles, casts, crew, titles_casts, titles_crew, limit):
    """The report word for word: all pairs, sorted, cut."""
    rated = {r.id: r for r in titles.collect()}
    cast, who = {r.id: r for r in casts.collect()}, {r.id: r for r in crew.collect()}
    last = lambda v: (v is None, v or "")
    pairs = []
    for c in titles_casts.collect():
        for w in titles_crew.collect():
            if c.title_id == w.title_id and c.title_id in rated:
                t = rated[c.title_id]
                order = (
                    (t.num_votes is None, -(t.num_votes or 0)),
                    (t.av_rating is None, -(t.av_rating or 0)),
                    t.tconst, c.cast_id, last(c.character), w.crew_id, last(w.role),
                )
                m, n = who[w.crew_id], cast[c.cast_id]
                pairs.append((order, (m.name, m.age, n.name, n.age, t.primary_title)))
    return [row for _, row in sorted(pairs, key=lambda p: p[0])[:limit]]


@pytest.mark.parametrize("limit", [1, 3, 10, 40, 2000])
def test_people_of_top_titles_equals_the_cut_product(spark, limit):
    rng = random.Random(11)
    titles = spark.createDataFrame(
        [(i, f"tt{i}", f"T{i}", rng.choice([None, 5, 5, 9]), None) for i in range(12)], TITLE
    )
    casts = spark.createDataFrame([(i, f"nm{i}", f"C{i % 5}", i) for i in range(15)], PERSON)
    crew = spark.createDataFrame([(i, f"nm{i}", f"W{i % 5}", i) for i in range(15)], PERSON)
    pick = lambda: 3 if rng.random() < 0.4 else rng.randrange(10)
    titles_casts = spark.createDataFrame(
        [(pick(), rng.randrange(15), rng.choice([None, "a", "b"])) for _ in range(60)],
        "title_id long, cast_id long, character string",
    )
    titles_crew = spark.createDataFrame(
        [(pick(), rng.randrange(15), rng.choice(["x", "y"])) for _ in range(50)],
        "title_id long, crew_id long, role string",
    )
    tables = (titles, casts, crew, titles_casts, titles_crew)
    got = [tuple(r) for r in reports.people_of_top_titles(*tables, limit).collect()]
    want = full_product(*tables, limit)
    assert len(got) == len(want) and got[:1] == want[:1]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_a_title_gives_no_more_pairs_than_the_limit(spark):
    """Two titles: one with many equal cast rows, one with many rows on both sides."""
    limit = 1000
    cast = [(1, "cast", 1 + i // 30, "a") for i in range(90)] + [(2, "cast", i, None) for i in range(1500)]
    crew = [(1, "crew", i, "x") for i in range(200)] + [(2, "crew", i, "x") for i in range(1200)]
    members = spark.createDataFrame(cast + crew, "title_id long, side string, id long, part string")
    pairs = reports._first_pairs(members, ["title_id"], limit)
    got = {1: [], 2: []}
    for r in pairs.collect():
        got[r.title_id].append((r.cast_id, r.crew_id))
    for title in got:
        one, other = ([m[2] for m in side if m[0] == title] for side in (cast, crew))
        assert sorted(got[title]) == sorted((c, w) for c in one for w in other)[:limit]


def test_people_of_top_titles_without_a_match(tables):
    none = tables["titles_crew"].filter("false")
    found = reports.people_of_top_titles(
        tables["titles"], tables["casts"], tables["crew"], tables["titles_casts"], none
    )
    assert found.count() == 0
