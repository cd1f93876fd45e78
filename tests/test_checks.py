import datetime
import json

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import constraints, quality
from reelhouse.operators.suites import SUITES, suite_from_json
from reelhouse.sources.files import read_asset, read_raw
from tests.conftest import DROP, FILM, N, rows, write_tsv

NOW = datetime.datetime(2021, 6, 26, 12, 0)


def run(df, *rules, **settings):
    found = quality.run_suites({"s": df}, {"s": list(rules)}, "run", NOW, **settings)
    return {r.position: r for r in found.collect()}


def one(df, rule, **settings):
    r = run(df, rule, **settings)[1]
    return r.element_count, r.missing_count, r.unexpected_count, r.success


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "c string")


def rule(kind, **settings):
    return {"type": kind, "column": "c", **settings}


def test_suites_hold_eighty_expectations():
    sizes = {name: len(rules) for name, rules in SUITES.items()}
    assert sizes == {
        "title.basics": 21, "title.principals": 13, "name.basics": 13, "title.akas": 10,
        "title.episode": 8, "title.ratings": 8, "title.crew": 7,
    }
    kinds = [r["type"] for rules in SUITES.values() for r in rules]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "column_exists": 36, "not_null": 17, "unique": 7, "unique_together": 1, "matches": 9,
        "matches_any": 2, "between": 5, "length_between": 1, "distinct_set": 2,
    }


def test_column_exists(spark):
    got = run(text(spark, "a"), rule("column_exists"), {"type": "column_exists", "column": "d"})
    assert got[1].success and not got[2].success and got[1].element_count is None


def test_a_rule_on_a_missing_column_fails(spark):
    got = run(text(spark, "a"), {"type": "not_null", "column": "d"}, {"type": "unique", "column": "d"})
    assert not got[1].success and got[1].unexpected_count is None and not got[2].success


def test_not_null(spark):
    df = text(spark, "a", None, N)
    assert one(df, rule("not_null")) == (3, 1, 1, False)
    assert one(df, rule("not_null"), sentinel_is_null=True) == (3, 2, 2, False)
    assert one(text(spark, N), rule("not_null")) == (1, 0, 0, True)
    assert run(df, rule("not_null"))[1].unexpected_percent == pytest.approx(100 / 3)


def test_unique(spark):
    df = text(spark, "a", "a", "a", "b", None, None)
    assert one(df, rule("unique")) == (6, 2, 3, False)
    assert run(df, rule("unique"))[1].unexpected_percent == 75.0
    assert one(text(spark, "a", "b", None), rule("unique")) == (3, 1, 0, True)
    assert one(df.filter("false"), rule("unique")) == (0, 0, 0, True)


def test_unique_together(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", "x"), ("b", None), ("b", None), (None, None)], "c string, d string"
    )
    together = {"type": "unique_together", "columns": ["c", "d"]}
    assert one(df, together) == (6, 1, 4, False)
    assert sorted(map(repr, rows(quality.failing_rows(df, together)))) == sorted(
        map(repr, [("a", "x"), ("a", "x"), ("b", None), ("b", None)])
    )


def test_regexes_search_anywhere_and_skip_missing(spark):
    df = text(spark, "tt1", "xxtt", "nm1", None)
    assert one(df, rule("matches", regex=r"tt\d*")) == (4, 1, 1, False)
    listed = rule("matches_any", regexes=[r"nm\d*", r"\\N"])
    assert one(text(spark, "nm1", N, "other"), listed) == (3, 0, 1, False)


def test_between_compares_numbers(spark):
    bounds = rule("between", min=0, max=2021)
    assert one(text(spark, "3", "2021", N, None), bounds) == (4, 2, 0, True)
    assert one(text(spark, "99999", "-1", "abc", "7"), bounds) == (4, 0, 3, False)
    assert one(text(spark, "0", "5"), rule("between", min=1)) == (2, 0, 1, False)
    assert one(text(spark, "10.1", "9.9"), rule("between", max=10.0)) == (2, 0, 1, False)
    assert one(spark.range(5).withColumnRenamed("id", "c"), rule("between", min=1)) == (5, 0, 1, False)


def test_length_between(spark):
    assert one(text(spark, "a", "ab", "abcde", None), rule("length_between", min=2, max=4)) == (4, 1, 2, False)


def test_distinct_set(spark):
    whole = rule("distinct_set", members=["0", "1", N])
    assert one(text(spark, "0", "1", N, "0"), whole) == (4, 0, 0, True)
    assert one(text(spark, "0", "1"), whole) == (2, 0, 0, False)  # a member is absent
    assert run(text(spark, "0", "1"), whole)[1].absent_members == 1
    assert one(text(spark, "0", "1", N, "2"), whole) == (4, 0, 1, False)
    assert one(text(spark).filter("false"), whole) == (0, 0, 0, False)


def test_shipped_suites_on_the_drop(spark, drop):
    batches = {n: read_raw(spark, drop, n, DROP, decode_sentinel=False) for n in FILM}
    found = quality.run_suites(batches, SUITES, "nightly", NOW)
    assert found.count() == sum(len(SUITES[n]) for n in FILM)
    failed = {(r.suite, r.expectation, r.columns) for r in found.filter("not success").collect()}
    assert failed == {
        ("name.basics", "unique", "primaryName"),
        ("title.basics", "not_null", "isAdult"),
        ("title.basics", "distinct_set", "isAdult"),
        ("title.episode", "matches", "tconst"),  # the fixture's episodes are called te1, te2, ...
        ("title.principals", "unique", "tconst"),
        ("title.principals", "unique", "nconst"),
    }
    assert {r.run_name for r in found.collect()} == {"nightly"}


def test_header_decides_which_columns_exist(spark, tmp_path):
    write_tsv(tmp_path / "title.ratings.tsv", "title.ratings", [["tt1", "1.0"]], header=["tconst", "numVotes"])
    batch = read_asset(spark, str(tmp_path), "title.ratings.tsv")
    found = quality.run_suites({"title.ratings": batch}, SUITES, "run", NOW).collect()
    exists = {r.columns: r.success for r in found if r.expectation == "column_exists"}
    assert exists == {"tconst": True, "averageRating": False, "numVotes": True}


def test_results_are_stored(spark, tmp_path):
    path = str(tmp_path / "dq")
    for name in ("a", "b"):
        quality.store_results(quality.run_suites({"s": text(spark, "x")}, {"s": [rule("unique")]}, name, NOW), path)
    stored = spark.read.parquet(path)
    assert rows(stored, "run_name", "success") == [("a", True), ("b", True)]


def test_json_suite():
    stored = {"expectations": [
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "c", "min_value": "0", "max_value": None}},
        {"expectation_type": "expect_column_values_to_match_regex_list",
         "kwargs": {"column": "c", "regex_list": ["a", "b"]}},
    ]}
    assert suite_from_json(json.dumps(stored)) == [
        {"type": "between", "column": "c", "min": "0"},
        {"type": "matches_any", "column": "c", "regexes": ["a", "b"]},
    ]


@pytest.mark.parametrize("hot_rows", [10**6, 2])
def test_failing_rows(spark, hot_rows):
    df = text(spark, "a", "a", "b", None, None, N, N)
    def failing(r, **s):
        return rows(quality.failing_rows(df, r, hot_rows=hot_rows, **s))
    assert failing(rule("unique")) == sorted([("a",), ("a",), (N,), (N,)], key=repr)
    assert failing(rule("unique"), sentinel_is_null=True) == [("a",), ("a",)]
    assert failing(rule("matches", regex="a")) == sorted([("b",), (N,), (N,)], key=repr)
    assert failing(rule("not_null")) == [(None,), (None,)]


def tables(spark):
    return {
        "titles": spark.createDataFrame(
            [(1, 7, "tt1", "A" * 41, "One", None, True, 40000, None, 5, None, 1, "Drama", None, None),
             (2, None, "tt1", None, None, None, None, None, None, None, None, None, None, None, None)],
            "id long, download_date_id long, tconst string, type string, primary_title string,"
            "original_title string, is_adult boolean, start_year int, end_year int, runtime_minutes int,"
            "av_rating decimal(10,1), num_votes int, genre_1 string, genre_2 string, genre_3 string",
        ),
        "download_date": spark.createDataFrame([(3, 2021, 6, 26)], "id long, year int, month int, day int"),
        "episodes": spark.createDataFrame(
            [(1, 1, 1, 5), (2, 9, 1, 5), (3, 9, 2, 5), (4, None, None, 70000)],
            "id long, title_id long, season int, total_episodes long",
        ),
    }


def test_constraints(spark):
    found = constraints.check_constraints(tables(spark)).collect()
    got = {(r.table_name, r.rule, r.columns): r.violations for r in found if r.violations}
    assert got == {
        ("titles", "varchar(40)", "type"): 1,
        ("titles", "not_null", "primary_title"): 1,
        ("titles", "smallint", "start_year"): 1,
        ("titles", "unique", "tconst"): 1,
        ("titles", "references download_date", "download_date_id"): 1,
        ("episodes", "references titles", "title_id"): 2,
        ("episodes", "smallint", "total_episodes"): 1,
    }
    only = constraints.check_constraints(tables(spark), kinds=("references",))
    assert rows(only, "table_name", "violations") == [("episodes", 2), ("titles", 1)]


def test_orphans_and_repeats(spark):
    child = text(spark, "a", "a", "b", None, "z")
    parent = text(spark, "a", "a", None)
    held = {"x": child, "y": parent}
    assert rows(constraints.orphan_report(held, [("x", "c", "y", "c")])) == [("x", "c", "y", 2)]
    assert rows(constraints.repeated_keys(child, "c")) == [("a", 2)]


def test_require_not_null(spark):
    assert constraints.require_not_null(text(spark, "a"), ["c"]).count() == 1
    with pytest.raises(Exception, match="t.c is null"):
        constraints.require_not_null(text(spark, "a", None), ["c"], "t").collect()


def test_conform(spark):
    good = tables(spark)["episodes"].filter("id < 4")
    made = constraints.conform(good, "episodes")
    assert dict(made.dtypes)["total_episodes"] == "smallint" and made.count() == 3
    for bad, message in (("id = 4", "episodes.total_episodes does not fit"),):
        with pytest.raises(Exception, match=message):
            constraints.conform(tables(spark)["episodes"].filter(bad), "episodes").collect()
    with pytest.raises(Exception, match="titles.type does not fit|titles.start_year does not fit"):
        constraints.conform(tables(spark)["titles"].filter("id = 1"), "titles").collect()
    with pytest.raises(Exception, match="titles.primary_title is null"):
        constraints.conform(
            tables(spark)["titles"].filter("id = 2").withColumn("start_year", F.lit(1)), "titles"
        ).collect()


def test_keys_and_references_of_several_tables_meet_once(spark):
    hot = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("a"), (F.col("id") % 9).cast("string").alias("b")
    )
    tables = {
        "child": hot,
        "one": spark.createDataFrame([(i,) for i in [*range(30), 5, 5, None, None]], "k long"),
        "two": spark.createDataFrame([(str(i),) for i in range(5)], "k string"),
        "none": spark.createDataFrame([], "k long"),
    }
    links = [("child", "a", "one", "k"), ("child", "b", "two", "k"), ("one", "k", "none", "k"), ("child", "a", "two", "k")]
    got = constraints.key_counts(tables, [("one", "k"), ("two", "k"), ("child", "b"), ("none", "k")], links).first()
    a = [7 if i % 3 == 0 else i % 40 for i in range(5000)]
    b = [i % 9 for i in range(5000)]
    assert got.asDict() == {
        "u0": 2, "u1": 0, "u2": 9, "u3": 0,
        "o0": sum(x >= 30 for x in a), "o1": sum(x >= 5 for x in b), "o2": 32, "o3": sum(x >= 5 for x in a),
    }


def test_one_value_does_not_swell_the_shuffle(spark):
    df = spark.range(20_000, numPartitions=4).select(F.lit("same").alias("k"), F.col("id").cast("string").alias("x"))
    found = constraints.key_counts({"t": df, "p": df.limit(1)}, [], [("t", "k", "p", "k")])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_count_if" in text or "partial_count" in text  # counted in the task before anything moves
    assert found.first().o0 == 0


@pytest.mark.parametrize("marker", [False, True])
def test_events_count_what_rows_do(spark, marker):
    df = spark.createDataFrame(
        [("a", "1", 1.0, 0.0), ("a", "1", None, -0.0), ("b", N, 3.0, 2.0), (None, None, 12.0, None), (N, "x", 4.0, 5.0),
         ("a", "2", 5.0, float("nan")), ("", "", 5.0, float("nan"))], "c string, d string, n double, z double")
    rules = [
        {"type": "not_null", "column": "c"}, {"type": "distinct_set", "column": "c", "members": ["a", "b", "q"]},
        {"type": "matches", "column": "d", "regex": r"^\d$"}, {"type": "between", "column": "n", "min": 2, "max": 9},
        {"type": "length_between", "column": "d", "min": 1, "max": 1}, {"type": "column_exists", "column": "e"},
        {"type": "not_null", "column": "e"},
    ]
    keys = [{"type": "unique", "column": "c"}, {"type": "unique_together", "columns": ["c", "d"]},
            {"type": "unique", "column": "z"}, {"type": "unique", "column": "n"}]
    now = datetime.datetime(2021, 1, 1)
    alone = quality.run_suites({"s": df}, {"s": rules}, "r", now, marker)
    found = quality.run_suites({"s": df}, {"s": rules + keys}, "r", now, marker)
    assert rows(found.filter(f"position <= {len(rules)}")) == rows(alone)
    counts = {r.columns: (r.element_count, r.missing_count, r.unexpected_count)
              for r in found.filter(f"position > {len(rules)}").collect()}
    assert counts["c"][0] == 7 and counts["c"][2] == 3 and counts["c"][1] >= 1
    assert counts["c,d"][2] == 2 and counts["z"] == (7, 1, 2 if marker else 4) and counts["n"] == (7, 1, 2)


def test_a_suite_of_an_empty_table(spark):
    df = spark.createDataFrame([], "c string")
    rules = [{"type": "unique", "column": "c"}, {"type": "not_null", "column": "c"}]
    found = quality.run_suites({"s": df}, {"s": rules}, "r", datetime.datetime(2021, 1, 1)).collect()
    assert [(r.element_count, r.unexpected_count, r.success) for r in found] == [(0, 0, True)] * 2


@pytest.mark.parametrize("parts", [1, 5])
def test_examples_are_the_most_frequent_values(spark, parts):
    held = [("x", 1)] * 3 + [("y", 2)] * 3 + [("z", 2)] + [("ok", k) for k in range(10, 13)] + [(None, None)] * 4
    batch = spark.createDataFrame(held, "a string, b int").repartition(parts)
    rules = [
        {"type": "column_exists", "column": "b"},
        {"type": "matches", "column": "a", "regex": "^ok$"},
        {"type": "unique", "column": "b"},
        {"type": "unique_together", "columns": ["a", "b"]},
        {"type": "not_null", "column": "a"},
        {"type": "matches", "column": "absent", "regex": "."},
    ]
    found = quality.examples({"f": batch}, {"f": rules, "g": rules}, most=2)
    assert sorted((r.position, r.place, r.value, r.rows) for r in found.collect()) == [
        (2, 1, "x", 3), (2, 2, "y", 3), (3, 1, "2", 4), (3, 2, "1", 3), (4, 1, '["x","1"]', 3), (4, 2, '["y","2"]', 3),
    ]
    assert quality.examples({"f": batch.limit(0)}, {"f": rules}).count() == 0
    assert quality.examples({"f": batch}, {"f": rules[:1]}).count() == 0
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        quality.examples({}, {"f": rules})


def test_a_watch_tells_what_the_suite_tells(spark, drop, tmp_path):
    for name in FILM:
        plain, batch = quality.row_rules(SUITES[name]), read_raw(spark, drop, name, DROP, decode_sentinel=False)
        watch = quality.Watch(name, plain)
        watch.over(batch).write.parquet(str(tmp_path / name))
        want = quality.run_suites({name: batch}, {name: plain}, "r", NOW).drop("run_name", "run_time")
        assert sorted(map(tuple, watch.results(spark).collect())) == sorted(map(tuple, want.collect()))


def test_a_watch_judges_some_rows_and_no_uniqueness(spark, tmp_path):
    batch = spark.createDataFrame([("a", 1), ("b", 2), (None, 2)], "c string, n int")
    rules = [{"type": "matches", "column": "c", "regex": "a"}, {"type": "distinct_set", "column": "c", "members": ["a", "b"]}]
    watch = quality.Watch("s", rules)
    with pytest.raises(ValueError):
        watch.results(spark)
    watch.over(batch, F.col("n") == 2).write.parquet(str(tmp_path / "t"))
    found = [(r.element_count, r.missing_count, r.unexpected_count, r.absent_members) for r in watch.results(spark).collect()]
    assert found == [(2, 1, 1, None), (2, 1, 0, 1)]
    with pytest.raises(ValueError):
        quality.Watch("s", [{"type": "unique", "column": "c"}])
    nothing = quality.Watch("s", rules)
    nothing.over(batch.limit(0)).write.parquet(str(tmp_path / "e"))
    assert [r.element_count for r in nothing.results(spark).collect()] == [0, 0]
