"""Every registered query against its SQL, and the shape of the plans."""

import pytest

from __spark_entry__ import _library as queries
from __spark_entry__ import entry, oracle_sql
from reelhouse.sources.standins import VIEWS
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) <= set(oracle_sql())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    text = plan(df)
    assert "PythonUDF" not in text and "ExistingRDD" not in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert compare(df, con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).columns == ["primary_title", "num_votes", "av_rating"]


@pytest.mark.parametrize(
    "name", ["top_rated", "top_episode_counts", "cast_appearances", "crew_appearances", "people_of_top_titles"]
)
def test_top_k_is_not_a_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["genre_counts", "adult_pair", "top_rated"])
def test_reports_without_joins_need_no_numbering(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert "Window" not in text and "md5" not in text


def test_genres_scan_titles_once(spark):
    assert plan(queries()["genre_counts"](spark, SF_DIR)).count("FileScan") == 2  # basics and ratings


def test_row_rules_of_a_suite_share_one_scan(spark):
    assert plan(queries()["dq_title_akas"](spark, SF_DIR)).count("FileScan") == 1


def test_bridge_rows_are_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(queries()["people_of_top_titles"](spark, SF_DIR))


def test_age_filter_reaches_the_scan(spark):
    from __spark_entry__ import _warehouse
    from reelhouse.plans.reports import age_distribution

    tables = _warehouse(spark, SF_DIR)
    text = plan(age_distribution(tables.casts, tables.crew))
    assert "GreaterThan(age,0)" in text and "LessThan(age,150)" in text
    assert "ReadSchema: struct<age:int>" in text


def test_standins_cover_all_raw_files():
    from reelhouse.schemas import RAW_COLUMNS

    assert set(VIEWS) == set(RAW_COLUMNS)


def test_a_suite_with_uniqueness_reads_its_file_once(spark):
    for name in ("dq_title_principals", "dq_title_basics", "dq_title_episode"):
        text = plan(queries()[name](spark, SF_DIR))
        assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_references_read_each_table_once(spark):
    assert plan(queries()["orphan_report"](spark, SF_DIR)).count("FileScan") == 6
    from __spark_entry__ import _warehouse
    from reelhouse.operators.constraints import check_constraints
    from reelhouse.schemas import TABLES

    tables = _warehouse(spark, SF_DIR)
    found = check_constraints({n: getattr(tables, n) for n in TABLES}, ("unique", "references"))
    assert plan(found).count("FileScan") == len(TABLES)
