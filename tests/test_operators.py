import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelhouse.operators.joins import hot_keys, hottest, skew_join
from reelhouse.operators.keys import assign_keys
from reelhouse.operators.latest import latest_rows
from tests.conftest import rows


def keyed(spark, keys, parts=3):
    return spark.createDataFrame([(k,) for k in keys], "k string").repartition(parts)


def by_hash(keys):
    return sorted(keys, key=lambda k: (hashlib.md5(k.encode()).hexdigest(), k))


@settings(max_examples=8, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text(min_size=1, max_size=6).filter(lambda s: s.isprintable()), min_size=1, max_size=60))
def test_keys_are_dense_and_ordered_by_hash(spark, keys):
    got = {r.k: r.id for r in assign_keys(keyed(spark, keys), "k").collect()}
    assert got == {k: i for i, k in enumerate(by_hash(keys), 1)}


def test_keys_do_not_depend_on_partitioning(spark):
    keys = [f"tt{i:07d}" for i in range(5000)] + ["nokey", "", "tt1", "tt01"]
    one = assign_keys(keyed(spark, keys, 1), "k")
    assert rows(one) == rows(assign_keys(keyed(spark, keys[::-1], 13), "k"))
    assert sorted(r.id for r in one.collect()) == list(range(1, len(keys) + 1))


def test_old_keys_stay_and_new_ones_follow(spark):
    old, new = [f"a{i}" for i in range(500)], [f"b{i}" for i in range(300)]
    first = assign_keys(keyed(spark, old), "k")
    second = assign_keys(keyed(spark, new + old[100:]), "k", "id", first)
    ids = {r.k: r.id for r in second.collect()}
    before = {r.k: r.id for r in first.collect()}
    assert all(ids[k] == before[k] for k in old[100:])
    assert [ids[k] for k in by_hash(new)] == list(range(501, 801))


def test_a_missing_key_is_numbered_too(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    assert sorted(r.id for r in assign_keys(df, "k").collect()) == [1, 2, 3]


def test_offsets_are_the_only_thing_on_one_partition(spark):
    plan = assign_keys(keyed(spark, ["a", "b"]), "k")._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(single) == 1


def skewed(spark, n=3000):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(200)}", i % 50) for i in range(n)]
    data += [(None, 1), ("unknown", 2)]
    lookup = [("hot", -1)] + [(f"k{i}", i) for i in range(0, 200, 2)]
    large = spark.createDataFrame(data, "k string, v int").repartition(6)
    return large, spark.createDataFrame(lookup, "k string, id int")


@pytest.mark.parametrize("hot_rows", [10**9, 100, 7, 1])
def test_skew_join_is_the_inner_join(spark, hot_rows):
    large, lookup = skewed(spark)
    joined = skew_join(large, lookup, "k", hot_keys(large, "k", hot_rows))
    assert joined.columns == ["k", "v", "id"]
    assert rows(joined) == rows(large.join(lookup, "k"))


def test_skew_join_with_repeated_lookup_rows(spark):
    large, lookup = skewed(spark)
    lookup = lookup.unionByName(lookup.withColumn("id", F.col("id") + 1000))
    joined = skew_join(large, lookup, "k", hot_keys(large, "k", 100))
    assert rows(joined) == rows(large.join(lookup, "k"))


def test_hot_key_is_spread(spark):
    large, lookup = skewed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def parts(df):
            hot = df.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count()
            return [r["count"] for r in hot.collect()]

        plain = parts(large.join(lookup, "k"))
        split = parts(skew_join(large, lookup, "k", hot_keys(large, "k", 100)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(plain) == 1 and len(split) > 4
    assert max(split) < sum(plain) / 2 and sum(split) == sum(plain)


def test_pieces_grow_with_the_key(spark):
    counts = spark.createDataFrame([("a", 10**12), ("b", 2_500_001), ("c", 10**6)], "k string, n long")
    assert rows(hottest(counts, "k", "n", 10**6)) == [("a", 10**6), ("b", 3)]


def test_every_heavy_key_is_split(spark):
    counts = spark.range(12_000).select(F.col("id").cast("string").alias("k"), F.lit(4).alias("n"))
    assert hottest(counts, "k", "n", 3).count() == 12_000
    assert hottest(counts, "k", "n", 4).count() == 0


def test_a_key_below_its_share_stays_whole(spark):
    counts = spark.createDataFrame([("a", 5 * 10**6), ("b", 5), ("c", 6)], "k string, n long")
    assert rows(hottest(counts, "k", "n", 1)) == [("a", 5 * 10**6)]  # six rows are a millionth


def test_latest_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", None), ("a", 2, "y", 5), ("a", 2, "z", None), ("b", 1, None, 3), (None, 1, "n", 1)],
        "k string, day int, v string, w int",
    )
    assert rows(latest_rows(df, ["k"], ["day"])) == sorted(
        [("a", 2, "z", None), ("b", 1, None, 3), (None, 1, "n", 1)], key=repr
    )
    assert latest_rows(df.select("k"), ["k"]).count() == 3
