"""Rates against brute-force least squares, and the stage on clashing names and repeated null keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import mixing

NAMES = [f"p_{d}" for d in mixing.DOMAINS]


def members(spark, p, t):
    rows = [(int(n), *map(float, x)) for n, x in zip(t, p)]
    return spark.createDataFrame(rows, ["tokens", *NAMES]).coalesce(1).cache()


def solved(spark, p, t, targets, **settings):
    df = members(spark, p, t)
    rate, expected = mixing.rates(df, targets, **settings)
    found = df.withColumn("rate", rate).collect()
    again = np.array([sum(r.tokens * r[n] * r.rate for r in found) for n in NAMES])
    assert np.allclose(again, expected, rtol=1e-9)
    return {tuple(r[n] for n in NAMES): r.rate for r in found}, np.array(expected)


def brute(p, t, targets, high):
    """Accelerated projected gradient on the rates themselves, for as long as it takes."""
    a, goal = (p * t[:, None] / targets).T, np.ones(len(targets))
    step = 1 / np.linalg.eigvalsh(a @ a.T)[-1]
    r = ahead = np.ones(len(t))
    k = 1.0
    for _ in range(20_000):
        now = np.clip(ahead - step * (a.T @ (a @ ahead - goal)), 0, high)
        then = (1 + np.sqrt(1 + 4 * k * k)) / 2
        ahead, r, k = now + (k - 1) / then * (now - r), now, then
    return float(((a @ r - goal) ** 2).sum())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("shares", [(0.9, 0.07, 0.03), (0.2, 0.3, 0.5)])
def test_rates_reach_what_brute_force_reaches(spark, seed, shares):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.8, 0.3, 0.2], 40)
    t = rng.integers(1, 500, 40).astype(float)
    targets = np.array([s * t.sum() for s in shares])
    for high in (None, 1.0):
        found, expected = solved(spark, p, t, targets.tolist(), max_rate=high)
        miss = brute(p, t, targets, np.inf if high is None else high)
        reached = float((((expected - targets) / targets) ** 2).sum())
        assert reached <= miss + 1e-6 * max(miss, 1)
        assert all(r >= 0 and (high is None or r <= high) for r in found.values())


def test_of_all_rates_the_nearest_to_one(spark):
    p = np.array([[1, 0, 0], [1, 0, 0], [0, 1, 0], [0, 0, 1], [0.5, 0.5, 0]], float)
    t = np.array([10, 10, 10, 10, 0], float)
    found, expected = solved(spark, p, t, [40.0, 5.0, 10.0])
    assert np.allclose(expected, [40, 5, 10], rtol=1e-4)
    assert abs(found[1.0, 0.0, 0.0] - 2) < 1e-4 and abs(found[0.0, 1.0, 0.0] - 0.5) < 1e-4


def test_the_first_domain_can_be_kept(spark):
    rng = np.random.default_rng(9)
    p = rng.dirichlet([1, 1, 1], 60)
    t = rng.integers(1, 50, 60).astype(float)
    found, _ = solved(spark, p, t, [1.0, 1.0, 1.0], max_rate=1.0, keep_first=True)
    assert all(r == 1 for x, r in found.items() if x[0] > 0.5) and min(found.values()) == 0


def test_targets_are_met_on_the_given_tables(spark):
    row = mixing.op7_soft_mixing(spark, "/root/testdata/sf0.01").agg(
        *[F.sum(F.col("tokens") * F.col(n) * F.col("rate")).alias(n) for n in NAMES],
        *[F.first(f"target_{d}").alias(f"target_{d}") for d in mixing.DOMAINS],
    ).first()
    for n, d in zip(NAMES, mixing.DOMAINS):
        assert abs(row[n] / row[f"target_{d}"] - 1) < 1e-3


def test_the_stage_keeps_names_and_null_keys(spark, tmp_path):
    docs = spark.createDataFrame(
        [(None, None, "a", 1), (None, None, "a", 1), (None, "one two", "b", 2), (3, "three " * 50, "c", 3)],
        "doc_id long, text string, mark string, _k int",
    )
    labels = spark.createDataFrame([(3, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = mixing.mixing_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()}
    assert [r.mark for r in kept.filter("doc_id = 3").collect()] == ["c"]
    assert mixing.mixing_stage(spark, docs.limit(0), str(tmp_path)).count() == 0
