"""Rates for documents, so that the expected tokens of each domain meet their targets.

A document belongs to every domain a little: a naive Bayes classifier, learned from the labels, gives
posteriors, which labelled documents that it did not learn from correct. The rates minimise the squared relative distance of expected domain tokens from the targets, within
[0, max_rate], and of all rates that do so as well as any, they are the nearest to 1. This is solved by a lazy
projected gradient: every step's gradient is a combination of the posteriors, so the steps are summed as one weight
per domain, and a rate is 1 plus the weighted posteriors, projected onto its bounds. A step takes one
aggregation over all documents, which gives the gradient and the curvature of the rates that are free to move.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import kept, read, stage, words

DOMAINS = ("clean", "poor", "toxic")
TARGETS = (0.90, 0.07, 0.03)  # shares of tokens
SAMPLE = 20_000  # labelled documents that the classifier learns from at most
BUCKETS = 1 << 17  # of hashed features
PRIOR = 20_000.0  # features' worth of the prior of each domain
CHANCE = 1.0  # what is taken off each log ratio, as chance alone gives as much to rare features
EVIDENCE = (-math.inf, -3.0, -1e-6, 1e-6, 3.0, 8.0)  # sums of log ratios at which cells begin
HELD = 2.0  # labelled documents' worth of the naive Bayes posterior
ENOUGH = 1e-5  # relative distance from the targets at which steps end
NEAR = tuple(10.0**-k for k in range(9))  # weights of staying near 1 against the distance from the targets
SETTLED = 1e-9  # relative slope at which steps of one weight end
STEPS = 40  # of one weight; two or three are usual


def features(listed: Column) -> Column:
    """Distinct hashed features of a list of words: the first five letters of each word; words with symbols
    and words in capitals have one feature each. Repeated words are looked at once."""
    return F.array_distinct(
        F.transform(
            F.array_distinct(listed),
            lambda w: F.when(w.rlike(r"[#*$%&|<>!]{2}|^\|$"), 0)
            .when(w.rlike(r"^\p{Lu}{3,}"), 1)
            .otherwise(F.pmod(F.xxhash64(F.lower(F.substring(w, 1, 5))), F.lit(BUCKETS - 2)) + 2)
            .cast("int"),
        )
    )


def domain(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, 2).when(quality == 0, 1).when(quality == 1, 0)


Model = tuple[DataFrame, list[float], list[list[float]]]


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Per feature the log ratio of each domain to the first (`_l1`, ...); the log priors; and how many of the
    labelled documents that were held back belong to each domain, by cell of evidence.

    At most SAMPLE labelled documents are learned from, chosen by a hash of their key, and there are at most
    BUCKETS features, so that the result may be broadcast. Labels without key or class are left out.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_k"), domain(F.col("quality"), F.col("toxic")).alias("_d"))
        .dropna()
        .groupBy("_k")
        .agg(F.max("_d").alias("_d"))
        .orderBy(F.xxhash64("_k", F.lit(7)), "_k")
        .limit(SAMPLE)
    )
    back = F.pmod(F.xxhash64("_k", F.lit(8)), F.lit(3)) == 0
    labelled = kept(
        docs.select(F.col("doc_id").alias("_k"), "text")
        .join(F.broadcast(chosen), "_k")
        .select("_d", "text", back.alias("_back")),
        "labelled",
    )
    rows = labelled.filter("not _back")
    is_in = [F.count(F.when(F.col("_d") == k, 1)) for k in range(len(DOMAINS))]
    counts = kept(
        rows.select("_d", F.explode(features(words(F.col("text")))).alias("_f"))
        .groupBy("_f")
        .agg(*[c.alias(f"_c{k}") for k, c in enumerate(is_in)]),
        "features",
    )
    total = counts.agg(*[F.coalesce(F.sum(f"_c{k}"), F.lit(0)) for k in range(len(DOMAINS))]).first()
    found = rows.agg(*is_in).first()
    prior = np.log((np.array(found, float) + 1) / (sum(found) + len(DOMAINS)))
    base = (sum(F.col(f"_c{k}") for k in range(len(DOMAINS))) + 0.5) / (sum(total) + 0.5 * BUCKETS)

    def log(k: int) -> Column:
        return F.log((F.col(f"_c{k}") + PRIOR * base) / (total[k] + PRIOR))

    def ratio(k: int) -> Column:
        plain = log(k) - log(0)
        return F.signum(plain) * F.greatest(F.abs(plain) - CHANCE, F.lit(0.0))

    names = [f"_l{k}" for k in range(1, len(DOMAINS))]
    ratios = counts.select("_f", *[ratio(k).alias(n) for k, n in enumerate(names, 1)])
    telling = kept(ratios.filter(" or ".join(f"{n} <> 0" for n in names)), "features")
    cells = [[0.0] * len(DOMAINS) for _ in range(len(EVIDENCE) ** len(names))]
    scored = _evidence(labelled.filter("_back"), telling, "_d").groupBy(_cell().alias("c"), "_d")
    for r in scored.agg(F.count(F.lit(1)).alias("n")).collect():  # a row for each cell and domain at most
        cells[r["c"]][r["_d"]] += r["n"]
    return telling, [float(p) for p in prior], cells


def _cell() -> Column:
    """The number of the cell that the evidence for the domains (`_l1`, ...) falls into."""
    number = F.lit(0)
    for k in range(1, len(DOMAINS)):
        reached = sum((F.when(F.col(f"_l{k}") > bound, 1).otherwise(0) for bound in EVIDENCE[1:]), F.lit(0))
        number = number * len(EVIDENCE) + reached
    return number


def _evidence(docs: DataFrame, ratios: DataFrame, key: str) -> DataFrame:
    """`_row`, key, `tokens`, `mark` and the sums of the log ratios (`_l1`, ...); one row for each row."""
    worded = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        key,
        words(F.col("text")).alias("_words"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
    )
    rows = worded.select(
        "_row", key, F.size("_words").cast("long").alias("tokens"), "mark", features(F.col("_words")).alias("_fs")
    )
    narrow = rows.select("_row", key, "tokens", "mark", F.explode_outer("_fs").alias("_f"))
    names = [f"_l{k}" for k in range(1, len(DOMAINS))]
    scored = (
        narrow.join(F.broadcast(ratios), "_f", "left")
        .groupBy("_row", key, "tokens", "mark")
        .agg(*[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names])
    )
    return scored


def posteriors(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """`_row`, key, `tokens` (words), `mark` (a hash of the text) and `p_<domain>`; one row for each row.

    The naive Bayes posterior counts as HELD labelled documents against those that were held back and have
    like evidence. Texts without words have no evidence.
    """
    ratios, prior, cells = model
    scored = _evidence(docs, ratios, key)
    names = [f"_l{k}" for k in range(1, len(DOMAINS))]
    odds = [F.lit(0.0), *[F.col(n) + (prior[k] - prior[0]) for k, n in enumerate(names, 1)]]
    top = F.greatest(*odds)
    each = [F.exp(o - top) for o in odds]
    found = F.get(F.array(*[F.array(*[F.lit(float(n)) for n in cell]) for cell in cells]), _cell())
    plain = [(e / sum(each[1:], each[0])) for e in each]
    whole = sum((found[k] for k in range(1, len(DOMAINS))), found[0]) + HELD
    return scored.select(
        "_row", key, "tokens", "mark",
        *[((found[k] + HELD * x) / whole).alias(f"p_{d}") for k, (x, d) in enumerate(zip(plain, DOMAINS))],
    )


def rates(members: DataFrame, targets: list[float], max_rate: float | None = None,
          keep_first: bool = False) -> tuple[Column, list[float]]:
    """The rate of each row of `members` (`tokens`, `p_<domain>`) as a column, and the expected tokens of
    the domains that come of it. `targets` are tokens, one at least. With `keep_first`, rows that likelier than not
    belong to the first domain have a rate of 1 at least. Targets that the bounds leave out of reach are
    approached as closely as they can be, by least squares of the relative distances; the expected tokens then
    tell what is missing. Without tokens every rate is 1.
    """
    p = [F.col(f"p_{d}") for d in DOMAINS]
    total = members.agg(F.sum("tokens")).first()[0]
    if not total:
        return F.lit(1.0), [0.0] * len(DOMAINS)
    goal = np.maximum(np.array(targets, float), 1.0)
    low = F.when(p[0] > 0.5, 1.0).otherwise(0.0) if keep_first else F.lit(0.0)

    def rate(weights: np.ndarray) -> Column:
        moved = F.lit(1.0) + sum((x * float(w) for x, w in zip(p[1:], weights[1:])), p[0] * float(weights[0]))
        return F.greatest(moved, low) if max_rate is None else F.least(F.greatest(moved, low), F.lit(max_rate))

    def look(weights: np.ndarray, near: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Value of the dual problem, expected tokens, and curvature of the free rates."""
        pull = sum((x * float(w) for x, w in zip(p[1:], weights[1:])), p[0] * float(weights[0]))
        rows = members.select("tokens", *p, pull.alias("_pull"), rate(weights).alias("_rate"), low.alias("_low"))
        r, t = F.col("_rate"), F.col("tokens")
        free = r > F.col("_low") if max_rate is None else (r > F.col("_low")) & (r < max_rate)
        row = rows.agg(
            F.sum(t * (r * F.col("_pull") - (r - 1) * (r - 1) / 2)),
            *[F.sum(t * x * r) for x in p],
            *[F.coalesce(F.sum(F.when(free, t * a * b)), F.lit(0.0)) for i, a in enumerate(p) for b in p[i:]],
        ).first()
        curve = np.zeros((len(p), len(p)))
        curve[np.triu_indices(len(p))] = row[1 + len(p) :]
        value = row[0] - goal @ weights + near @ weights**2 / 2
        return value, np.array(row[1 : 1 + len(p)], float), np.maximum(curve, curve.T)

    weights = np.zeros(len(p))
    # the pull towards 1 is taken off by degrees, as targets out of reach drive the weights up without end
    for share in NEAR:
        near = share * goal**2 / total
        value, expected, curve = look(weights, near)
        for _ in range(STEPS):
            slope = expected - goal + near * weights
            if np.abs(slope / goal).max() < SETTLED:
                break
            step, size = -np.linalg.solve(curve + np.diag(near), slope), 1.0
            tried = look(weights + step, near)
            while tried[0] > value + 1e-4 * size * float(slope @ step) and size > 1e-6:
                size /= 2
                tried = look(weights + size * step, near)
            done = abs(value - tried[0]) <= 1e-14 * max(abs(value), 1.0)
            weights, (value, expected, curve) = weights + size * step, tried
            if done:
                break
        if np.abs((expected - goal) / goal).max() < ENOUGH:
            break
    return rate(weights), [float(x) for x in expected]


def mix(docs: DataFrame, labels: DataFrame, shares: tuple[float, ...] = TARGETS, max_rate: float | None = None,
        of_first: bool = False, keep_first: bool = False) -> DataFrame:
    """doc_id, `tokens`, `mark`, `p_<domain>`, `rate` and `copies`, whose expectation is the rate; and, the same in
    every row, `target_<domain>` and `expected_<domain>`, the tokens aimed at and those the rates give.

    The budget is all tokens, or, if `of_first`, so much that the first domain's share is what there is of
    it. Copies are the whole part of the rate, and one more if a hash of key and text falls below the rest.
    Repeated rows get their rates each; an empty table gives none; null texts have no tokens.
    """
    members = kept(posteriors(docs, learn(docs, labels)), "posteriors")
    found = members.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col(f"p_{DOMAINS[0]}"))).first()
    budget = (found[1] or 0.0) / shares[0] if of_first else (found[0] or 0)
    targets = [float(s * budget) for s in shares]
    rate, expected = rates(members, targets, max_rate, keep_first)
    chance = F.pmod(F.xxhash64("doc_id", "mark", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    return members.select(
        "doc_id", "tokens", "mark", *[f"p_{d}" for d in DOMAINS], rate.alias("rate")
    ).select(
        "*",
        F.floor(F.col("rate") + chance).cast("int").alias("copies"),
        *[F.lit(x).alias(f"target_{d}") for d, x in zip(DOMAINS, targets)],
        *[F.lit(x).alias(f"expected_{d}") for d, x in zip(DOMAINS, expected)],
    )


def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("mark")


@stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What rates of at most 1 leave: clean documents all stay, the others are thinned out to their shares.

    Rows of one key and text stay or go together; a null key is a key, null texts have no tokens and stay.
    Columns of any name are kept as they are. An empty table stays empty.
    """
    labels = read(spark, sf_dir, "labels")
    mixed = mix(docs, labels, (0.96, 0.03, 0.01), max_rate=1.0, of_first=True, keep_first=True)
    least = F.lit(-(1 << 63))
    chosen = mixed.filter("copies > 0").select(F.coalesce("doc_id", least).alias("_k"), F.col("mark").alias("_m"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(
        whole, F.coalesce("doc_id", least).alias("_k"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_m")
    )
    return keyed.join(chosen.distinct(), ["_k", "_m"]).select("_row.*")
