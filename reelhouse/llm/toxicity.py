"""Toxic passages: segments of words whose log-odds of toxicity sum up as high as can be.

How much a word speaks for toxicity is its log-odds among labelled documents under Dirichlet priors that
are nested: a word's prior is centred on what its first six letters say, that on the first five, and so on
down to the share of toxic documents. So words not seen before score by their beginning. A linear scan
finds every maximal scoring segment of a text. How high chance alone drives such sums follows an
extreme-value law, E = K * n * exp(-lambda * S); its two numbers are fitted to labelled clean documents that
the log-odds did not see. What the segments of a text exceed chance by is added up and turned into a
probability by a logistic curve fitted to the same documents.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.bpe import Memo
from reelhouse.llm.common import map_rows, part_of, read

SAMPLE = 30_000  # labelled documents that are learned from at most: bounds what the driver gets
PREFIXES = (3, 4, 5, 6)
PRIOR = 4.0  # documents' worth of the prior of each level
DRIFT = 1.0  # taken off each word's log-odds, so that chance sums fall
LEAST = 2  # documents that a word or prefix must be in to count
CALIBRATE = 4  # one labelled document of so many is kept for calibration
EULER = 0.5772156649015329
LETTERS = re.compile(r"[^\W\d_]+")


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), in one scan.

    Runs of positive scores are taken up in order. A run is joined to the nearest earlier segment that
    begins lower, if that one ends lower too, and with it all between; else it stands alone for now.
    """
    positive = scores > 0
    if not positive.any():
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], positive, [False]]).astype(np.int8)))
    starts, ends = edges[0::2].tolist(), edges[1::2].tolist()
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, lower one
    for start, end in zip(starts, ends):
        low, high = total[start], total[end]
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= low:
                k = found[k][4]
            if k < 0 or found[k][3] >= high:
                found.append((start, end, low, high, k))
                break
            start, low = found[k][0], found[k][2]
            del found[k:]
    return [(s, e, float(high - low)) for s, e, low, high, _ in found]


@dataclass
class Model:
    odds: dict[str, float]  # of words ("word ") and beginnings ("wor"), root taken off
    decay: float = 1.0  # lambda
    scale: float = 1.0  # K
    bias: float = 0.0
    slope: float = 1.0

    def word(self, word: str) -> float:
        for part in (word + " ", *[word[:n] for n in reversed(PREFIXES)]):
            if part in self.odds:
                return self.odds[part] - DRIFT
        return -DRIFT

    def excess(self, sums: list[float], n: int) -> float:
        """How far the segments' sums exceed what chance gives in n words, in nats, added up."""
        floor = math.log(self.scale * max(n, 1))
        return sum(max(0.0, self.decay * s - floor) for s in sums)

    def probability(self, excess: float) -> float:
        z = self.bias + self.slope * math.log1p(excess)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def _log_odds(counts: list, toxic: int, clean: int) -> dict[str, float]:
    """Nested priors, from the shortest beginnings up to whole words."""
    root = (toxic + 0.5) / (toxic + clean + 1.0)
    logit = lambda p: math.log(p / (1 - p))
    ratio: dict[str, float] = {}
    for part, t, n in sorted(counts, key=lambda c: (len(c[0].rstrip()) + 100 * c[0].endswith(" "), c[0])):
        parents = [part.rstrip()[:k] for k in reversed(PREFIXES)]
        above = next((ratio[p] for p in parents if p != part and p in ratio), root)
        ratio[part] = (t + PRIOR * above) / (n + PRIOR)
    return {part: logit(r) - logit(root) for part, r in ratio.items()}


def _score_words(df: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """`key`, n_words, sums (of the maximal segments), begins and ends (in words), and per half nat of
    score the number of words (`bins`), for the calibration."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def start():
        score = Memo(sent.value.word, 200_000)

        def work(rows: dict[str, list]) -> dict[str, list]:
            out = {"_key": rows["_key"], "n_words": [], "passages": [], "bins": []}
            for text_ in rows["_text"]:
                found = LETTERS.findall((text_ or "").lower())
                scores = np.fromiter(map(score.__getitem__, found), np.float64, len(found))
                out["n_words"].append(len(found))
                out["passages"].append(
                    [{"from_word": s, "to_word": e, "sum": x} for s, e, x in maximal_segments(scores)]
                )
                at, n = np.unique(np.round(scores * 2).astype(np.int64), return_counts=True)
                out["bins"].append([{"at": int(a), "n": int(b)} for a, b in zip(at, n)])
            return out

        return work

    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"_key {kind}, n_words bigint, "
        "passages array<struct<from_word:bigint,to_word:bigint,sum:double>>, "
        "bins array<struct<at:bigint,n:bigint>>"
    )
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return map_rows(rows, start, schema).withColumnRenamed("_key", key)


def _decay(bins: list[tuple[float, int]]) -> float:
    """The positive solution of E[exp(x * score)] = 1 over the words of clean documents."""
    total = sum(n for _, n in bins)
    if not total or max(s for s, _ in bins) <= 0 or sum(s * n for s, n in bins) >= 0:
        return 1.0
    mean = lambda x: sum(n * math.exp(min(600.0, x * s)) for s, n in bins) / total
    low, high = 0.0, 1.0
    while mean(high) < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return max(high, 1e-3)


def _logistic(points: list[tuple[float, int]]) -> tuple[float, float]:
    """Intercept and slope by Newton's method; a weak ridge keeps them finite where labels are split."""
    if not points:
        return -20.0, 1.0
    x = np.array([[1.0, math.log1p(e)] for e, _ in points])
    y = np.array([float(t) for _, t in points])
    w = np.array([math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 1.0])
    start, ridge = w.copy(), np.diag([0.01, 0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        w = w - np.linalg.solve(hessian, x.T @ (p - y) + ridge @ (w - start))
    return float(w[0]), float(max(w[1], 0.0))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Model:
    """Learn from labelled documents, at most SAMPLE of them, chosen by a hash of the key.

    Rows without key or label are left out; several labels of a key count as the highest. Without any
    toxic or clean document the model gives every text the same low or high score.
    """
    chosen = (
        labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_toxic"))
        .dropna()
        .groupBy("_key")
        .agg(F.max("_toxic").alias("_toxic"))
        .orderBy(F.xxhash64("_key", F.lit(1)), "_key")
        .limit(SAMPLE)
    )
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), "_key"
    )
    rows = rows.withColumn("_held", F.pmod(F.xxhash64("_key", F.lit(2)), F.lit(CALIBRATE)) == 0)
    fit, rest = rows.filter(~F.col("_held")), rows.filter("_held")
    sizes = {bool(r["_toxic"]): r["count"] for r in fit.groupBy("_toxic").count().collect()}
    found = F.array_distinct(F.regexp_extract_all(F.lower("_text"), F.lit(r"\p{L}+"), F.lit(0)))
    parts = F.flatten(
        F.transform(
            found, lambda w: F.array(F.concat(w, F.lit(" ")), *[F.substring(w, 1, n) for n in PREFIXES])
        )
    )
    counts = (
        fit.select("_toxic", F.explode(F.array_distinct(parts)).alias("part"))
        .groupBy("part")
        .agg(F.sum("_toxic").alias("t"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= LEAST)
        .collect()  # bounded by the sample
    )
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    odds = _log_odds([tuple(r) for r in counts], toxic, clean)
    # what differs from its parent by next to nothing is found there as well
    model = Model({p: o for p, o in odds.items() if o > 0.3} | {p: o for p, o in odds.items() if len(p) == 3})
    found = _score_words(rest, model, "_key", "_text").join(F.broadcast(chosen), "_key").collect()
    bins: dict[float, int] = {}
    for r in found:
        if not r["_toxic"]:
            for b in r["bins"]:
                bins[b["at"] / 2] = bins.get(b["at"] / 2, 0) + b["n"]
    model.decay = _decay(sorted(bins.items()))
    tops = [
        model.decay * max(p["sum"] for p in r["passages"]) - math.log(r["n_words"]) - EULER
        for r in found
        if not r["_toxic"] and r["passages"]
    ]
    model.scale = math.exp(float(np.mean(tops))) if tops else 1.0
    points = [(model.excess([p["sum"] for p in r["passages"]], r["n_words"]), r["_toxic"]) for r in found]
    model.bias, model.slope = _logistic(points)
    return model


def passages(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `score`, `n_words` and `passages`: start, end (words of letters), sum and E of each passage
    that chance would give less than once in that text.

    One row for each row, repeated ones too. Null and empty texts have no words and the score of a text
    without passages. Only the two named columns are looked at.
    """
    scored = _score_words(df, model, key, text)
    floor = F.log(F.lit(model.scale) * F.greatest("n_words", F.lit(1)))
    listed = F.transform(
        "passages",
        lambda p: F.struct(
            p.from_word.alias("from_word"),
            p.to_word.alias("to_word"),
            p["sum"].alias("sum"),
            F.exp(floor - p["sum"] * model.decay).alias("e_value"),
        ),
    )
    excess = F.aggregate(
        "passages",
        F.lit(0.0),
        lambda a, p: a + F.greatest(F.lit(0.0), p["sum"] * model.decay - floor),
    )
    odds = F.lit(model.bias) + F.lit(model.slope) * F.log1p(excess)
    return scored.select(
        key,
        "n_words",
        (1 / (1 + F.exp(-odds))).alias("score"),
        F.filter(listed, lambda p: p.e_value < 1).alias("passages"),
    )


def op1_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = train(docs, labels.filter(part_of(F.col("doc_id")) != 0))
    return passages(docs, model).select(
        "doc_id",
        (part_of(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
        F.col("passages"),
    )
