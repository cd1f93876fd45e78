"""Quality rules that vote or abstain, weighed by weak supervision.

Every rule says good (1), bad (-1) or nothing (0) of a text. How far each is to be trusted is not set by
hand: expectation-maximisation over the counts of all vote patterns estimates the share of good texts
and each rule's accuracy on good and on bad ones, and the posterior probability of "good" decides. There
are at most 3 ** rules patterns whatever the input, so their counts are all that the driver sees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import SPACES, kept, read, stage, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEATED_PERCENT = 50
ROUNDS = 100
# Frequent function words of the four languages.
FUNCTION_WORDS = (
    "the of and to a in is that it for with as are by be this was on from or "
    "der die das und den von mit ist im für auf ein eine dem sich nicht des "
    "le la les de des et un une en que qui dans pour par sur est au du "
    "el los las del y una por con para se su es"
).split()


def counted(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with counts over each whole text: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, and what only the rules need, below names that begin with `_q_`.

    A window of three words is told by a 64-bit hash chained over them. Equal windows are found by
    sorting those of one text, so the work is that of a sort at any length.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    plain = F.translate(body, SPACES, "")
    kinds = F.transform(F.split(body, "\n"), lambda x: F.trim(F.translate(x, SPACES[1:], " " * 5)))
    raw_lines = F.filter(
        F.split(body, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0
    )
    step = df.withColumns(
        {
            "_q_words": words(F.col(text)),
            "_q_lines": raw_lines,
            "_q_ends": F.size(F.filter(kinds, lambda x: x.rlike(r"[.!?…:;»\"']$"))),
            "word_chars": F.length(plain).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "_q_upper": F.length(F.regexp_replace(plain, r"[^\p{Lu}]+", "")),
            "_q_letters": F.length(F.regexp_replace(plain, r"[^\p{L}]+", "")),
            "_q_bangs": F.length(plain) - F.length(F.translate(plain, "!", "")),
        }
    )
    count = F.size("_q_words")
    listed = F.array(*[F.lit(w) for w in FUNCTION_WORDS])
    step = step.withColumns(
        {
            "n_words": count.cast("long"),
            "_q_n_lines": F.size("_q_lines"),
            "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
            "_q_distinct": F.size(F.array_distinct("_q_words")),
            "_q_function": F.size(F.array_intersect(F.transform("_q_words", F.lower), listed)),
            "_q_windows": F.when(
                count >= 3,
                F.transform(
                    F.sequence(F.lit(0), count - 3),
                    lambda i: F.struct(
                        F.xxhash64(
                            F.col("_q_words")[i], F.col("_q_words")[i + 1], F.col("_q_words")[i + 2]
                        ).alias("h"),
                        i.alias("i"),
                    ),
                ),
            ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
        }
    ).drop("_q_words", "_q_lines")
    step = step.withColumn("_q_sorted", F.sort_array("_q_windows")).drop("_q_windows")
    twice = F.filter(
        F.col("_q_sorted"),
        lambda s, j: (s.h == F.get("_q_sorted", j - 1).h) | (s.h == F.get("_q_sorted", j + 1).h),
    )
    covered = F.flatten(F.transform(twice, lambda s: F.array(s.i, s.i + 1, s.i + 2)))
    return step.withColumn("n_repeat_words", F.size(F.array_distinct(covered)).cast("long")).drop(
        "_q_sorted"
    )


def _vote(bad: Column, good: Column) -> Column:
    vote = F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))
    return F.coalesce(vote, F.lit(0)).cast("int")


def _rules() -> dict[str, Column]:
    """Name to vote. A text without words is bad by length, and the other rules abstain."""
    n, some = F.col("n_words"), F.col("n_words") > 0
    share = lambda top, of: F.when(F.col(of) > 0, F.col(top) / F.col(of))
    repeats, symbols = share("n_repeat_words", "n_words"), share("n_symbols", "n_words")
    lines, size = share("n_dup_lines", "_q_n_lines"), share("word_chars", "n_words")
    upper, bangs = share("_q_upper", "_q_letters"), share("_q_bangs", "n_words")
    letters, ends = share("_q_letters", "word_chars"), share("_q_ends", "_q_n_lines")
    many = n >= MIN_WORDS
    return {
        "length": _vote(n < MIN_WORDS, n >= 2 * MIN_WORDS),
        "repeats": _vote(100 * repeats > REPEATED_PERCENT, repeats < 0.3),
        "symbols": _vote(symbols > 0.2, symbols < 0.05),
        "lines": _vote(lines > 0.3, (lines < 0.1) & (F.col("_q_n_lines") > 2)),
        "word_size": _vote((size < 3) | (size > 11), (size >= 3.5) & (size <= 9)),
        "capitals": _vote(upper > 0.5, upper < 0.2),
        "bangs": _vote(bangs > 0.2, some & (bangs < 0.02)),
        "letters": _vote(letters < 0.85, letters > 0.92),
        "ends": _vote(many & (ends == 0), ends > 0.5),
        "function_words": _vote(many & (F.col("_q_function") < 2), F.col("_q_function") >= 5),
    }


@dataclass(frozen=True)
class Trust:
    """Share of good texts, and per rule P(vote good | good) and P(vote bad | bad) where it votes."""

    good: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def log_odds(self, votes) -> float:
        total = math.log(self.good / (1 - self.good))
        for vote, a, b in zip(votes, self.on_good, self.on_bad):
            if vote:
                total += math.log(a / (1 - b)) if vote > 0 else math.log((1 - a) / b)
        return total


def learn(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> Trust:
    """Expectation-maximisation over (votes, number of texts); ten made-up votes of each rule keep its
    accuracies inside (0, 1). Without any text the start values come back."""
    width = len(patterns[0][0]) if patterns else 0
    trust = Trust(0.8, (0.8,) * width, (0.7,) * width)
    for _ in range(rounds if patterns else 0):
        good, total = 4.0, 5.0
        a = [[8.0, 10.0] for _ in range(width)]
        b = [[7.0, 10.0] for _ in range(width)]
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, trust.log_odds(votes)))))
            good += n * p
            total += n
            for k, vote in enumerate(votes):
                if vote:
                    a[k][0] += n * p * (vote > 0)
                    a[k][1] += n * p
                    b[k][0] += n * (1 - p) * (vote < 0)
                    b[k][1] += n * (1 - p)
        trust = Trust(good / total, tuple(x / y for x, y in a), tuple(x / y for x, y in b))
    return trust


def judge(df: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """The columns `carry` with the counts of `counted`, the votes (`vote_<rule>`), `quality` (posterior
    of good), `base_failed` and `kept`.

    The counted rows are written once, as both the patterns and the verdicts are read from them. Every row gives one row; null and empty texts have no words and fail the base. An empty table gives
    an empty one. Carried columns of the same names give way.
    """
    rules = _rules()
    votes = [f"vote_{name}" for name in rules]
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *votes]
    carry = [c for c in carry if c not in {*made, "quality", "base_failed", "kept"}]
    voted = counted(df.select(*dict.fromkeys([*carry, text])), text).withColumns(
        {f"vote_{name}": vote for name, vote in rules.items()}
    )
    voted = kept(voted.select(*carry, *made), "votes")
    found = voted.groupBy(*votes).count().collect()  # at most 3 ** rules
    trust = learn(sorted((tuple(r[:-1]), r[-1]) for r in found))

    odds = F.lit(math.log(trust.good / (1 - trust.good)))
    for name, a, b in zip(votes, trust.on_good, trust.on_bad):
        said = F.when(F.col(name) > 0, math.log(a / (1 - b))).when(
            F.col(name) < 0, math.log((1 - a) / b)
        )
        odds = odds + F.coalesce(said, F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )
    return voted.withColumn("quality", 1 / (1 + F.exp(-odds))).withColumns(
        {"base_failed": failed, "kept": ~failed & (F.col("quality") >= 0.5)}
    )


def op10_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"), ["doc_id"])


@stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep."""
    return judge(docs, docs.columns).filter("kept").select(*docs.columns)
