import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import spark  # noqa: F401


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


BASE = prose(1, 200)
NEAR = " ".join(["changed", *BASE.split()[1:]])
SHARED = prose(99, 70)
TEXTS = [
    (0, BASE), (1, BASE), (2, NEAR), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (6, "one"), (None, None),
    (None, prose(7, 60)), (8, prose(8, 3000)), (9, "x" * 5000), (10, "The of and to a in. " * 40),
    (11, prose(11, 90) + " " + SHARED), (12, prose(12, 90) + " " + SHARED + " " + prose(13, 40)),
    (13, "é日本 🙂 \x00   ok"), (14, "AAA!! BBB!! " * 60), *[(20 + i, prose(100 + i, 60 + 5 * i)) for i in range(20)],
]


@pytest.fixture(scope="session")
def docs(spark):  # noqa: F811
    """Odd documents, with columns whose names clash with those that the operators make."""
    rows = [(k, t, "en", None, 0, 1.0, 1, True) for k, t in TEXTS]
    names = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, kept boolean"
    return spark.createDataFrame(rows, names).withColumn("shard", F.lit(1)).repartition(3)


@pytest.fixture(scope="session")
def labels(spark):  # noqa: F811
    rows = [(20 + i, 1, i % 2) for i in range(20)] + [(None, 1, 1), (0, None, None), (14, 0, 0), (14, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
