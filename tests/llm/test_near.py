"""Near duplicates against all pairs, and what a piece of work hands on."""

import random
from collections import Counter

import numpy as np
import pytest

from reelhouse.llm import bagminhash
from tests.llm.conftest import prose


def bag(text):
    found = text.lower().split()
    size = min(5, len(found))
    return Counter(tuple(found[i : i + size]) for i in range(len(found) - size + 1)) if found else Counter()


def alike(x, y):
    total = sum((x | y).values())
    return total > 0 and sum((x & y).values()) / total >= bagminhash.SIMILAR


def classes_of(texts):
    """Brute force: the least number of each class, over all pairs."""
    bags, label = [bag(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and (texts[i] == texts[j] or alike(bags[i], bags[j])):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def changed(text, seed, n):
    words, rng = text.split(), random.Random(seed)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("leaders,block", [(3, 256), (0, 7), (1, 3)])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, leaders, block):
    monkeypatch.setattr(bagminhash, "LEADERS", leaders)
    monkeypatch.setattr(bagminhash, "BLOCK", block)
    texts = [prose(i % 6, 120) for i in range(12)]
    texts += [changed(prose(i % 6, 120), i, 1 + i % 3) for i in range(60)]
    chain = prose(50, 150)
    for i in range(12):  # each like the one before, the ends unlike
        chain = changed(chain, 900 + i, 2)
        texts.append(chain)
    texts += ["", "", "one two", "one two", "three"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in bagminhash.classes(df).collect()}
    assert [got[i] for i in range(len(texts))] == classes_of(texts)


def test_a_piece_of_work_hands_on_fewer_links_than_texts():
    texts = [changed(prose(3, 150), i, 1) for i in range(80)] + [prose(100 + i, 150) for i in range(20)]
    memo = bagminhash.word_hashes()
    rows = []
    for i, t in enumerate(texts):
        found = bagminhash.shingles(t, memo)
        rows.append({"node": i, "label": i, "sketch": bagminhash.sketch(found), "bag": found.astype(np.uint64).tobytes()})
    links = bagminhash.tile_links(rows, rows, bagminhash.SIMILAR)
    assert len(links) == 79 and all(s >= bagminhash.SIMILAR for *_, s in links)
    assert {n for a, b, _ in links for n in (a, b)} == set(range(80))
