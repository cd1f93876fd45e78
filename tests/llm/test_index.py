"""Token ids in ORC files, whitening and lexical search against plain readings, and on odd rows."""

import math
import re
import struct
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelhouse.llm import lexical, orcids, whitening
from tests.llm.conftest import TEXTS, prose

LONG = " ".join(prose(i, 4000) for i in range(30)) + " " * 20_000 + "x" * 50_000  # a million characters


@pytest.fixture(scope="module")
def plain():
    model = Tokenizer.from_file(orcids.VOCABULARY)
    model.encode_special_tokens = True
    return lambda text: [*model.encode(text or "", add_special_tokens=False).ids, orcids.END]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def split(encoder, texts):
    ids, sizes = encoder(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else ids.tolist()


def test_pieces_give_the_ids_of_the_whole(plain):
    odd = [
        "", None, " ", "  a  b ", "a \n b", "\t x y  z 　q r", "x  y   z", "it's we'll 've 'LL", "a\u0085 b\x1c c",
        "​ a ​b", "<|endoftext|> end <|endoftext|>", "é 日本 語", "a" * 300 + " " + "b" * 300, LONG,
    ]
    assert split(orcids.Encoder(orcids.VOCABULARY), odd * 2) == [plain(t)[:-1] for t in odd] * 2


def test_forgetting_changes_nothing(monkeypatch):
    texts = [prose(i, 50) for i in range(20)]
    whole = orcids.Encoder(orcids.VOCABULARY)
    monkeypatch.setattr(orcids, "PIECES", 10)
    monkeypatch.setattr(orcids, "PIECE_BYTES", 4)
    short = orcids.Encoder(orcids.VOCABULARY)
    assert [split(whole, [t]) for t in texts] == [split(short, [t]) for t in texts]
    assert split(short, texts) == split(whole, texts) and split(whole, []) == []


def test_ids_of_odd_documents(spark, docs, plain, tmp_path):
    path = str(tmp_path / "ids")
    orcids.write_ids(docs, path)
    rows = in_order(tuple(r) for r in orcids.digests(spark, path).collect())
    by_start = sorted(rows, key=lambda r: r[1])
    assert [r[0] for r in rows] == [r[0] for r in by_start]  # ascending, nulls first
    at = 0
    for _, start, n, _ in by_start:
        assert start == at
        at += n
    crc = [(k, zlib.crc32(struct.pack(f"<{len(x)}I", *x)), len(x)) for k, x in ((k, plain(t)) for k, t in TEXTS)]
    assert Counter(crc) == Counter((k, c, n) for k, _, n, c in rows)
    files = sorted(Path(path).glob("*.orc"))
    assert files and all(pyarrow.orc.ORCFile(f).compression == "ZSTD" for f in files)


def test_empty_table_has_no_ids(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    orcids.write_ids(docs.limit(0), path)
    assert orcids.digests(spark, path).count() == 0


def test_one_key_of_a_third_of_the_rows_fills_several_files(spark, tmp_path):
    df = spark.range(3000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("doc_id"), F.lit("a b").alias("text")
    )
    path = str(tmp_path / "ids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        orcids.write_ids(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    written = orcids.read_ids(spark, path)
    assert written.count() == 3000
    assert written.filter("key = 7").select("part").distinct().count() > 1
    starts = [r.start for r in orcids.digests(spark, path).collect()]
    assert sorted(starts) == list(range(0, 9000, 3))


def test_stretch_and_find(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    orcids.write_ids(docs, path)
    rows = {r.part: r.first for r in orcids.file_starts(spark, path).collect()}
    held = sorted((rows[r.part] + r.before, r.ids) for r in orcids.read_ids(spark, path).collect())
    stream = [i for _, ids in held for i in ids]
    for first, last in ((0, 5), (17, 400), (len(stream) - 3, len(stream) + 9), (50, 50)):
        cut = sorted((r.start, r.ids) for r in orcids.stretch(spark, path, first, last).collect())
        assert [i for _, ids in cut for i in ids] == stream[first:last]
    found = orcids.find(spark, path, [8, 12])
    assert sorted(r.key for r in found.collect()) == [8, 12]
    assert "PushedFilters: [In(key, [" in found._jdf.queryExecution().executedPlan().toString()


def white(spark, vectors):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in vectors], "vec_id long, embedding array<float>, n int, x double")
    return sorted(whitening.whiten(df).collect(), key=lambda r: (r.vec_id, r.component))


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(5)
    v = (rng.normal(size=(300, 8)) * [5, 3, 2, 1, 0.5, 0.5, 0.1, 0.1]).astype("f4")
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(1000 + i, v[0].tolist()) for i in range(200)]
    bad = [(5000, None), (5001, [None, *v[0][1:].tolist()]), (5002, [math.nan] * 8), (5003, [math.inf] * 8), (5004, [1.0]), (5005, [])]
    found = white(spark, rows + bad)
    x = np.unique(np.floor(v.astype(float) * 256).astype("i8"), axis=0)
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(found) == 4 * 500 and {r.n for r in found} == {n}
    assert np.allclose([found[i].explained for i in range(4)], (e / e.sum())[:4], rtol=1e-10)
    assert found[0].identity_error < 1e-10
    for r in found:
        at = np.floor(v[r.vec_id if r.vec_id < 1000 else 0].astype(float) * 256).astype("i8")
        assert r.deviation == int(((n * at - s) ** 2).sum())
        want = (at - s / n) @ u[:, r.component - 1] / math.sqrt(e[r.component - 1])
        assert abs(abs(r.whitened) - abs(want)) < 1e-9
    of = {(r.vec_id, r.component): r.whitened for r in found}
    assert all(of[1000 + i, k] == of[0, k] for i in range(200) for k in range(1, 5))


def test_whitening_of_dependent_columns_and_few_vectors(spark):
    rng = np.random.default_rng(6)
    two = rng.normal(size=(50, 2))
    v = np.hstack([two, two @ [[1, 2], [3, -1]], np.full((50, 1), 3.0)])
    v = np.round(v * 4) / 4
    v[:, 2:4] = v[:, :2] @ [[1, 2], [3, -1]]
    found = white(spark, [(i, x.tolist()) for i, x in enumerate(v)])
    assert {r.component for r in found} == {1, 2} and found[0].identity_error < 1e-6
    assert abs(sum(found[i].explained for i in range(2)) - 1) < 1e-9
    for few in ([], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [1.0, 2.0])], [(0, None)], [(0, [])]):
        assert white(spark, few) == []
    two_rows = white(spark, [(0, [0.0, 0.0]), (None, [1.0, 1.0])][:1] + [(1, [1.0, 1.0])])
    assert [(r.vec_id, r.component, round(abs(r.whitened), 9), r.explained) for r in two_rows] == [(0, 1, 1.0, 1.0), (1, 1, 1.0, 1.0)]


def test_large_entries_are_exact(spark):
    found = white(spark, [(0, [2.0**40, 0.0]), (1, [0.0, 1.0]), (2, [-(2.0**40), 3.0])])
    x = [[1 << 48, 0], [0, 256], [-(1 << 48), 768]]
    s = [sum(a) for a in zip(*x)]
    exact = [sum((3 * a - b) ** 2 for a, b in zip(row, s)) for row in x]
    assert [r.deviation for r in found if r.component == 1] == [a if a < 1 << 63 else None for a in exact]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items):
    """Brute force over all documents and items: (item, rank, key, score)."""
    def cut(text):
        return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    held = [(k, Counter(cut(t))) for k, t in docs]
    held = [(k, c, sum(c.values())) for k, c in held if c]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(cut(text))
    out = []
    for item, listed in asked.items():
        scores = []
        for k, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in listed if t in c
            )
            if score > 0:
                scores.append((-score, k is None, k))
        out += [(item, i, k, -s) for i, (s, _, k) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:10], 1)]
    return out


def found(spark, docs, items, **settings):
    d = spark.createDataFrame([(k, t, 1, 2) for k, t in docs], "doc_id long, text string, score int, rank int").repartition(3)
    q = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, score int")
    return [tuple(r) for r in lexical.search(d, q, **settings).collect()]


def test_search_equals_brute_force(spark):
    docs = [*TEXTS, (99, LONG), *[(200 + i, prose(i % 7, 40) + " " + prose(300 + i, 20)) for i in range(120)]]
    docs += [(400 + i, prose(3, 40)) for i in range(60)]  # equal texts tie
    items = [(0, prose(3, 40)), (1, prose(5, 30)), (2, None), (3, "The OF and to É é one"), (4, "never_seen_zz"),
             (5, "one"), (5, "one two"), (6, prose(1, 200)), (7, LONG[:3000])]
    want = sorted(ranked(docs, items))
    assert sorted(found(spark, docs, items)) == want
    assert sorted(found(spark, docs, items, pairs=40)) == want  # several passes


@pytest.mark.parametrize("block", [1, 1000])
def test_any_block_size_gives_the_same(spark, monkeypatch, block):
    docs = [(i, prose(i % 50, 12) + " " + prose(500 + i, 6)) for i in range(300)]
    items = [(i, prose(i, 9)) for i in range(10)]
    monkeypatch.setattr(lexical, "CELLS", 500)
    monkeypatch.setattr(lexical, "depth", lambda df: min(lexical.PLANES, max(0, math.ceil(math.log2(df / block)))))
    assert sorted(found(spark, docs, items)) == sorted(ranked(docs, items))


def test_blocks_are_skipped(spark, monkeypatch):
    docs = [(i, prose(i % 50, 12) + " " + prose(500 + i, 6)) for i in range(600)]
    items = [(i, prose(i, 9)) for i in range(10)]
    monkeypatch.setattr(lexical, "BLOCK", 2)
    figures = []

    def seen(queries, plan, weighed, blocks):
        shared = spark.sparkContext.broadcast(plan)
        every = lexical._members(weighed, shared).select("block").distinct().collect()
        left = blocks.agg(F.sum(F.size("_qs"))).first()[0]
        figures.append((sum(len(plan.lists[r.block >> lexical.PLANES]) for r in every), left))

    assert sorted(found(spark, docs, items, seen=seen)) == sorted(ranked(docs, items))
    assert 0 < figures[0][1] < figures[0][0]


def test_search_in_nothing(spark):
    assert found(spark, [], [(0, "a")]) == [] and found(spark, [(0, "a"), (1, None)], []) == []
    assert found(spark, [(0, ""), (1, None)], [(0, "a"), (None, None)]) == []
    assert found(spark, [(0, "a b"), (1, "b")], [(None, "a")]) == ranked([(0, "a b"), (1, "b")], [(None, "a")])


@pytest.mark.parametrize("small", [1.0, 1e-4, 1e-7])
def test_badly_conditioned_vectors(spark, small):
    rng = np.random.default_rng(7)
    v = rng.integers(-1000, 1000, (200, 3)) * [2**20, max(1, int(2**20 * small)), max(1, int(2**20 * small))]
    found = white(spark, [(i, (x / 256).tolist()) for i, x in enumerate(v)])
    assert {r.component for r in found} == {1, 2, 3} and found[0].identity_error < 1e-4
