"""The text operators against brute force, round trips and planted cases, and on odd rows."""

import base64
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from reelhouse.llm import bagminhash, bpe, chaining, common, fingerprints, hmm, html, mixing, quality, shards, toxicity
from reelhouse.llm.components import components
from tests.llm.conftest import SHARED, TEXTS, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def empty(df):
    return df.limit(0)


def test_bpe_equals_the_library(docs):
    path = public_tokenizers.path(bpe.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.encode(docs).collect()
    want = Counter((k, tuple(model.encode_ordinary(t or ""))) for k, t in TEXTS)
    assert want == Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found)
    assert Counter((k, (t or "").encode()) for k, t in TEXTS) == Counter((r.doc_id, bytes(r.decoded)) for r in found)
    assert bpe.encode(empty(docs)).count() == 0


def test_quality_counts(docs):
    def brute(text):
        text = text or ""
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = list(zip(w, w[1:], w[2:]))
        n = Counter(windows)
        covered = {j for i, g in enumerate(windows) if n[g] > 1 for j in (i, i + 1, i + 2)}
        return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)

    found = quality.judge(docs, ["doc_id"]).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert got == Counter((k, *brute(t)) for k, t in TEXTS)
    assert all(r.base_failed and not r.kept for r in found if r.n_words < 50)
    assert quality.judge(empty(docs), ["doc_id"]).count() == 0


def test_quality_em_trusts_the_rule_that_agrees():
    patterns = [((1, 1, 1), 60), ((-1, -1, -1), 20), ((1, 1, -1), 12), ((-1, -1, 1), 8)]
    trust = quality.learn(patterns)
    assert trust.on_bad[0] > trust.on_bad[2] and trust.log_odds((1, 1, -1)) > 0 > trust.log_odds((-1, -1, 1))


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    pairs = []
    for _ in range(150):
        u = rng.integers(0, 2**63, 60).astype(np.uint64)
        x, y = np.repeat(u[:50], rng.integers(1, 6, 50)), np.repeat(u[5:], rng.integers(1, 6, 55))
        agree = (bagminhash.signature(x) == bagminhash.signature(y)).mean()
        pairs.append((bagminhash.overlap(x, y), agree))
    exact, estimate = np.mean(pairs, axis=0)
    assert abs(exact - estimate) < 0.02


def test_near_duplicates(spark, docs):
    found = bagminhash.classes(docs).collect()
    assert len(found) == len(TEXTS)
    ids = {r.doc_id: r.class_id for r in found if r.doc_id is not None}
    assert ids[0] == ids[1] == ids[2] == 0 and ids[3] == ids[4] == 3 and ids[5] == 5 and ids[11] != ids[12]
    kept = bagminhash.dedup_stage(spark, docs, "").collect()
    assert Counter(r.doc_id for r in kept)[6] == 1 and not {1, 2, 4} & {r.doc_id for r in kept}
    assert bagminhash.classes(empty(docs)).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(30)] + [(50, 40), (41, 50), (7, 7)], "a long, b long")
    found = {r.node: r.label for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 31)}, 50: 40, 41: 40}


def test_differences_are_peeled(spark):
    a, b = list(range(1, 400)), list(range(200, 460))
    pairs = spark.createDataFrame([(1, a, b), (2, a, a), (3, [], []), (4, [5], [])], "k int, a array<long>, b array<long>")
    for r in fingerprints.differences(pairs, ["k"]).collect():
        x, y = {1: (a, b), 2: (a, a), 3: ([], []), 4: ([5], [])}[r.k]
        want = {(d, 1) for d in set(x) - set(y)} | {(d, -1) for d in set(y) - set(x)}
        assert r.differing == len(want) and {(d.digest, d.n) for d in r.digests} == want


def test_fingerprints(docs):
    found = fingerprints.fingerprint(docs).collect()
    assert len(found) == len(TEXTS)
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by[0].fingerprint == by[1].fingerprint != by[2].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert by[8].near_edited > 0.3 > by[8].near_next and by[3].n_chars == 0
    assert fingerprints.fingerprint(empty(docs)).count() == 0


def test_segments_are_maximal():
    rng = np.random.default_rng(1)
    for _ in range(100):
        s = rng.normal(-0.3, 1, rng.integers(1, 15))

        def brute(lo, hi):
            best = max(((s[i:j].sum(), -i, -j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=(0, 0, 0))
            if best[0] <= 0:
                return []
            i, j = -best[1], -best[2]
            return [*brute(lo, i), (i, j), *brute(j, hi)]

        assert sorted((i, j) for i, j, _ in toxicity.maximal_segments(s)) == brute(0, len(s))


def test_toxicity(docs, labels):
    model = toxicity.train(docs, labels)
    found = toxicity.passages(docs, model).collect()
    assert len(found) == len(TEXTS) and all(0 <= r.score <= 1 for r in found)
    none = toxicity.train(empty(docs), empty(labels))
    assert toxicity.passages(empty(docs), none).count() == 0 and toxicity.passages(docs, none).count() == len(TEXTS)


def test_templates_go_and_articles_stay(spark):
    page = "<html><body><div>Site slogan {x}</div><div><p>Body of {i} &amp; more   text</p><div>Same on all pages</div></div></body>"
    rows = [(i, f"http://a.org/{i}", page.format(i=i, x=i)) for i in range(12)]
    rows += [(20, "http://b.org/", page.format(i=20, x=1)), (21, None, None), (22, "no url", ""), (23, "http://a.org/z", "<article><p>Copy</p></article><p>z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in html.extract(pages).collect()}
    assert found[0].text == "Site slogan 0\n\nBody of 0 & more text"
    assert "Same on all pages" in found[20].text and found[21].text == "" and found[22].n_chars == 0
    assert found[23].text == "Copy" and html.extract(empty(pages)).count() == 0


def test_chains_follow_both_texts():
    matches = [(0, 100), (5, 105), (9, 300), (12, 112), (400, 500)]
    assert chaining.chains(matches)[0] == [(0, 100), (5, 105), (12, 112)]


def test_seeds_of_many_texts_are_found_together(monkeypatch):
    rng = random.Random(31)
    texts = ["", "one", "so " * 90, "A\x1cb\x85 \x0bÜ\tİ " * 9, *(prose(300 + n, n) for n in range(40))]
    texts += [" ".join(rng.choice("ab") for _ in range(n)) for n in range(60)]
    mixed = []
    monkeypatch.setattr(chaining, "mix", lambda x: mixed.append(len(x)) or bagminhash.mix(x))
    h, bounds = chaining.coded(texts)
    key, at, ends = chaining.minima(h, bounds)
    assert len(mixed) == chaining.WORDS_K  # and not as often for each text
    for n, text in enumerate(texts):
        words = WORD.findall(text.lower())
        own = h[bounds[n] : bounds[n + 1]]
        assert own.tolist() == [xxhash.xxh64_intdigest(w) for w in words]
        found = chaining.kmers(own, chaining.WORDS_K).tolist()
        windows = [range(i, min(i + chaining.WINDOW, len(found))) for i in range(max(len(found) - chaining.WINDOW, 0) + 1)]
        want = sorted({min(w, key=found.__getitem__) for w in windows if w})
        assert at[ends[n] : ends[n + 1]].tolist() == want
        assert key[ends[n] : ends[n + 1]].tolist() == [found[p] for p in want]


def test_texts_are_hashed_in_bounded_groups():
    most = chaining.TOGETHER
    sizes = [1, 2, most, 0, most - 1, 2, 3 * most, 5]
    found = [(s.start, s.stop) for s in chaining.together(sizes)]
    assert found == [(0, 2), (2, 4), (4, 5), (5, 6), (6, 7), (7, 8)] and not list(chaining.together([]))


def test_equal_stretches_need_no_tree_and_one_comparison(monkeypatch):
    words = np.random.default_rng(3).integers(0, 2**63, 600).astype("u8")
    other = np.concatenate([words[:9][::-1], words[:300], words[280:281], words[301:]])
    matches = [(p, p + 9) for p in range(0, 590, 6) if not 292 < p < 301]
    monkeypatch.delattr(chaining, "Fenwick")
    assert chaining.chains(matches) == [matches]
    assert chaining.blocks(words, other, matches, 0, 0).tolist() == [[0, 9, 300], [301, 310, 295]]
    assert chaining.shared_parts(words, other, matches) == [(0, 300, 9, 309, 1.0), (301, 600, 310, 609, 1.0)]
    monkeypatch.delattr(chaining, "blocks")  # what is too short is not aligned
    assert chaining.shared_parts(words[:49], words[:49], [(0, 0), (20, 20)]) == []


def test_rows_around_a_gap_that_costs_too_much_are_chains_apart():
    near, far = [(0, 0), (23, 23)], [(0, 0), (24, 24)]
    assert chaining.chains(near) == [near] and sorted(chaining.chains(far)) == [[(0, 0)], [(24, 24)]]


def test_passages(spark, docs):
    found = {(r.doc_id, r.first_id): r for r in chaining.passages(docs).collect()}
    assert found[12, 11].to_word - found[12, 11].from_word == 70 and found[12, 11].alike == 1
    assert found[2, 0].to_word == 200 and (11, 12) not in found
    left = {r.doc_id: r.text for r in chaining.substring_stage(spark, docs, "").collect()}
    assert SHARED in left[11] and SHARED not in left[12] and prose(13, 40) in left[12] and 1 not in left
    assert chaining.passages(empty(docs)).count() == 0


def test_passages_apart_are_kept_apart(spark):
    for before, gap, after in [(60, 40, 60), (60, 100, 60), (300, 600, 300)]:
        one, two = prose(201, before), prose(202, after)
        rows = [(1, f"{one} {prose(203, gap)} {two}"), (2, f"{one} {prose(204, gap)} {two}")]
        found = chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        spans = sorted((r.from_word, r.to_word, r.first_from, r.first_to) for r in found)
        assert spans == [(0, before, 0, before), *[(before + gap, before + gap + after) * 2]]


def test_passages_of_null_and_repeated_keys(spark):
    one, two, rest = prose(211, 80), prose(212, 60), prose(213, 300)
    rows = [
        (None, prose(214, 400)), (None, one + " " + prose(215, 20)), (None, prose(216, 30) + " " + one),
        (1, prose(217, 9) + " " + two), (5, prose(218, 40) + " " + two), (5, rest), (7, prose(219, 10) + " " + one),
    ]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_chars long")
    found = chaining.passages(docs).collect()
    spans = sorted((r.doc_id or 0, r.first_id or 0, r.to_word - r.from_word) for r in found)
    assert spans == [(0, 0, 80), (5, 1, 60), (7, 0, 80)]
    left = sorted(len(r.text.split()) for r in chaining.substring_stage(spark, docs, "").collect())
    assert left in (sorted([400, 100, 30, 69, 40, 300, 10]), sorted([400, 20, 110, 69, 40, 300, 10]))


def test_repetitive_passages(spark):
    lines = " ".join(prose(220, 3).split() * 30)
    long_lines = " ".join(prose(221, 17).split() * 9)
    runs = ["so " * 200, lines, long_lines, "one two " * 26]
    rows = [(10 * k + side, f"{prose(230 + 2 * k + side, 20 + side)} {run}") for k, run in enumerate(runs) for side in (0, 1)]
    found = chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = sorted((r.doc_id, r.from_word, r.to_word) for r in found)
    assert spans == [(10 * k + 1, 21, 21 + len(run.split())) for k, run in enumerate(runs)]


def test_passages_whose_parts_are_first_seen_apart(spark):
    whole = prose(240, 60).split()
    pieces = [" ".join(whole[a:b]) for a, b in ((0, 30), (20, 45), (35, 60))]
    rows = [(k, f"{prose(250 + k, 30)} {piece} {prose(260 + k, 30)}") for k, piece in enumerate(pieces)]
    rows += [(k, f"{prose(250 + k, 9)} {' '.join(whole)} {prose(260 + k, 9)}") for k in (5, 6)]
    rows += [(7, prose(270, 10) + " so" * 60), (8, prose(271, 11) + " so" * 200)]
    found = chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [tuple(r)[2:] for r in found if r.doc_id in (5, 6)] == [(5, 9, 69, 9, 69, 1.0)]
    covered = {w for r in found if (r.doc_id, r.first_id) == (8, 7) for w in range(r.from_word, r.to_word)}
    assert covered == set(range(11, 211))


def test_what_passages_are_done_with_is_deleted(spark, monkeypatch, tmp_path):
    numbers = itertools.count()
    monkeypatch.setattr(common, "shared_folder", lambda spark, purpose: f"{tmp_path}/a b/{purpose}-{next(numbers)}")
    whole = prose(280, 60)
    rows = [(k, f"{prose(281 + k, 30)} {whole[a:b]}") for k, (a, b) in enumerate([(0, 150), (100, 250), (200, 400)])]
    rows += [(5, f"{prose(290, 9)} {whole}"), (6, f"{prose(291, 12)} {whole}"), (7, f"{prose(291, 12)} {whole}")]
    for some, more in ((rows[:1], set()), (rows, {"texts", "held", "places"})):  # without and with a second round
        found = chaining.passages(spark.createDataFrame(some, "doc_id long, text string"))
        stay = {re.sub(r"-\d+$", "", p.name) for p in (tmp_path / "a b").iterdir()}
        assert stay == {"ids", "copies", "passages", "left"} | more
        assert len({(r.doc_id, r.to_word) for r in found.collect()} & {(6, 72), (7, 72)}) == (2 if more else 0)


def test_passages_of_repeated_rows_are_found_once(spark):
    shared = prose(300, 70)
    rows = [(1, f"{prose(301, 20)} {shared}"), (2, f"{prose(302, 30)} {shared}"), (3, f"{prose(303, 40)} {shared}")]
    found = chaining.passages(spark.createDataFrame([*rows, *rows[:2] * 3, (None, rows[0][1])], "doc_id long, text string"))
    spans = sorted((r.doc_id, r.first_id, r.from_word, r.to_word) for r in found.collect())
    assert spans == [(1, None, 0, 90), (2, None, 30, 100), (3, None, 40, 110)]


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(2)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T
    model = hmm.Model(start, move, emit)
    texts = [rng.integers(0, 5, n) for n in (4, 1, 6)]
    for text, got in zip(texts, model.score(texts)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(text)):
            p = start[path[0]] * emit[text[0], path[0]]
            for a, b, s in zip(path, path[1:], text[1:]):
                p *= move[a, b] * emit[s, b]
            total += p
        assert math.isclose(got, math.log10(total))
    counts = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    model.expected(texts, *counts)
    assert math.isclose(counts[0].sum(), 3) and math.isclose(counts[1].sum(), 8) and math.isclose(counts[2].sum(), 11)


def test_expected_counts_equal_those_over_all_paths(monkeypatch):
    rng = np.random.default_rng(5)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T
    texts = [rng.integers(0, 5, n) for n in (5, 7, 1, 7, 3)]
    want = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for text in texts:
        paths = list(itertools.product(range(3), repeat=len(text)))
        odds = np.array([
            start[p[0]] * np.prod([move[a, b] for a, b in zip(p, p[1:])]) * np.prod([emit[s, z] for s, z in zip(text, p)])
            for p in paths
        ])
        for p, share in zip(paths, odds / odds.sum()):
            want[0][p[0]] += share
            for a, b in zip(p, p[1:]):
                want[1][a, b] += share
            for s, z in zip(text, p):
                want[2][s, z] += share
    for hold, block in ((1_000, 1_000), (1_000, 4), (3, 1), (6, 12)):  # in one block, in several, worked out again
        monkeypatch.setattr(hmm, "HOLD", hold)
        monkeypatch.setattr(hmm, "BLOCK", block)
        model, got = hmm.Model(start, move, emit), (np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)))
        likely = model.expected(texts, *got)
        assert math.isclose(likely, model.score(texts).sum())
        assert all(np.allclose(a, b) for a, b in zip(want, got))


def test_a_text_of_a_million_words_is_not_held(monkeypatch):
    monkeypatch.setattr(hmm, "HOLD", 500_000)
    rng = np.random.default_rng(6)
    move, emit = rng.dirichlet(np.ones(hmm.STATES), hmm.STATES), rng.dirichlet(np.ones(50), hmm.STATES).T
    model, text = hmm.Model(np.full(hmm.STATES, 1 / hmm.STATES), move, emit), rng.integers(0, 50, 1_000_001).astype(np.int32)
    counts = np.zeros(hmm.STATES), np.zeros(move.shape), np.zeros(emit.shape)
    likely = model.expected([text], *counts)
    assert math.isclose(likely, model.score([text])[0]) and math.isclose(counts[2].sum(), len(text))


def test_training_sees_all_texts_in_each_round(spark):
    texts = ["same words all over"] * 40 + [f"{prose(300 + k % 3, 12)} text{k}" for k in range(60)]
    words_ = sorted({w for t in texts for w in WORD.findall(t)})
    symbols, unigram = hmm.Symbols(["", *words_]), np.full(1 + len(words_) + hmm.CLASSES, 1.0)
    unigram /= unigram.sum()
    coded = hmm.encoded(spark.createDataFrame([(t,) for t in texts], "_text string"), symbols)
    begun = hmm.begun(coded, unigram)
    total = sum(len(WORD.findall(t)) + 1 for t in texts)
    model, likely = hmm.trained(coded, begun, unigram, total)
    ids = [symbols.encode(t.encode())[0] for t in texts]
    assert math.isclose(likely[0], begun.score(ids).sum() / total) and len(likely) > 1
    assert model.score(ids).sum() / total >= likely[-1] - 0.01 and likely[-1] >= likely[0]


def test_counts_of_a_round_travel_in_pieces(spark, monkeypatch):
    words_ = [f"w{k}" for k in range(3_000)]
    symbols, unigram = hmm.Symbols(["", *words_]), np.full(1 + len(words_) + hmm.CLASSES, 1e-4)
    texts = [" ".join(words_[k::3]) for k in range(3)]
    coded = hmm.encoded(spark.createDataFrame([(t,) for t in texts], "_text string"), symbols)
    got, plain = [], type(coded).toArrow
    monkeypatch.setattr(type(coded), "toArrow", lambda self: got.append(plain(self)) or got[-1])
    sent = spark.sparkContext.broadcast((None, None))
    (start, _, emit), _ = hmm._summed(coded, len(unigram), sent, lambda value: hmm._mixture(*value))
    assert sum(t.num_rows for t in got) <= 20  # one row a symbol before
    want = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), np.zeros((len(unigram), hmm.STATES))
    hmm._mixture(None, None)([symbols.encode(t.encode())[0] for t in texts], *want)
    assert np.allclose(start, want[0]) and np.allclose(emit, want[2]) and math.isclose(emit.sum(), 3_003)


def test_symbols_of_many_texts_are_those_of_each():
    texts = [None, "", " \t\n\x0b\x0c\r", "A b", " b\x1c\x85\xa0c\u3000 \u00c9 ABCD", "zabcd zabcd\x00 \r\na", "x\U0001f600yz \U0001f600"]
    head = ["", "a", "b"]
    ids, begins, rare = hmm.Symbols(head).encode_all(pa.array([t and t.encode() for t in texts], pa.binary()))
    words_ = [[*WORD.findall("".join(c.lower() if c.isascii() else c for c in t or "")), ""] for t in texts]
    of = lambda w: head.index(w) if w in head else len(head) + zlib.crc32(w[-3:].encode()) % hmm.CLASSES
    assert ids.tolist() == [of(w) for t in words_ for w in t] and np.diff(begins).tolist() == [len(t) for t in words_]
    assert rare.to_pylist() == [w for t in words_ for w in t if w not in head]
    whose = np.repeat(np.arange(len(texts)), np.diff(begins))[ids >= len(head)]
    counts = [{p["word"]: p["n"] for p in t} for t in hmm._rare_of(rare, whose, len(texts)).to_pylist()]
    assert counts == [dict(Counter(w for w in t if w not in head)) for t in words_]


def test_words_are_counted_over_all_texts(spark):
    texts = [*(f"{prose(400 + k, 30)} Same same{k}" for k in range(40)), None, ""]
    want = Counter(w for t in texts for w in [*WORD.findall((t or "").lower()), ""])
    rows = spark.createDataFrame([(t,) for t in texts], "_text string")
    assert {r.word: r.c for r in hmm.counted(rows).collect()} == want
    tables = [pa.table({"word": [w], "n": [2]}) for w in "abcab"]
    assert dict(zip(*hmm._merged(tables).to_pydict().values())) == {"a": 4, "b": 4, "c": 2}


def test_rare_words_and_ties_at_the_end_of_the_head(spark, monkeypatch):
    monkeypatch.setattr(hmm, "HEAD", 4)
    monkeypatch.setattr(hmm, "CLUSTER_ROUNDS", 1)
    monkeypatch.setattr(hmm, "ENOUGH", 10.0)
    texts = ["b b b a a c c d d e e f", "g g b", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tok = lambda t: [*WORD.findall(t or ""), ""]
    c = Counter(w for t in texts for w in tok(t))
    n, v = sum(c.values()), len(c)
    base = [sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tok(t)) for t in texts]
    found = sorted(hmm.score(docs, docs).collect())
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in found] == [(len(tok(t)), len(tok(t)), n) for t in texts]
    assert np.allclose([r.base_score for r in found], base) and all(r.score < 0 for r in found)


def test_language_model_base(docs):
    train = docs.filter("doc_id % 2 = 0 or doc_id is null")
    tok = lambda t: [*WORD.findall((t or "").lower()), ""]
    c = Counter(w for k, t in TEXTS if k is None or k % 2 == 0 for w in tok(t))
    n, v = sum(c.values()), len(c)
    want = Counter(
        (k, len(tok(t)), sum(c[w] > 0 for w in tok(t)), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tok(t)), 4))
        for k, t in TEXTS
    )
    found = hmm.score(train, docs).collect()
    assert want == Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in found)
    assert all(r.train_tokens == n and r.score < 0 for r in found)
    assert hmm.score(empty(docs), docs).count() == len(TEXTS)


def test_shards(docs):
    found = shards.shard(docs, shards=5).collect()
    want = Counter((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in TEXTS)
    assert want == Counter((r.doc_id, r["size"], r.text_crc32) for r in found)
    for s in range(5):
        slots = sorted(r.slot for r in found if r.shard == s)
        assert slots == list(range(len(slots)))
    assert shards.shard(empty(docs)).count() == 0


def test_mixing(docs, labels):
    found = mixing.mix(docs, labels).collect()
    assert len(found) == len(TEXTS) and all(r.rate >= 0 and r.copies >= 0 for r in found)
    assert mixing.mix(empty(docs), labels).count() == 0


def test_rates_meet_targets(spark):
    rows = [(100, p, (1 - p) / 2, (1 - p) / 2) for p in (0.9, 0.8, 0.1, 0.2)] + [(100, 0.05, 0.9, 0.05), (100, 0.05, 0.05, 0.9)]
    members = spark.createDataFrame(rows, "tokens long, p_clean double, p_poor double, p_toxic double")
    _, reached = mixing.rates(members, [300.0, 150.0, 100.0])
    assert reached == pytest.approx([300, 150, 100], rel=0.02)


def test_pipeline_stages_keep_the_columns(spark, docs, tmp_path):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [(20 + i, 1, i % 2) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:4]:
        plain = stage(spark, plain, str(tmp_path))
        assert plain.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        plain = plain.checkpoint() if spark.conf.get("spark.checkpoint.dir", None) else plain
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[:2] == ["doc_id", "n_tokens"]
