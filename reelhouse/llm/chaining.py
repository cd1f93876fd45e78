"""Repeated passages by collinear chaining of shared word k-mers.

Of every window of k-mers the one with the least hash is a seed, so an exact repeat of WORDS_K + WINDOW - 1
words has a seed in common. A document that has a seed is paired with the first document that has it alone,
so a passage in a thousand documents gives a thousand pairs and not a million. Of two paired documents all places
of all seeds that they share are matches, periodic runs as their first and last place; the
matches are chained in order of both texts, with costs for gaps; a Fenwick tree holds the
best chain so far up to each place of the other text. Chains are then aligned word by word, between matches
and beyond the ends, and their stretches that are long and alike enough are passages.

The seeds of a passage may first be seen in several documents, none of which has enough of it. So where shared
seeds follow each other for LEAST_WORDS words and no passage covers them, a second round matches all runs of
LEAST_WORDS words there with the first document that holds the run whole.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import chain as joined

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.bagminhash import _A, WORD, mix
from reelhouse.llm.common import done_with, kept, map_rows, read, stage

WORDS_K = 8
WINDOW = 8
GAP = 0.5  # cost of a word passed over; a match is worth the words it adds
LEAST_WORDS = 50
LEAST_ALIKE = 0.8
EVERY = 4096  # matches of one seed in two texts up to which each place meets each
DROP = 10.0  # an end is extended until it is this far below its best
TOGETHER = 1 << 20  # characters of texts that are hashed in one go; a longer text alone
_NONE = -(1 << 63)


def together(sizes: list[int]) -> Iterator[slice]:
    """Rows next to each other that have TOGETHER characters at most, or one row."""
    begin = total = 0
    for end, size in enumerate(sizes):
        if end > begin and total + size > TOGETHER:
            yield slice(begin, end)
            begin, total = end, 0
        total += size
    if sizes:
        yield slice(begin, len(sizes))


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word in lower case, text after text, and the bounds of the texts."""
    found = [text.lower().encode().split() for text in texts]  # bytes are split at the six characters of WORD only
    bounds = np.cumsum([0, *map(len, found)])
    return np.fromiter(map(xxhash.xxh64_intdigest, joined.from_iterable(found)), np.uint64, bounds[-1]), bounds


def kmers(h: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of `size` words, longer ones by their runs of WORDS_K words."""
    n = max(0, len(h) - size + 1)
    key = np.zeros(n, np.uint64)
    if size <= WORDS_K:
        starts = list(range(size))
    else:
        h, starts = kmers(h, WORDS_K), [*range(0, size - WORDS_K, WORDS_K), size - WORDS_K]
    for i in starts if n else ():
        key = mix(key * _A + h[i : i + n])
    return key


def minima(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and places (in words) of the window minima of texts, and the bounds of the texts among them.

    Fewer k-mers than WINDOW are one window. Of equal hashes in a window the first one is taken.
    """
    begin, sizes = bounds[:-1], np.diff(bounds)
    n = np.maximum(sizes - WORDS_K + 1, 0)
    place = np.arange(len(h))
    # runs beyond the end of a text come last: there are as many as a short text lacks of a window
    best = np.full(len(h) + WINDOW - 1, np.iinfo(np.uint64).max)
    found = kmers(h, WORDS_K)
    best[: len(found)] = found
    best[: len(h)][place >= np.repeat(begin + n, sizes)] = np.iinfo(np.uint64).max
    key, at, step = best, np.arange(len(best)), 1
    while step < WINDOW:  # a power of two
        at = np.where(best[step:] < best[:-step], at[step:], at[:-step])
        best = np.minimum(best[step:], best[:-step])
        step *= 2
    windows = np.where(n > 0, np.maximum(n - WINDOW + 1, 1), 0)
    at = at[place < np.repeat(begin + windows, sizes)]
    at = at[np.diff(at, prepend=-1) > 0]
    ends = np.searchsorted(at, bounds)
    return key[at], at - np.repeat(begin, np.diff(ends)), ends


class Fenwick:
    """The greatest value, and whose it is, over the first places."""

    def __init__(self, size: int):
        self.best = [(float("-inf"), -1)] * (size + 1)

    def put(self, place: int, value: float, who: int) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place][0]:
                self.best[place] = (value, who)
            place += place & -place

    def before(self, place: int) -> tuple[float, int]:
        found = (float("-inf"), -1)
        while place > 0:
            if self.best[place][0] > found[0]:
                found = self.best[place]
            place -= place & -place
        return found


def chains(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Disjoint chains of matches (place, other place), ascending in both, best ones first.

    A match is worth the words that it adds to the one before; words passed over cost GAP each.
    """
    matches = sorted(set(matches), key=lambda m: (m[0], -m[1]))
    # on one diagonal without a gap that costs more than the next match is worth, each match adds to the one before
    if all(a - c == d - f and a - d < WORDS_K + WORDS_K / GAP for (d, f), (a, c) in zip(matches, matches[1:])):
        return [matches] if matches else []
    ranks = {c: i for i, c in enumerate(sorted({c for _, c in matches}))}
    tree = Fenwick(len(ranks))
    worth, previous = [], []
    beside: dict[int, int] = {}  # the last match on each diagonal
    for i, (a, c) in enumerate(matches):
        best, whose = float(WORDS_K), -1
        for j in {tree.before(ranks[c])[1], beside.get(a - c, -1)} - {-1}:
            steps = a - matches[j][0], c - matches[j][1]
            new = min(WORDS_K, *steps)
            value = worth[j] + new - GAP * (max(steps) - new)
            if value > best:
                best, whose = value, j
        worth.append(best)
        previous.append(whose)
        beside[a - c] = i
        tree.put(ranks[c], best + GAP * (a + c) / 2, i)
    used = [False] * len(matches)
    out = []
    for i in sorted(range(len(matches)), key=lambda i: -worth[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(matches[i])
            i = previous[i]
        if chain:
            out.append(chain[::-1])
    return out


def _extend(a: np.ndarray, b: np.ndarray) -> int:
    """For how many words from the start on a and b go on being alike."""
    best = found = score = 0
    for i, (x, y) in enumerate(zip(a[:16].tolist(), b[:16].tolist())):  # most ends fall at once
        score += 1 if x == y else -3
        if score > best:
            best, found = score, i + 1
        elif score < best - DROP:
            return found
    size, limit = min(len(a), len(b)), 256
    if size <= 16:
        return found
    while size:
        score = np.where(a[:limit][:size] == b[:limit][:size], 1, -3).cumsum()
        fallen = np.flatnonzero(score < np.maximum(np.maximum.accumulate(score), 0) - DROP)
        if len(fallen) or limit >= size:
            best = int(score[: fallen[0] + 1].argmax() if len(fallen) else score.argmax())
            return best + 1 if score[best] > 0 else 0
        limit *= 4
    return 0


def ends(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int]]) -> tuple[int, int]:
    """For how many words a and b go on being alike before a chain and after it."""
    (begin_a, begin_b), (end_a, end_b) = chain[0], chain[-1]
    return _extend(a[:begin_a][::-1], b[:begin_b][::-1]), _extend(a[end_a + WORDS_K :], b[end_b + WORDS_K :])


def blocks(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int]], left: int, right: int) -> np.ndarray:
    """Rows place, other place, length of the runs of words that agree along a chain and in the words on its left
    and right, ascending in both."""
    out: list[list[int]] = []

    def put(i: int, j: int, n: int) -> None:
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1][2] += n
        elif n:
            out.append([i, j, n])

    def along(i: int, j: int, n: int) -> None:
        same = np.concatenate([[False], a[i : i + n] == b[j : j + n], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1]).tolist()
        for begin, end in zip(turns[::2], turns[1::2]):
            put(i + begin, j + begin, end - begin)

    at_a, at_b = chain[0]
    from_a, from_b = at_a - left, at_b - left  # where the diagonal begins, on which the matches lie
    for i, j in chain[1:]:
        if i - at_a != j - at_b:
            along(from_a, from_b, at_a - from_a)
            matcher = SequenceMatcher(None, a[at_a:i].tolist(), b[at_b:j].tolist(), autojunk=False)
            for m in matcher.get_matching_blocks():
                put(at_a + m.a, at_b + m.b, m.size)
            from_a, from_b = i, j
        at_a, at_b = i, j
    along(from_a, from_b, at_a + WORDS_K + right - from_a)
    return np.array(out, np.int64).reshape(-1, 3)


def parts(runs: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """from, to in a, from, to in b, and the share of words that agree, of those stretches of agreeing runs
    that are long and alike enough. Of all ways to cut, the one with the most words that agree less words
    that do not is taken, so unlike text between two passages belongs to neither."""
    if not len(runs):
        return []
    from_a, from_b, size = runs.T
    to_a, to_b = from_a + size, from_b + size
    sums = np.concatenate([[0], size.cumsum()])
    best, cut = np.zeros(len(runs) + 1), np.full(len(runs) + 1, -1)
    for j in range(len(runs)):
        span = np.maximum(to_a[j] - from_a[: j + 1], to_b[j] - from_b[: j + 1])
        agreed = sums[j + 1] - sums[: j + 1]
        fits = (to_a[j] - from_a[: j + 1] >= LEAST_WORDS) & (agreed >= LEAST_ALIKE * span)
        value = np.where(fits, best[: j + 1] + 2 * agreed - span, -1.0)
        i = int(value.argmax())
        best[j + 1], cut[j + 1] = (value[i], i) if value[i] > best[j] else (best[j], -1)
    out, j = [], len(runs)
    while j > 0:
        i = int(cut[j])
        if i < 0:
            j -= 1
            continue
        a, b = (int(from_a[i]), int(to_a[j - 1])), (int(from_b[i]), int(to_b[j - 1]))
        out.append((*a, *b, float(sums[j] - sums[i]) / max(a[1] - a[0], b[1] - b[0])))
        j = i
    return out[::-1]


def _seeded(rows: DataFrame) -> DataFrame:
    """`_key`, `_t`, `n` (words) and `seeds` of each row."""

    def start():
        def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            texts = batch["_text"].to_pylist()
            sizes, counts, keys, ats = [], [[0]], [], []
            for some in together([len(text) for text in texts]):
                h, bounds = coded(texts[some])
                key, at, found = minima(h, bounds)
                sizes.append(np.diff(bounds))
                counts.append(np.diff(found))
                keys.append(key.view(np.int64))
                ats.append(at.astype(np.int32))
            seeds = pa.StructArray.from_arrays([np.concatenate(keys), np.concatenate(ats)], names=["h", "at"])
            listed = pa.ListArray.from_arrays(np.concatenate(counts).cumsum().astype(np.int32), seeds)
            return {"_key": batch["_key"], "_t": batch["_t"], "n": pa.array(np.concatenate(sizes)), "seeds": listed}

        return work

    schema = "_key bigint, _t bigint, n int, seeds array<struct<h:bigint,at:int>>"
    return map_rows(rows, start, schema, lists=False)


def _numbered(rows: DataFrame) -> DataFrame:
    """`_t`, its least key `_own`, whether one row only has both, and `_id`, which ascends by both: one row for each
    text."""
    each = rows.groupBy("_t", "_key").agg((F.count("*") == 1).alias("_once"))
    least = each.groupBy("_t").agg(F.min("_key").alias("_own"), F.min_by("_once", "_key").alias("_once"))
    return least.orderBy("_own", "_t").select("_t", "_own", "_once", F.monotonically_increasing_id().alias("_id"))


class Seeds:
    """The hashes and places of a text's seeds."""

    def __init__(self, key: np.ndarray, at: np.ndarray):
        self.keys, self.at = key.tolist(), at.tolist()
        self.distinct = set(self.keys)


def _spots(seeds: Seeds, common: set[int]) -> dict[int, list[int]]:
    """The places of each common seed; of places at even steps (a periodic run) the first and the last."""
    spots: dict[int, list[int]] = {}
    for k, p in [m for m in zip(seeds.keys, seeds.at) if m[0] in common]:
        spots.setdefault(k, []).append(p)
    for k, x in spots.items():
        if len(x) > 2:
            inner = [q for p, q, r in zip(x, x[1:], x[2:]) if q - p != r - q]
            spots[k] = [x[0], *inner, x[-1]]
    return spots


def places(ours: Seeds, others: Seeds) -> list[tuple[int, int]]:
    """Matches of all places of the seeds that two texts share. Seeds with more than EVERY of them are
    matched in order, from both ends."""
    common = ours.distinct & others.distinct
    left, right = _spots(ours, common), _spots(others, common)
    out: list[tuple[int, int]] = []
    for k, x in left.items():
        y = right[k]
        if len(x) * len(y) <= EVERY:
            out.extend((p, q) for p in x for q in y)
        else:
            n = min(len(x), len(y))
            out.extend([*zip(x, y), *zip(x[-n:], y[-n:])])
    return out


def shared_parts(a: np.ndarray, b: np.ndarray, matches: list[tuple[int, int]]) -> list[tuple]:
    """The passages of a that b has, none inside another."""
    found: list[tuple] = []
    for chain in chains(matches):
        begin, end = chain[0][0], chain[-1][0] + WORDS_K
        if any(f[0] <= begin and end <= f[1] for f in found):
            continue
        left, right = ends(a, b, chain)
        if end + right - (begin - left) >= LEAST_WORDS:
            found.extend(parts(blocks(a, b, chain, left, right)))
    out: list[tuple] = []
    for f in sorted(found, key=lambda f: (f[0], -f[1])):
        if not out or f[1] > out[-1][1]:
            out.append(f)
    return out


def _pairs(batch: dict[str, list]) -> Iterator[tuple[list[int], list[int], dict, dict]]:
    """`_id` and `_first` of some pairs at a time, and the words and the seeds of their texts, each of which is
    hashed once."""
    for some in together([len(x) + len(y) for x, y in zip(batch["_text"], batch["_other"])]):
        ids, firsts = batch["_id"][some], batch["_first"][some]
        texts = dict(zip([*ids, *firsts], [*batch["_text"][some], *batch["_other"][some]]))
        h, bounds = coded(list(texts.values()))
        key, at, found = minima(h, bounds)
        words, seeds = {}, {}
        for n, i in enumerate(texts):
            words[i] = h[bounds[n] : bounds[n + 1]]
            seeds[i] = Seeds(key[found[n] : found[n + 1]], at[found[n] : found[n + 1]])
        yield ids, firsts, words, seeds


def _aligned(pairs: DataFrame) -> DataFrame:
    """Passages of pairs `_id`, `_first`, `_text`, `_other`."""

    def start():
        def work(batch: dict[str, list]) -> dict[str, list]:
            names = ("_id", "_first", "from_word", "to_word", "first_from", "first_to", "alike")
            out: dict[str, list] = {n: [] for n in names}
            for ids, firsts, words, seeds in _pairs(batch):
                for i, f in zip(ids, firsts):
                    for part in shared_parts(words[i], words[f], places(seeds[i], seeds[f])):
                        for name, value in zip(names, (i, f, *part)):
                            out[name].append(value)
            return out

        return work

    schema = "_id bigint, _first bigint, from_word int, to_word int, first_from int, first_to int, alike double"
    return map_rows(pairs, start, schema)


def _starts(at: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of places where LEAST_WORDS words can start whose window minima are all among the places `at`."""
    ends = [] if not len(at) else np.split(at, np.flatnonzero(np.diff(at) > WINDOW) + 1)
    ranges = [(max(0, int(x[0]) - WINDOW + 1), int(x[-1]) + WORDS_K + WINDOW - LEAST_WORDS) for x in ends]
    return [(begin, end) for begin, end in ranges if begin < end]


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The list of each row, empty for null."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    return np.split(column.flatten().to_numpy(), sizes.cumsum()[:-1])


def _uncovered(docs: DataFrame) -> DataFrame:
    """Of `_id`, `_seeds` and `_spans`: `ranges` where a passage can start that has a shared seed outside the
    spans, and the hashes of its seeds."""

    def start():
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {"_id": [], "ranges": [], "hashes": []}
            for i, *found in zip(batch["_id"].to_pylist(), *(_lists(batch[c]) for c in ("at", "h", "from", "to"))):
                order = found[0].argsort()
                at, h = found[0][order], found[1][order]
                starts = _starts(at)
                if not starts:
                    continue
                left = np.zeros(at[-1] + LEAST_WORDS + WORDS_K + WINDOW, bool)
                for p in at.tolist():
                    left[p : p + WORDS_K] = True
                for begin, end in zip(*(x.tolist() for x in found[2:])):
                    left[begin:end] = False
                sums = np.concatenate([[0], left.cumsum()])
                ranges, hashes = [], set()
                for begin, end in starts:
                    p = np.arange(begin, end)
                    some = np.concatenate([[False], sums[p + LEAST_WORDS] > sums[p], [False]])
                    turns = (np.flatnonzero(some[1:] != some[:-1]) + begin).tolist()
                    for x, y in zip(turns[::2], turns[1::2]):
                        ranges.append({"begin": x, "end": y})
                        hashes.update(h[(at >= x) & (at < y + LEAST_WORDS - WORDS_K)].tolist())
                if ranges:
                    out["_id"].append(i)
                    out["ranges"].append(ranges)
                    out["hashes"].append(list(hashes))
            return out

        return work

    columns = {"at": "_seeds.at", "h": "_seeds.h", "from": "_spans.from_word", "to": "_spans.to_word"}
    schema = "_id bigint, ranges array<struct<begin:int,end:int>>, hashes array<bigint>"
    return map_rows(docs.select("_id", *[F.col(c).alias(n) for n, c in columns.items()]), start, schema, lists=False)


def _long_kmers(docs: DataFrame) -> DataFrame:
    """`_id` and the runs of LEAST_WORDS words that start where `_ats` say."""

    def start():
        def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            texts, starts = batch["_text"].to_pylist(), [_starts(np.sort(ats)) for ats in _lists(batch["_ats"])]
            counts, keys, ats = [0], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for some in together([len(text) for text in texts]):
                h, bounds = coded(texts[some])
                key = kmers(h, LEAST_WORDS)
                for ranges, first, last in zip(starts[some], bounds.tolist(), bounds[1:].tolist()):
                    at = [np.arange(begin, min(end, last - first - LEAST_WORDS + 1)) for begin, end in ranges]
                    ats.extend(at)
                    keys.extend(key[first + x] for x in at)
                    counts.append(sum(map(len, at)))
            found = [np.concatenate(keys).view(np.int64), np.concatenate(ats).astype(np.int32)]
            seeds = pa.StructArray.from_arrays(found, names=["h", "at"])
            return {"_id": batch["_id"], "seeds": pa.ListArray.from_arrays(np.cumsum(counts).astype(np.int32), seeds)}

        return work

    schema = "_id bigint, seeds array<struct<h:bigint,at:int>>"
    return map_rows(docs.select("_id", "_ats", "_text"), start, schema, lists=False)


def exact_parts(a: np.ndarray, b: np.ndarray, to: dict[int, int]) -> list[tuple]:
    """Equal stretches of a and b that cover all runs of LEAST_WORDS words at the places `to`."""

    def agree(x: np.ndarray, y: np.ndarray) -> int:
        n = min(len(x), len(y))
        other = np.flatnonzero(x[:n] != y[:n])
        return int(other[0]) if len(other) else n

    order, out, done, p = sorted(to), [], 0, min(to, default=None)
    while p is not None:
        q = to[p]
        n, after = agree(a[p:], b[q:]), p
        if n >= LEAST_WORDS:
            back = agree(a[done:p][::-1], b[:q][::-1])
            out.append((p - back, p + n, q - back, q + n, 1.0))
            done = after = p + n
        # the last run that goes on from what is covered, else the next one
        on = next((r for r in range(after, max(p, after - LEAST_WORDS), -1) if r in to), None)
        i = bisect_right(order, after)
        p = on if on is not None else order[i] if i < len(order) else None
    return out


def _exact(pairs: DataFrame) -> DataFrame:
    def start():
        def work(batch: dict[str, list]) -> dict[str, list]:
            names = ("_id", "_first", "from_word", "to_word", "first_from", "first_to", "alike")
            out: dict[str, list] = {n: [] for n in names}
            columns = ("_id", "_first", "matches", "ranges", "_text", "_other")
            for i, f, matches, ranges, x, y in zip(*(batch[c] for c in columns)):
                to = {m["at"]: m["to"] for m in matches}
                wanted = {p: to[p] for r in ranges for p in range(r["begin"], r["end"]) if p in to}
                if not wanted:
                    continue
                for part in exact_parts(coded([x])[0], coded([y])[0], wanted):
                    for name, value in zip(names, (i, f, *part)):
                        out[name].append(value)
            return out

        return work

    schema = "_id bigint, _first bigint, from_word int, to_word int, first_from int, first_to int, alike double"
    return map_rows(pairs, start, schema)


def _second_round(texts: DataFrame, some: DataFrame, left: DataFrame) -> DataFrame:
    """Passages of the documents `left` whose seeds are first seen in several documents: runs of LEAST_WORDS
    words are matched with the first document that holds them whole. Of `texts` and `some` nothing is left."""
    hashes = kept(left.select(F.explode("hashes").alias("h")).distinct(), "hashes")
    holders = kept(some.join(hashes, "h").groupBy("_id").agg(F.collect_set("at").alias("_ats")), "holders")
    held_texts = kept(holders.join(texts.select("_id", "_text"), "_id"), "texts")
    spark = left.sparkSession
    done_with(spark, texts, some, hashes, holders)
    listed = kept(_long_kmers(held_texts), "runs")
    found = listed.select("_id", F.explode("seeds").alias("_s")).select("_id", "_s.h", "_s.at")
    ends = found.groupBy("h").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    shared = kept(ends.filter("_first < _last").select("h", "_first"), "shared")
    held = kept(found.join(shared, "h"), "held")
    done_with(spark, listed, shared)
    place = kept(held.filter("_id = _first").groupBy("h").agg(F.min("at").alias("to")), "places")
    ours = held.filter("_id <> _first").join(left.select("_id"), "_id", "left_semi")
    pairs = ours.join(place, "h").groupBy("_id", "_first").agg(F.collect_set(F.struct("at", "to")).alias("matches"))
    plain = held_texts.select("_id", "_text")
    both = pairs.join(left.select("_id", "ranges"), "_id").join(plain, "_id")
    return _exact(both.join(plain.toDF("_first", "_other"), "_first"))


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    own = F.coalesce(F.col(key).cast("long"), F.lit(_NONE))
    return df.select(own.alias("_key"), F.xxhash64(body).alias("_t"), body.alias("_text"))


def _texts(rows: DataFrame, ids: DataFrame, lists: DataFrame) -> DataFrame:
    """`_id`, `_text` and `_firsts`, the ids it is compared with, of the ids in `lists` (`_id`, `_firsts`); and of those
    that they are compared with, which are `_wanted`.

    A text goes through one shuffle: only where rows have both key and text in common, one of them is chosen.
    """
    wanted = lists.select(F.explode("_firsts").alias("_id")).distinct().withColumn("_wanted", F.lit(True))
    chosen = ids.join(lists.join(wanted, "_id", "full"), "_id").withColumnRenamed("_own", "_key")
    names = ("_text", "_firsts", "_wanted")
    found = kept(rows.join(chosen, ["_t", "_key"]).select("_id", *names, "_once"), "texts")
    again = found.filter("not _once").groupBy("_id").agg(*[F.any_value(c).alias(c) for c in names])
    return found.filter("_once").select("_id", *names).unionByName(kept(again, "again"))


def passages(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages of at least LEAST_WORDS words that a document shares with the first document that has them:
    `key`, `mark` (a hash of the text), `first_id`, `from_word`, `to_word`, `first_from`, `first_to`, `alike`.

    Documents are told apart by key and text, so each version of a key and each text without a key is one.
    "First" is by key, null keys before all others, and then by the hash of the text; words are compared in
    lower case. Texts that are equal are looked at once: the later ones are one passage each. Null and short
    texts have no passages; an empty table gives none. Texts are told apart by a 64-bit hash.
    """
    spark, rows = df.sparkSession, _rows(df, key, text)
    ids = kept(_numbered(rows), "ids")
    listed = kept(
        _seeded(rows).join(ids, "_t").select(
            "_key", "_t", "_own", "_id", "n", F.when(F.col("_key") == F.col("_own"), F.col("seeds")).alias("seeds")
        ),
        "seeds",
    )
    done_with(spark)
    found = listed.select("_id", F.explode("seeds").alias("_s")).select("_id", "_s.h", "_s.at")
    ends = found.groupBy("h").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    # written, so that both sides of the joins below are plain shuffles, whose hot keys are split at run time
    shared = kept(ends.filter("_first < _last").select("h", "_first"), "shared")
    done_with(spark)
    some = kept(found.join(shared, "h"), "matches")
    copies = kept(
        listed.filter((F.col("_key") != F.col("_own")) & (F.col("n") >= LEAST_WORDS))
            .select("_key", "_t", "_own", "n").distinct(),
        "copies",
    )
    done_with(spark, listed, shared)
    per = kept(
        some.filter("_id <> _first").groupBy("_id").agg(
            F.collect_set(F.struct("at", "h", "_first")).alias("_seeds")  # at most the seeds of one text
        ),
        "per",
    )
    each = F.array_distinct(F.transform("_seeds", lambda s: s["_first"]))
    texts = _texts(rows, ids, per.select("_id", each.alias("_firsts")))
    done_with(spark)
    pairs = texts.select("_id", "_text", F.explode("_firsts").alias("_first"))
    others = texts.filter("_wanted").select(F.col("_id").alias("_first"), F.col("_text").alias("_other"))
    out = kept(_aligned(pairs.join(others, "_first")), "passages")
    spans = out.groupBy("_id").agg(F.collect_list(F.struct("from_word", "to_word")).alias("_spans"))
    left = kept(_uncovered(per.join(spans, "_id", "left")), "left")
    done_with(spark, per)
    if left.isEmpty():
        done_with(spark, texts, some)
    else:
        out = out.unionByName(_second_round(texts, some, left))
    owner = F.nullif("_own", F.lit(_NONE))
    parts_ = (
        out.join(ids.select("_id", owner.alias(key), F.col("_t").alias("mark")), "_id")
        .join(ids.select(F.col("_id").alias("_first"), owner.alias("first_id")), "_first")
        .select(key, "mark", "first_id", "from_word", "to_word", "first_from", "first_to", "alike")
    )
    whole = copies.select(
        F.col("_key").alias(key), F.col("_t").alias("mark"), owner.alias("first_id"),
        F.lit(0).alias("from_word"), F.col("n").alias("to_word"),
        F.lit(0).alias("first_from"), F.col("n").alias("first_to"), F.lit(1.0).alias("alike"),
    )
    return parts_.unionByName(whole)


def op5_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(read(spark, sf_dir, "documents"))


def _cut(df: DataFrame) -> DataFrame:
    """Texts without the words of `_spans`."""

    def start():
        def work(batch: dict[str, list]) -> dict[str, list]:
            out = []
            for text, spans in zip(batch["_text"], batch["_spans"]):
                places = [m.span() for m in WORD.finditer(text)]
                parts, done = [], 0
                for s in sorted(spans, key=lambda s: (s["from_word"], s["to_word"])):
                    begin, end = places[s["from_word"]][0], places[s["to_word"] - 1][1]
                    if begin > done:
                        parts.append(text[done:begin])
                    done = max(done, end)
                parts.append(text[done:])
                out.append("".join(parts))
            return {"_row": batch["_row"], "_left": out}

        return work

    return map_rows(df.select("_row", "_text", "_spans"), start, "_row bigint, _left string")


@stage
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages that an earlier document has; who has no word left goes."""
    own = F.coalesce("doc_id", F.lit(_NONE))
    spans = passages(docs).groupBy(own.alias("_id"), F.col("mark").alias("_mark")).agg(
        F.collect_list(F.struct("from_word", "to_word")).alias("_spans")  # of one text
    )
    spans = kept(spans, "spans")
    body = F.coalesce("text", F.lit(""))
    keyed = docs.withColumns(
        {"_id": own, "_mark": F.xxhash64(body), "_row": F.xxhash64("doc_id", body)}
    ).join(spans, ["_id", "_mark"], "left")
    same = keyed.filter("_spans is null").select(*docs.columns)
    touched = keyed.filter("_spans is not null")
    cut = _cut(touched.select("_row", F.col("text").alias("_text"), "_spans")).dropDuplicates(["_row"])
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    changed = touched.select(*others, "_row").join(cut, "_row").filter(F.col("_left").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("_left"), "n_chars": F.length("_left").cast("long")}
    return same.unionByName(changed.select(*[new[c].alias(c) if c in new else c for c in docs.columns]))
