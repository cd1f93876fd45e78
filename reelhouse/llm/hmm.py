"""A hidden Markov language model over whole texts.

Words are counted over all training texts. The HEAD most frequent ones are symbols of their own; every rarer
word shares a symbol with those of the same hashed ending, and its own probability within that class comes
from its count, by a join, wherever it stands in the text. All training texts are written once as symbols. States
begin as a mixture of unigrams fitted to all of them and are trained by Baum-Welch: each round sums expected counts
over all training texts, partition by partition, until the likelihood grows no more. The scaled forward recursion
gives the exact likelihood of a text's symbols.

Within a task the recursions run over many texts of like length at once, block of steps by block of steps. A text
too long for its forward values to be held keeps those at the block ends and works the blocks out again on the way
back, so that memory beyond the symbols themselves is bounded whatever its length.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import kept, part_of, read

STATES = 8
HEAD = 60_000  # words with a symbol of their own: bounds the model
CLASSES = 256  # of rarer words
CLUSTER_ROUNDS = 8  # of the mixture that training starts from
ENOUGH = 0.002  # gain in log10 likelihood of a token below which training ends
SMOOTH = 300.0  # symbols' worth of the unigram in each state
HOLD = 2_500_000  # places whose forward values are held, 64 bytes each
BLOCK = 128_000  # places worked on at a time
SLICE = 16_000_000  # bytes of text, or of symbols at eight a place, that a task looks at together, unless one text has more
DISTINCT = 1_000_000  # words that a task counts before it hands them on
PIECE = 512  # symbols whose counts travel in one row
PIECES = "piece int, places binary, counts binary"
END = ""  # no word is empty


def _class(word: Column) -> Column:
    return (F.crc32(F.substring(word, -3, 3).cast("binary")) % CLASSES).cast("int")


def _tokens(texts: pa.Array) -> pa.ListArray:
    """Words of each text and its end: A-Z in lower case, parted at the six blanks only; null is empty."""
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    # behind a last blank the split finds one more, empty word: the end
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(plain, ""), "", pc.binary_join_element_wise(plain, "", " ")))


class Symbols:
    """Words to symbols: the head by a table, the rest by class; the end is a head word."""

    def __init__(self, head: list[str]):
        self.head = pa.array(head, pa.string())
        self.size = len(head) + CLASSES

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Symbols of all texts and their ends one after another, where each text begins and the last one ends,
        and the words without a symbol of their own in the order in which their classes stand there."""
        lists = _tokens(texts)
        words, begins = lists.flatten(), lists.offsets.to_numpy()
        found = pc.index_in(words, value_set=self.head)
        out = pc.fill_null(found, -1).to_numpy()
        rare = words.filter(pc.is_null(found))
        if len(rare):
            endings = pc.utf8_slice_codeunits(rare, -3).dictionary_encode()
            classes = np.array([zlib.crc32(w.encode()) % CLASSES for w in endings.dictionary.to_pylist()], np.int32)
            out = out.copy()
            out[out < 0] = self.size - CLASSES + classes[endings.indices.to_numpy()]
        return out, begins - begins[0], rare

    def encode(self, text: bytes | None) -> tuple[np.ndarray, list[str]]:
        """Symbols of a text (UTF-8) and its end, and the words without a symbol of their own."""
        out, _, rare = self.encode_all(pa.array([text], pa.binary()))
        return out, rare.to_pylist()


def _slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces of SLICE bytes."""
    part = np.cumsum(sizes) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    return _slices(batch, sizes.to_numpy(zero_copy_only=False).astype(np.int64))


def _kind(size: int) -> np.dtype:
    """What a symbol takes where texts are written down."""
    return np.min_scalar_type(size - 1).newbyteorder("<")


def _coded_texts(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    texts = batch.column(0)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] // _kind(size).itemsize
    ids = np.frombuffer(texts.buffers()[2], _kind(size), ends[-1] - ends[0], ends[0] * _kind(size).itemsize)
    return np.split(ids.astype(np.int32), ends[1:-1] - ends[0])


class _Group:
    """Texts side by side, longest first: their symbols by step, those of a step by text, and for each step how
    many texts reach it and where its places begin."""

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) for t in texts])
        self.order = np.argsort(-sizes, kind="stable")
        sizes = sizes[self.order]
        self.running = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
        self.first = np.concatenate([[0], np.cumsum(self.running)])
        step = np.arange(self.first[-1]) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.ids = np.empty(self.first[-1], np.int32)
        self.ids[self.first[step] + np.repeat(np.arange(len(sizes)), sizes)] = np.concatenate([texts[i] for i in self.order])

    def blocks(self) -> list[tuple[int, int]]:
        """First steps and ends of stretches of about BLOCK places."""
        part = self.first[:-1] // BLOCK
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(self.running)]
        return list(zip(cuts, cuts[1:]))


class Model:
    """Start, moves and emissions; `emit` is symbols x states."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @cached_property
    def by_state(self) -> np.ndarray:
        return np.ascontiguousarray(self.emit.T)

    @classmethod
    def from_counts(cls, start, move, emit, unigram) -> Model:
        total = emit.sum(axis=0, keepdims=True)
        return cls(
            (start + 1) / (start + 1).sum(),
            (move + 1) / (move + 1).sum(axis=1, keepdims=True),
            (emit + SMOOTH * unigram[:, None]) / (total + SMOOTH),
        )

    def _emissions(self, group: _Group, lo: int, hi: int) -> np.ndarray:
        """States x places of the steps from lo to hi."""
        return np.take(self.by_state, group.ids[group.first[lo] : group.first[hi]], axis=1)

    def _walk(self, group: _Group, lo: int, hi: int, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Forward values (states x places) and scales of a block; `before` holds those of the step before it."""
        alphas, onward = self._emissions(group, lo, hi), np.ascontiguousarray(self.move.T)
        scales = np.empty(alphas.shape[1])
        at = 0
        for n in group.running[lo:hi].tolist():
            now, scale = alphas[:, at : at + n], scales[at : at + n]
            np.multiply(now, self.start[:, None] if before is None else onward @ before[:, :n], out=now)
            np.add.reduce(now, axis=0, out=scale)
            np.divide(now, scale, out=now)
            before = now
            at += n
        return alphas, scales

    def _last(self, group: _Group, hi: int, alphas: np.ndarray) -> np.ndarray:
        return alphas[:, alphas.shape[1] - group.running[hi - 1] :].copy()

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 likelihoods."""
        out = np.zeros(len(texts))
        if not texts:
            return out
        group, before = _Group(texts), None
        for lo, hi in group.blocks():
            alphas, scales = self._walk(group, lo, hi, before)
            before = self._last(group, hi, alphas)
            text = np.arange(len(scales)) - np.repeat(group.first[lo:hi] - group.first[lo], group.running[lo:hi])
            out += np.bincount(text, np.log10(scales), minlength=len(texts))
        likely = np.empty_like(out)
        likely[group.order] = out
        return likely

    def expected(self, texts: list[np.ndarray], start, move, emit) -> float:
        """Add the expected counts of the texts; their log10 likelihood."""
        likely, before, walked = 0.0, None, []
        group = _Group(texts)
        blocks, hold = group.blocks(), len(group.ids) <= HOLD
        for lo, hi in blocks:
            done = self._walk(group, lo, hi, before)
            likely += float(np.log10(done[1]).sum())
            walked.append((before, done if hold or hi == blocks[-1][1] else None))
            before = self._last(group, hi, done[0])
        after = np.ones((len(self.start), group.running[-1]))
        while blocks:
            (lo, hi), (before, done) = blocks.pop(), walked.pop()
            alphas, scales = done or self._walk(group, lo, hi, before)
            ahead, betas = self._emissions(group, lo, hi), np.ones_like(alphas)
            ahead /= scales
            counts = group.running[lo:hi].tolist()
            at = len(scales) - counts[-1]
            betas[:, at : at + after.shape[1]] = after
            for step in range(len(counts) - 1, -1, -1):
                n = counts[step]
                here = ahead[:, at : at + n]
                np.multiply(here, betas[:, at : at + n], out=here)
                if step:
                    at -= counts[step - 1]
                    np.matmul(self.move, here, out=betas[:, at : at + n])
                else:
                    after = self.move @ here
            first = counts[0]
            source = np.arange(first, len(scales)) - np.repeat(group.running[lo : hi - 1], group.running[lo + 1 : hi])
            moves = np.take(alphas, source, axis=1) @ ahead[:, first:].T
            gamma = np.multiply(alphas, betas, out=betas)
            if before is None:
                start += gamma[:, :first].sum(axis=1)
            else:
                moves += before[:, :first] @ ahead[:, :first].T
            move += moves * self.move
            ids = group.ids[group.first[lo] : group.first[hi]].astype(np.intp)
            for s, weights in enumerate(gamma):
                emit[:, s] += np.bincount(ids, weights, minlength=len(emit))
        return likely


def _begin_with(texts: list[np.ndarray]) -> np.ndarray:
    """States x texts: what a text belongs to before anything is known, uneven and the same for equal texts."""
    marks = np.array([zlib.crc32(t.tobytes()) for t in texts], np.uint64)
    odd = np.arange(1, STATES + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    mixed = (marks + np.uint64(1)) * odd
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    share = -np.log((mixed >> np.uint64(11)).astype(float) / 2.0**53 + 1e-12)
    return share / share.sum(axis=0)


def _mixture(log: np.ndarray | None, weights: np.ndarray | None):
    """Work of a round of the mixture of unigrams: counts of symbols by state, each text belonging to states
    as a whole; `log` is states x symbols, without it the first round."""

    def work(texts: list[np.ndarray], start, move, emit) -> float:
        sizes = np.array([len(t) for t in texts])
        ids, firsts = np.concatenate(texts).astype(np.intp), np.cumsum(sizes) - sizes  # not cast for each state anew
        if log is None:
            belongs = _begin_with(texts)
        else:
            odds = np.stack([np.add.reduceat(log[s][ids], firsts) for s in range(STATES)]) + weights[:, None]
            belongs = np.exp(odds - odds.max(axis=0))
            belongs /= belongs.sum(axis=0)
        for s in range(STATES):
            emit[:, s] += np.bincount(ids, np.repeat(belongs[s], sizes), minlength=len(emit))
        start += belongs.sum(axis=1)
        return 0.0

    return work


def _told(coded: DataFrame, size: int, sent: Broadcast, work_of: Callable) -> DataFrame:
    """Each task's counts, by the work that `work_of` makes of the broadcast value: `piece`, the first of PIECE
    symbols, with the places of those it has met and their counts (float64, state by state); -1 for the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = work_of(sent.value)
        start, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((size, STATES))
        likely = 0.0
        for batch in batches:
            lengths = pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False)
            for part in _slices(batch, 8 // _kind(size).itemsize * lengths.astype(np.int64)):
                likely += work(_coded_texts(part, size), start, move, emit)
        rows = [(-1, np.arange(2 + STATES), np.concatenate([start[None], move, np.full((1, STATES), likely)]))]
        met = np.flatnonzero(emit.any(axis=1))
        for some in np.split(met, np.flatnonzero(np.diff(met // PIECE)) + 1):
            if len(some):
                rows.append((int(some[0]) // PIECE, some % PIECE, emit[some]))
        yield _pieces(rows)

    return coded.select("_ids").mapInArrow(run, PIECES)


def _pieces(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [
        pa.array([piece for piece, _, _ in rows], pa.int32()),
        pa.array([places.astype("<u2").tobytes() for _, places, _ in rows], pa.binary()),
        pa.array([counts.astype("<f8").tobytes() for _, _, counts in rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["piece", "places", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the pieces that have come to a task: one row each."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
            into = sums.setdefault(piece, np.zeros((PIECE, STATES)))
            into[np.frombuffer(places, "<u2")] += np.frombuffer(counts, "<f8").reshape(-1, STATES)
    if sums:
        yield _pieces([(piece, np.arange(PIECE), counts) for piece, counts in sums.items()])


def _summed(coded: DataFrame, size: int, sent: Broadcast, work_of: Callable) -> tuple[tuple[np.ndarray, ...], float]:
    """Counts (start, moves, emissions) over all texts and their log10 likelihood, by the work that `work_of`
    makes of the broadcast value: tasks send theirs in pieces, which are summed where they meet. The driver
    gets one row a piece, HEAD + CLASSES symbols at most, and that of starts and moves."""
    found = _told(coded, size, sent, work_of).repartition("piece").mapInArrow(_add, PIECES).toArrow()
    emit, rest = np.zeros((-(-size // PIECE) * PIECE, STATES)), np.zeros((PIECE, STATES))
    for piece, counts in zip(found.column("piece").to_pylist(), found.column("counts").to_pylist()):
        values = np.frombuffer(counts, "<f8").reshape(-1, STATES)
        if piece < 0:
            rest = values
        else:
            emit[piece * PIECE : (piece + 1) * PIECE] = values
    return (rest[0], rest[1 : 1 + STATES], emit[:size]), float(rest[1 + STATES, 0])


def encoded(rows: DataFrame, symbols: Symbols) -> DataFrame:
    """`_ids`, the symbols of each text of the column `_text`, one after another in the bytes that `_kind` gives."""
    sent = rows.sparkSession.sparkContext.broadcast(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _kind(sent.value.size)
        for batch in batches:
            for part in _texts(batch, 0):
                ids, begins, _ = sent.value.encode_all(part.column(0))
                values = [t.tobytes() for t in np.split(ids.astype(kind), begins[1:-1])]
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["_ids"])

    return rows.select(F.col("_text").cast("binary")).mapInArrow(run, "_ids binary")


def counted(rows: DataFrame) -> DataFrame:
    """`word` and `c`, how often it occurs in the column `_text`, the end of each text included. Tasks count
    first; a word that is nearly everywhere sends a row per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.Table] = []
        for batch in batches:
            for part in _texts(batch, 0):
                each = pc.value_counts(_tokens(part.column(0)).flatten())
                found.append(pa.Table.from_arrays(each.flatten(), names=["word", "n"]))
                if sum(t.num_rows for t in found) > DISTINCT:
                    found = [_merged(found)]
                    if found[0].num_rows > DISTINCT // 2:
                        yield from found.pop().to_batches()
        if found:
            yield from _merged(found).to_batches()

    each = rows.select(F.col("_text").cast("binary")).mapInArrow(run, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("c"))


def _merged(found: list[pa.Table]) -> pa.Table:
    if len(found) == 1:
        return found[0]
    sums = pa.concat_tables(found).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return sums.select(["word", "n_sum"]).rename_columns(["word", "n"])


def _rare_of(rare: pa.Array, text: np.ndarray, texts: int) -> pa.ListArray:
    """For each text its words of `rare` and how often it has them; `text` tells whose each word is."""
    table = pa.table({"text": text, "word": rare}).group_by(["text", "word"], use_threads=False).aggregate([([], "count_all")])
    whose = table.column("text").to_numpy()
    order = np.argsort(whose, kind="stable")  # the groups come in no order
    pairs = pa.StructArray.from_arrays(
        [table.column(c).combine_chunks().take(pa.array(order)) for c in ("word", "count_all")], names=["word", "n"]
    )
    ends = np.cumsum(np.bincount(whose, minlength=texts))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pairs)


def begun(coded: DataFrame, unigram: np.ndarray) -> Model:
    """The model that training starts from: a mixture of unigrams over all texts, with moves that stay."""
    context = coded.sparkSession.sparkContext
    log, weights = None, None
    for _ in range(CLUSTER_ROUNDS):
        sent = context.broadcast((log, weights))
        (start, _, emit), _ = _summed(coded, len(unigram), sent, lambda value: _mixture(*value))
        log = np.ascontiguousarray(np.log((emit + SMOOTH * unigram[:, None]) / (emit.sum(axis=0) + SMOOTH)).T)
        weights = np.log((start + 1) / (start + 1).sum())
    move = np.full((STATES, STATES), 1.0) + np.eye(STATES) * 50 * STATES
    return Model.from_counts(start, move, emit, unigram)


def trained(coded: DataFrame, model: Model, unigram: np.ndarray, total: int) -> tuple[Model, list[float]]:
    """The model after Baum-Welch rounds over all texts, and the log10 likelihood of a token before each
    round: rounds end when it has grown by less than ENOUGH."""
    context = coded.sparkSession.sparkContext
    likely: list[float] = []
    while len(likely) < 2 or likely[-1] - likely[-2] >= ENOUGH:
        counts, found = _summed(coded, len(unigram), context.broadcast(model), lambda model: model.expected)
        likely.append(found / max(total, 1))
        model = Model.from_counts(*counts, unigram)
    return model, likely


def score(train: DataFrame, df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, n_tokens, n_known, train_tokens, base_score (unigram) and score (the model), log10, for every
    row of `df`, the model being learned from `train`.

    Tokens are words, A-Z in lower case, and one end for each text; null texts are their end only. Repeated
    rows are scored each. Without training texts all words are unknown. Other columns are not looked at. A text's
    symbols are held whole, four bytes a word; what the recursions keep of it is bounded.
    """
    spark = df.sparkSession
    rows = train.select(F.col(text).alias("_text"))
    counts = kept(counted(rows), "counts")
    # few distinct counts, and of the words only those that occur often enough for the head come to the driver
    often = counts.groupBy("c").agg(F.count(F.lit(1)).alias("v")).orderBy(F.desc("c")).toArrow().to_pydict()
    total, distinct = sum(c * v for c, v in zip(often["c"], often["v"])), sum(often["v"])
    enough = next((c for c, v in zip(often["c"], itertools.accumulate(often["v"])) if v >= HEAD), 0)
    top = counts.filter((F.col("c") >= enough) | (F.col("word") == END))
    top = top.orderBy((F.col("word") == END).desc(), F.col("c").desc(), "word").limit(HEAD).collect()
    head = [r[0] for r in top] or [""]
    symbols = Symbols(head)
    least = (top[-1]["c"], top[-1]["word"]) if top else (0, "")
    # the head is a prefix of this order, so what is not in it follows its last word
    rare = counts.filter(
        (F.col("word") != "") & ((F.col("c") < least[0]) | ((F.col("c") == least[0]) & (F.col("word") > least[1])))
    )
    by_class = rare.groupBy(_class(F.col("word")).alias("g")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_class:
        class_n[r["g"]], class_v[r["g"]] = r["n"], r["v"]
    head_c = np.array([r["c"] for r in top] or [0], float)
    unigram = np.concatenate([head_c, class_n]) + 0.5
    unigram /= unigram.sum()

    coded = kept(encoded(rows, symbols), "coded")
    model, _ = trained(coded, begun(coded, unigram), unigram, total)

    floor = float(np.log10(total + 0.5 * (distinct + 1)))
    # of each symbol: its base, and how likely a word is within its class as far as it goes without its own count
    base = np.concatenate([np.log10(head_c + 0.5) - floor, np.zeros(CLASSES)])
    inside = np.concatenate([np.zeros(len(head_c)), np.log10(class_n + 0.5 * (class_v + 1))])
    sent = spark.sparkContext.broadcast((symbols, model, base, inside))
    names = ["_key", "_row", "n_tokens", "_head", "_base", "_log", "_rare"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, model, base, inside = sent.value
        for batch in batches:
            for part in _texts(batch, 1):
                ids, begins, rare = symbols.encode_all(part.column(1))
                first, n = begins[:-1], np.diff(begins)
                classed = ids >= symbols.size - CLASSES
                likely = model.score(np.split(ids, begins[1:-1])) - np.add.reduceat(inside[ids], first)
                columns = [
                    pa.array(n, pa.int64()),
                    pa.array(n - np.add.reduceat(classed, first, dtype=np.int64), pa.int64()),
                    pa.array(np.add.reduceat(base[ids], first)),
                    pa.array(likely),
                    _rare_of(rare, np.repeat(np.arange(len(n)), n)[classed], len(n)),
                ]
                yield pa.RecordBatch.from_arrays([part.column(2), part.column(0), *columns], names=names)

    kind = df.schema[key].dataType.simpleString()
    given = df.select(F.monotonically_increasing_id().alias("_row"), F.col(text).cast("binary").alias("_text"), F.col(key).alias("_key"))
    schema = (
        f"_key {kind}, _row bigint, n_tokens bigint, _head bigint, _base double, _log double, "
        "_rare array<struct<word:string,n:bigint>>"
    )
    scored = kept(given.mapInArrow(work, schema), "scored")
    # the likelihood of a rare word within its class, and its base, follow from its count
    listed = scored.select("_row", F.explode("_rare").alias("_r")).select("_row", "_r.word", "_r.n")
    log = F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("_more")
    joined = listed.join(rare.select("word", "c"), "word", "left").groupBy("_row").agg(
        log, F.sum("n").alias("_n"), F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("_known")
    )
    known_head = F.col("_head") if top else F.lit(0)
    more = F.coalesce("_more", F.lit(0.0))
    return scored.drop("_rare").join(joined, "_row", "left").select(
        F.col("_key").alias(key),
        "n_tokens",
        (known_head + F.coalesce("_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("_base") + more - F.coalesce("_n", F.lit(0)) * floor).alias("base_score"),
        (F.col("_log") + more).alias("score"),
    )


def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = part_of(F.col("doc_id")) == 1
    found = score(docs.filter(~held), docs)
    return found.select("doc_id", held.alias("held_out"), *found.columns[1:])
