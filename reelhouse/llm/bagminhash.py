"""Near-duplicates by weighted Jaccard similarity of word shingles, found with BagMinHash signatures.

The weight axis of a shingle that occurs c times is cut into [0, 1), [1, 2), [2, 4), [4, 8), ...; each piece
has a Poisson process of its own, drawn from a hash of shingle and piece, and a point counts where its place
on the axis lies below c. A point also names one component of the signature, which keeps its earliest
point. Two texts agree in a component with probability sum(min) / sum(max) of their counts. Only points up to
a horizon are drawn, which is moved out until all components are filled.

Bands of the signature bring candidates together. In a bucket, texts are compared to one leader, not with
each other; those not joined by that meet other leaders in further rounds. In buckets that are then still
apart, every text meets every other, block by block, but only in a longer signature of one byte a component;
what comes near the limit there is compared in full, unless links found in the same piece of work join the two
already. Such a piece hands on the links that join its texts and no others, fewer than it has texts. So no two texts
that belong together are kept apart, and a bucket of copies costs about as many comparisons as it has texts.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.llm.bpe import Memo
from reelhouse.llm.common import kept, map_rows, read, stage
from reelhouse.llm.components import components

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 25, 5  # a pair at 0.8 shares no band with a chance of 5e-5
LEADERS = 3  # rounds of comparisons with one leader
SKETCH = 512  # components of the longer signature
NEAR = 0.72  # of them that a pair at 0.8 has in common but for a chance of 1e-5
BLOCK = 256  # texts of a bucket that meet as many others in one piece of work
BLOCK_BYTES = 16 << 20  # of shingles that these have together; longer texts meet in smaller blocks
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective hash of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def word_hashes() -> Memo:
    return Memo(lambda w: xxhash.xxh64_intdigest(w), 200_000)


def shingles(text: str, memo: Memo, size: int = WORDS) -> np.ndarray:
    """Hashes of all runs of `size` words in lower case; a shorter text is one shingle, none has no word."""
    words = WORD.findall(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = mix(out * _A + h[i : len(h) - size + 1 + i])
    return out


def signature(found: np.ndarray, components_: int = BANDS * ROWS) -> np.ndarray:
    """The earliest point of each component, for a bag of hashes."""
    element, count = np.unique(found, return_counts=True)
    # pieces of the weight axis: number, start and length of each that lies below the count
    keys, rates, starts, limits = [element], [np.ones(len(element))], [np.zeros(len(element))], [count]
    k, low = 1, 1
    while (more := count > low).any():
        keys.append(mix(element[more] + np.uint64(k * int(_A) & 2**64 - 1)))
        n = int(more.sum())
        rates.append(np.full(n, float(low)))
        starts.append(np.full(n, float(low)))
        limits.append(count[more])
        k, low = k + 1, low * 2
    key, rate, start = np.concatenate(keys), np.concatenate(rates), np.concatenate(starts)
    limit = np.concatenate(limits).astype(np.float64)
    horizon = components_ / float(count.sum()) * math.log(components_ / 0.05)
    while True:
        first = np.full(components_, np.inf)
        draws = int(horizon + 2 * math.sqrt(horizon)) + 2  # points drawn at once for each piece
        live, time, drawn = np.arange(len(key)), np.zeros(len(key)), 0
        while len(live):
            steps = mix(np.arange(drawn, drawn + draws, dtype=np.uint64) * _A + _B)
            state = mix(key[live, None] + steps)
            times = time[:, None] + np.cumsum(-np.log(_unit(state)) / rate[live, None], axis=1)
            near = times <= horizon
            state, soon, row = state[near], times[near], live[np.nonzero(near)[0]]
            place = mix(state + _C)
            hit = start[row] + rate[row] * _unit(place) < limit[row]
            at = (mix(place[hit] + _A) >> np.uint64(8)) % np.uint64(components_)
            np.minimum.at(first, at.astype(np.int64), soon[hit])
            more = near[:, -1]
            live, time, drawn = live[more], times[more, -1], drawn + draws
        if np.isfinite(first).all():
            return first
        horizon *= 2


def bands(first: np.ndarray) -> list[int]:
    bits = first.view(np.uint64).reshape(BANDS, ROWS)
    out = mix(np.arange(BANDS, dtype=np.uint64) + _C)
    for i in range(ROWS):
        out = mix(out * _A + bits[:, i])
    return out.view(np.int64).tolist()


def sketch(found: np.ndarray) -> bytes:
    return mix(signature(found, SKETCH).view(np.uint64)).astype(np.uint8).tobytes()


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """sum(min) / sum(max) of the counts of two bags."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = int(np.minimum(n[i], m[j]).sum())
    total = len(a) + len(b) - shared
    return shared / total if total else 0.0


def _with_bands(df: DataFrame) -> DataFrame:
    """`_id`, `node`, `bands` of rows `_id`, `node`, `_text`; texts without words have no bands."""

    def start():
        memo = word_hashes()

        def work(rows: dict[str, list]) -> dict[str, list]:
            out = []
            for text in rows["_text"]:
                found = shingles(text, memo)
                out.append(bands(signature(found)) if len(found) else [])
            return {"_id": rows["_id"], "node": rows["node"], "bands": out}

        return work

    return map_rows(df, start, "_id bigint, node bigint, bands array<bigint>")


def _with_shingles(df: DataFrame) -> DataFrame:
    def start():
        memo = word_hashes()

        def work(rows: dict[str, list]) -> dict[str, list]:
            found = [shingles(text, memo) for text in rows["_text"]]
            return {
                "node": rows["node"],
                "bag": [x.tobytes() for x in found],
                "sketch": [sketch(x) for x in found],
            }

        return work

    return map_rows(df.select("node", "_text"), start, "node bigint, bag binary, sketch binary")


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """`a`, `b`, `similar` of distinct pairs of nodes."""
    both = pairs.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("_x")), "a").join(
        bags.select(F.col("node").alias("b"), F.col("bag").alias("_y")), "b"
    )

    def start():
        def work(rows: dict[str, list]) -> dict[str, list]:
            similar = [
                overlap(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                for x, y in zip(rows["_x"], rows["_y"])
            ]
            return {"a": rows["a"], "b": rows["b"], "similar": similar}

        return work

    return map_rows(both, start, "a bigint, b bigint, similar double")


def _members(nodes: DataFrame) -> DataFrame:
    """`bucket`, `node` of the buckets that hold several texts."""
    every = nodes.select(F.explode("bands").alias("bucket"), "node")
    several = every.groupBy("bucket").agg(F.min("node").alias("_x"), F.max("node").alias("_y"))
    return every.join(several.filter("_x <> _y").select("bucket"), "bucket").distinct()


def links(nodes: DataFrame, texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """`a`, `b`: links that join the texts which are `similar` or can be reached over such links.

    `nodes` (node, _id, bands) are distinct texts, `texts` (_id, node, _text) may repeat them.
    """
    spark = nodes.sparkSession
    members = kept(_members(nodes), "buckets")
    wanted = members.select("node").distinct().join(nodes.select("node", "_id"), "node")
    bags = kept(
        _with_shingles(texts.join(wanted, ["_id", "node"]).dropDuplicates(["node"])), "bags"
    )
    tested = spark.createDataFrame([], "a bigint, b bigint, similar double")
    labels = spark.createDataFrame([], "node bigint, label bigint")
    for turn in range(LEADERS + 1):
        labelled = members.join(labels, "node", "left").select(
            "bucket", "node", F.coalesce("label", "node").alias("label")
        )
        lead = F.min(F.struct(F.xxhash64("node", "bucket", F.lit(turn)).alias("h"), "node", "label"))
        apart = (
            labelled.groupBy("bucket")
            .agg(
                F.min("label").alias("_x"), F.max("label").alias("_y"),
                lead.alias("_lead"), F.count(F.lit(1)).alias("n"),
            )
            .filter("_x <> _y")
        )
        here = labelled.join(apart.select("bucket", "n", "_lead.node", "_lead.label").toDF("bucket", "n", "lead", "_l"), "bucket")
        if turn < LEADERS:
            found = here.filter("label <> _l").select(
                F.greatest("node", "lead").alias("a"), F.least("node", "lead").alias("b")
            )
        else:
            joined = kept(_near(here.select("bucket", "node", "label", "n"), bags, similar), "verified")
            tested = tested.unionByName(joined)
            continue
        pairs = kept(found.distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        tested = tested.unionByName(kept(_verified(pairs, bags), "verified"))
        labels = components(tested.filter(F.col("similar") >= similar).select("a", "b"))
    return tested.filter(F.col("similar") >= similar).select("a", "b")


class _Joined:
    """Which labels belong together so far."""

    def __init__(self):
        self.of: dict[int, int] = {}

    def root(self, label: int) -> int:
        while (above := self.of.get(label, label)) != label:
            self.of[label] = label = self.of.get(above, above)
        return label

    def join(self, a: int, b: int) -> None:
        self.of[self.root(a)] = self.root(b)


def tile_links(left: list[dict], right: list[dict], similar: float) -> list[tuple[int, int, float]]:
    """Links (a, b, similarity) that join the texts of two blocks wherever links between them do; texts have
    `node`, `label`, `sketch`, `bag`. Only what is near by sketch and not yet joined is compared."""
    joined, out = _Joined(), []
    sketches = np.array([np.frombuffer(r["sketch"], np.uint8) for r in right])
    for r in left:
        near = (sketches == np.frombuffer(r["sketch"], np.uint8)).mean(axis=1) >= NEAR
        bag = np.frombuffer(r["bag"], np.uint64)
        for i in np.flatnonzero(near):
            other = right[i]
            if joined.root(r["label"]) == joined.root(other["label"]):
                continue
            found = overlap(bag, np.frombuffer(other["bag"], np.uint64))
            if found >= similar:
                joined.join(r["label"], other["label"])
                out.append((max(r["node"], other["node"]), min(r["node"], other["node"]), found))
    return out


def _near(members: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """`a`, `b`, `similar`: links that join the texts of one bucket (`bucket`, `n` texts, `node`, `label`) which are
    alike and have unlike labels; a spanning forest for each two blocks."""
    whole = kept(members.join(bags, "node"), "apart")
    sizes = whole.groupBy("bucket").agg(F.sum(F.octet_length("bag")).alias("_bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("_bytes") / BLOCK_BYTES)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    met = whole.join(sizes, "bucket").withColumn("_blocks", blocks).select(
        "bucket", "node", "label", "sketch", "bag", own.alias("_own"),
        F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_k"),
    )
    tiles = met.groupBy("bucket", F.least("_own", "_k").alias("_i"), F.greatest("_own", "_k").alias("_j")).agg(
        F.collect_list(F.struct("_own", "node", "label", "sketch", "bag")).alias("_rows")  # of two blocks
    )

    def run(batches):
        for batch in batches:
            out = []
            for at in range(batch.num_rows):  # a tile at a time
                [tile] = batch.slice(at, 1).to_pylist()
                left = [r for r in tile["_rows"] if r["_own"] == tile["_i"]]
                right = left if tile["_i"] == tile["_j"] else [r for r in tile["_rows"] if r["_own"] == tile["_j"]]
                if left and right:
                    out += tile_links(left, right, similar)
            a, b, found = zip(*out) if out else ((), (), ())
            columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "similar"])

    links = tiles.select("_i", "_j", "_rows").mapInArrow(run, "a bigint, b bigint, similar double")
    return links.groupBy("a", "b").agg(F.max("similar").alias("similar"))


_NONE = -(1 << 63)  # stands for a null key


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """`key`, `_node` (a hash of the text), `class_id` (least key of the class), `class_size`, `n_links` (found
    links of the text to other texts): one row for each row.

    Equal texts are one class, empty and null ones too; else texts are classed by the links between them.
    Texts of fewer than five words are one shingle. Null keys are classed like others and are never the
    class id unless a class has nothing else. Texts are told apart by a 64-bit hash.
    """
    rows = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NONE)).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("node"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    signed = kept(_with_bands(rows), "signatures")
    own = F.nullif(F.col("_id"), F.lit(_NONE))
    nodes = kept(
        signed.groupBy("node").agg(
            F.min("_id").alias("_id"), F.min(own).alias("_first"),
            F.count(F.lit(1)).alias("n"), F.any_value("bands").alias("bands"),
        ),
        "nodes",
    )
    found = links(nodes.select("node", "_id", "bands"), rows, similar)
    labels = components(found)
    degree = (
        found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    )
    placed = (
        nodes.select("node", "_first", "n")
        .join(labels, "node", "left")
        .join(degree, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    of_class = placed.groupBy("label").agg(F.min("_first").alias("class_id"), F.sum("n").alias("class_size"))
    named = placed.join(of_class, "label").select(
        "node", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return signed.select(own.alias(key), "node").join(named, "node").withColumnRenamed("node", "_node")


def op2_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read(spark, sf_dir, "documents")).drop("_node")


@stage
def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the least doc_id."""
    first = classes(docs).filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(
        F.coalesce("doc_id", F.lit(_NONE)).alias("_k"), "_node"
    ).distinct()
    keyed = docs.withColumns(
        {
            "_k": F.coalesce("doc_id", F.lit(_NONE)),
            "_node": F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )
    once = W.partitionBy("_k", "_node").orderBy(F.lit(0))
    return (
        keyed.join(first, ["_k", "_node"])
        .withColumn("_once", F.row_number().over(once))
        .filter("_once = 1")
        .select(*docs.columns)
    )
