"""Shards of near equal bytes: a k-d tree over metadata of the texts.

A node that is to give n shards is cut along its widest dimension at the weighted quantile n // 2 / n, and
so on until each leaf is one shard and holds the target bytes. A quantile is found by zooming: the rows
of all nodes of one depth are summed into bins, and the bin that holds the quantile is looked into more
closely, until what it weighs no longer matters. The driver sees bins only (a fixed number per node), and
a tree of shards - 1 cuts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.llm.common import SPACES, kept, read

SHARDS = 40
ROW_BYTES = 16
BINS = 512
TOLERANCE = 0.0025  # of a shard's bytes: a cut is not sought more finely, and groups this small stay whole
DIMENSIONS = ("_d0", "_d1", "_d2", "_d3")
KEYS = ("_k0", "_t1", "_t2")  # the dimension of a node's cut, and ties
ROWS_PER_BUCKET = 50_000


def metadata(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, text_crc32, and four dimensions that depend on the text alone, so that equal texts are
    one point: size, letters beyond ASCII, word length, lines (all but the second on a log scale)."""
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(body).cast("long")
    chars = F.length(body)
    lines = chars - F.length(F.translate(body, "\n", ""))
    blanks = chars - F.length(F.translate(body, SPACES, ""))
    crc = F.crc32(body.cast("binary"))
    return df.select(
        F.col(key).alias("_key"),
        (size + ROW_BYTES).alias("size"),
        crc.alias("text_crc32"),
        F.log2(size + 1.0).alias("_d0"),
        ((size - chars) / (size + 1.0)).alias("_d1"),
        F.log2((chars + 1.0) / (blanks + 1.0)).alias("_d2"),
        F.log2(lines + 1.0).alias("_d3"),
        # ties: first by text, then by key; doubles hold these integers exactly
        crc.cast("double").alias("_t1"),
        F.pmod(F.xxhash64(F.col(key), crc), F.lit(1 << 52)).cast("double").alias("_t2"),
    )


@dataclass
class Node:
    """`count` shards from `first` on; rows whose keys lie before `cut` go left."""

    first: int
    count: int
    weight: int = 0
    dimension: int = 0
    fixed: list[float] = field(default_factory=list)  # exact values of leading keys inside the zoom
    low: float = 0.0
    high: float = 0.0
    before: int = 0  # weight left of the zoom
    cut: list[float] | None = None

    @property
    def left_count(self) -> int:
        return self.count // 2

    @property
    def target(self) -> float:
        return self.weight * self.left_count / self.count


class Lookup:
    """Values of nodes as columns, picked by `_node`; a fixed number of literals whatever the rows."""

    def __init__(self, nodes: list[Node], shards: int):
        self.nodes, self.shards = {n.first: n for n in nodes}, shards

    def __call__(self, value, default: float) -> Column:
        listed = [value(self.nodes[i]) if i in self.nodes else default for i in range(self.shards)]
        return F.get(F.array(*[F.lit(v) for v in listed]), F.col("_node"))


def _keyed(rows: DataFrame, of: Lookup) -> DataFrame:
    """`_k0`: the value in the dimension along which the row's node is cut."""
    return rows.withColumn("_k0", F.get(F.array(*DIMENSIONS), of(lambda n: n.dimension, 0)))


def _halved(rows: DataFrame, of: Lookup) -> DataFrame:
    """Send the rows of the nodes on, by their keys in order."""
    cuts = [
        of(lambda n, i=i: n.cut[i] if i < len(n.cut) else -math.inf, math.inf) for i in range(len(KEYS))
    ]
    left = F.lit(False)
    for key, cut in reversed(list(zip(KEYS, cuts))):
        left = (F.col(key) < cut) | ((F.col(key) == cut) & left)
    return rows.withColumn(
        "_node", F.when(left, F.col("_node")).otherwise(F.col("_node") + of(lambda n: n.left_count, 0))
    ).drop("_k0")


def _bins(rows: DataFrame, active: list[Node], of: Lookup) -> list:
    depth = of(lambda n: len(n.fixed), 0)
    key = F.get(F.array(*KEYS), depth)
    low, high = of(lambda n: n.low, 0.0), of(lambda n: n.high, 0.0)
    inside = F.col("_node").isin([n.first for n in active]) & (key >= low) & (key <= high)
    for i, name in enumerate(KEYS[:-1]):
        same = F.col(name) == of(lambda n, i=i: n.fixed[i] if i < len(n.fixed) else 0.0, 0.0)
        inside &= (depth <= i) | same
    at = F.when(high > low, F.floor((key - low) / (high - low) * BINS)).otherwise(F.lit(0))
    return (
        rows.filter(inside)
        .withColumn("_bin", F.least(at, F.lit(BINS - 1)).cast("int"))
        .groupBy("_node", "_bin")
        .agg(
            F.sum("size").alias("w"),
            F.count(F.lit(1)).alias("n"),
            *[F.min(k).alias(f"low{i}") for i, k in enumerate(KEYS)],
            *[F.max(k).alias(f"high{i}") for i, k in enumerate(KEYS)],
        )
        .collect()  # at most BINS rows for each of at most `shards` nodes
    )


def _zoom(node: Node, bins: list, tolerance: float) -> None:
    """Look at the bins of a node: set its cut, or a closer range."""
    depth = len(node.fixed)
    reached = node.before
    bins = sorted(bins, key=lambda b: b["_bin"])
    for b in bins:
        if reached + b["w"] >= node.target or b is bins[-1]:
            break
        reached += b["w"]
    low, high = b[f"low{depth}"], b[f"high{depth}"]
    single = low == high
    last = depth == len(KEYS) - 1
    if b["w"] <= tolerance or b["n"] == 1 or (single and last):
        after = node.target - reached > reached + b["w"] - node.target  # the nearer side
        value = math.nextafter(high, math.inf) if after else low
        node.cut = [*node.fixed, value]
    elif single:
        node.fixed = [*node.fixed, low]
        node.low, node.high, node.before = b[f"low{depth + 1}"], b[f"high{depth + 1}"], reached
    else:
        node.low, node.high, node.before = low, high, reached


def _grow(rows: DataFrame, shards: int) -> DataFrame:
    """The rows with `_node`, their shard. Each depth of the tree is written and read again."""
    rows = rows.withColumn("_node", F.lit(0))
    nodes = [Node(0, shards)]
    spans: list[float] = []
    tolerance = 0.0
    while nodes := [n for n in nodes if n.count > 1]:
        rows = kept(rows, "shards")
        ends = rows.groupBy("_node").agg(
            F.sum("size").alias("w"),
            *[F.min(d).alias(f"low{i}") for i, d in enumerate(DIMENSIONS)],
            *[F.max(d).alias(f"high{i}") for i, d in enumerate(DIMENSIONS)],
        )
        found = {r["_node"]: r for r in ends.collect()}
        for n in nodes:
            r = found.get(n.first)
            if r is None:  # no rows: any cut will do
                n.cut = [0.0]
                continue
            width = [r[f"high{i}"] - r[f"low{i}"] for i in range(len(DIMENSIONS))]
            if not spans:
                spans = [w or 1.0 for w in width]
                tolerance = TOLERANCE * r["w"] / shards
            n.dimension = max(range(len(width)), key=lambda i: width[i] / spans[i])
            n.weight, n.low, n.high = r["w"], r[f"low{n.dimension}"], r[f"high{n.dimension}"]
        of = Lookup(nodes, shards)
        keyed = _keyed(rows, of)
        while active := [n for n in nodes if n.cut is None]:
            bins = _bins(keyed, active, of)
            for n in active:
                _zoom(n, [r for r in bins if r["_node"] == n.first], tolerance)
        rows = _halved(keyed, of)
        nodes = [
            half
            for n in nodes
            for half in (Node(n.first, n.left_count), Node(n.first + n.left_count, n.count - n.left_count))
        ]
    return kept(rows, "shards")


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Every row with its `size`, `text_crc32`, `shard` and `slot` (0, 1, ... without a gap in a shard).

    Sizes of shards are near equal: a cut misses its quantile by at most TOLERANCE of a shard, or by one
    row if that is larger. Equal texts share a shard unless a cut has to go through their group. Null texts
    count as empty; null keys and repeated rows get places of their own; an empty table stays empty.
    """
    rows = _grow(metadata(df, key, text), shards)
    placed = rows.select(
        F.col("_key"), "size", "text_crc32", F.col("_node").cast("int").alias("shard"), "_t2"
    )
    buckets = max(8, math.ceil(rows.count() / shards / ROWS_PER_BUCKET))
    placed = placed.withColumn("_bucket", F.pmod(F.col("_t2").cast("long"), F.lit(buckets)))
    offsets = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = offsets.select(
        "shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy("shard", "_bucket").orderBy("_key", "text_crc32", "size")
    numbered = placed.withColumn("_place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "_bucket"]).select(
        F.col("_key").alias(key),
        "size",
        "text_crc32",
        "shard",
        (F.col("_offset") + F.col("_place")).cast("long").alias("slot"),
    )


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
