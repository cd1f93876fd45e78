"""Ranked lexical search over posting lists that are cut into blocks of similar documents.

A document is kept as its vector: the query terms it holds, with an impact each, so that its score for a query
is the sum of the impacts of the query's terms. Documents are placed by random hyperplanes (the side of each
that their vector lies on), and the posting list of a term is cut into blocks of documents on the same
sides: the more documents it lists, the more hyperplanes. A block stores the maximum of every coordinate that
a query with that term may ask for; the sum of a query's maxima bounds the score of each of its documents.

Search goes in three steps, each exact:
1. Every term names its documents of the highest impact. Scored in full, they give each query a floor: the
   score of its tenth best so far.
2. Terms of a query whose greatest impacts together stay below the floor need no list: a document that holds
   no other term cannot reach it. The other lists are gone through by blocks, and a block is skipped if its
   bound lies below the floor.
3. Documents of the blocks that are left are scored in full, and the best are kept.
No candidate is dropped for any other reason.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.common import kept, read

TOP = 10
PAIRS = 200_000  # (query, term) pairs that are searched for together; a task holds them in memory
BLOCK = 8  # documents a block should have
PLANES = 24  # hyperplanes at most
CELLS = 1 << 22  # numbers a task holds as a matrix

_BREAKS = bytes(
    c + 32 if ord("A") <= c <= ord("Z") else c if c >= 0x80 or chr(c).isalnum() else ord(" ") for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats: what is left between ASCII characters that are neither letters
    nor digits, only A to Z lower-cased."""
    return (text or "").encode().translate(_BREAKS).split()


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """_q and term, once each; rows of one key count as one query."""
    schema = T.StructType([T.StructField("_q", queries.schema[key].dataType), T.StructField("term", T.BinaryType())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t.as_py()))) for t in batch.column("text")]
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            listed = pa.array([t for x in found for t in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_q").take(pa.array(at)), listed], names=["_q", "term"])

    plain = queries.select(F.col(key).alias("_q"), F.col(text).alias("text"))
    return plain.mapInArrow(split, schema).distinct()


class Queries:
    """The queries that are searched for together; queries and terms are numbered."""

    def __init__(self, pairs: list):
        by_key = defaultdict(list)
        for key, term in pairs:
            by_key[key].append(bytes(term))
        self.keys = sorted(by_key, key=lambda k: (k is None, k))
        self.number = {t: i for i, t in enumerate(sorted({t for listed in by_key.values() for t in listed}))}
        self.terms = [np.array(sorted(self.number[t] for t in by_key[k])) for k in self.keys]
        self.of: list[list[int]] = [[] for _ in self.number]  # queries of a term
        for q, listed in enumerate(self.terms):
            for t in listed:
                self.of[t].append(q)


VECTOR = "held array<int>, {} array<bigint>"


def _fields(ddl: str) -> list[T.StructField]:
    return list(T.StructType.fromDDL(ddl))


def vectors(docs: DataFrame, queries, key: str, text: str) -> DataFrame:
    """_key, n, held and tf for each document with a term: how many terms, and which of the queries'."""
    schema = T.StructType(
        [T.StructField("_key", docs.schema[key].dataType), T.StructField("n", T.LongType()), *_fields(VECTOR.format("tf"))]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = queries.value.number
        for batch in batches:
            rows, n, held, tf = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                listed = terms(text.as_py())
                if listed:
                    some = Counter([number[t] for t in listed if t in number])
                    rows.append(i)
                    n.append(len(listed))
                    held.append(list(some))
                    tf.append(list(some.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key").take(pa.array(rows, pa.int64())),
                    pa.array(n, pa.int64()),
                    pa.array(held, pa.list_(pa.int32())),
                    pa.array(tf, pa.list_(pa.int64())),
                ],
                names=schema.fieldNames(),
            )

    plain = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    return plain.mapInArrow(count, schema)


def _flat(batch: pa.RecordBatch, values: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and value of each entry of the vectors in a batch."""
    held, listed = batch.column("held"), batch.column(values)
    sizes = np.diff(held.offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), sizes)
    return row, held.flatten().to_numpy().astype(np.int64), listed.flatten().to_numpy(zero_copy_only=False)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(w: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    """What each entry adds to a score, in 64-bit integers."""
    m = 100 - 90 + 90 * n * documents // tokens
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def depth(df: int) -> int:
    """Hyperplanes that cut the list of a term held by so many documents."""
    return min(PLANES, max(0, math.ceil(math.log2(max(df, 1) / BLOCK))))


def _weighed(found: DataFrame, weights: np.ndarray, documents: int, tokens: int) -> DataFrame:
    """_d, _key, code (sides of the hyperplanes), held and impacts, in the order of the code: documents that
    are alike meet in a file, also where very many are the same."""
    schema = T.StructType(
        [found.schema["_d"], found.schema["_key"], *_fields("code int, " + VECTOR.format("impacts"))]
    )
    sides = np.random.default_rng(13).integers(0, 2, (len(weights), PLANES)) * 2.0 - 1  # which way a term pulls
    shared = found.sparkSession.sparkContext.broadcast((weights, sides))
    bits = 1 << np.arange(PLANES - 1, -1, -1)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sides = shared.value
        for whole in batches:
            for batch in _portions(whole, CELLS // PLANES):
                row, term, tf = _flat(batch, "tf")
                found = impacts(weights[term], tf, batch.column("n").to_numpy()[row], documents, tokens)
                pulled = np.zeros((batch.num_rows, PLANES))
                first = np.flatnonzero(np.diff(row, prepend=-1))
                pulled[row[first]] = np.add.reduceat(sides[term] * found[:, None], first)
                held = batch.column("held")
                ends = held.offsets.to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_d"),
                        batch.column("_key"),
                        pa.array(((pulled > 0) @ bits).astype("i4")),
                        held,
                        pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(found)),
                    ],
                    names=schema.fieldNames(),
                )

    out = found.filter(F.size("held") > 0).mapInArrow(weigh, schema)
    return out.repartitionByRange("code", "_d").sortWithinPartitions("code", "_d")


def _portions(batch: pa.RecordBatch, entries: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose vectors have so many entries together, or one row."""
    ends, at = batch.column("held").offsets.to_numpy().astype(np.int64), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + entries, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _dense(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Some rows at a time: the rows, row and term of their entries, and their impacts as a matrix."""
    rows = max(1, CELLS // width)
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            row, term, value = _flat(batch, "impacts")
            table = np.zeros((batch.num_rows, width), np.int64)
            table[row, term] = value
            yield batch, row, term, table


def _champions(weighed: DataFrame) -> DataFrame:
    """term, impact, _d of the TOP documents of highest impact of each term."""
    schema = T.StructType.fromDDL("term int, impact bigint, _d bigint")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        term, value, doc = (np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            row, t, v = _flat(batch, "impacts")
            term, value = np.concatenate([term, t]), np.concatenate([value, v])
            doc = np.concatenate([doc, batch.column("_d").to_numpy()[row]])
            order = np.lexsort((doc, -value, term))
            term, value, doc = term[order], value[order], doc[order]
            starts = np.flatnonzero(np.diff(term, prepend=-1))
            place = np.arange(len(term)) - np.repeat(starts, np.diff([*starts, len(term)]))
            term, value, doc = (x[place < TOP] for x in (term, value, doc))
        columns = [pa.array(term.astype("i4")), pa.array(value), pa.array(doc)]
        yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    order = W.partitionBy("term").orderBy(F.desc("impact"), "_d")
    found = weighed.select("_d", "held", "impacts").mapInArrow(best, schema)
    return found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= TOP).drop("_r")


class _Falling:
    """Keys in falling order, null first, so that a heap gives up high keys first."""

    __slots__ = ("key",)

    def __init__(self, key):
        self.key = key

    def __eq__(self, other):
        return self.key == other.key

    def __lt__(self, other):
        if self.key is None or other.key is None:
            return self.key is None and other.key is not None
        return self.key > other.key


def _scored(chosen: DataFrame, queries) -> DataFrame:
    """_i (number of the query), _d, _key, score: the best TOP of each task for each query, by score above 0
    and then by key, nulls last. `chosen` has `_qs`, the queries to score a document for."""
    schema = T.StructType([*_fields("_i int, _d bigint, score bigint"), chosen.schema["_key"]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, heaps = queries.value, defaultdict(list)
        for batch, _, _, table in _dense(batches, len(asked.number)):
            listed = batch.column("_qs")
            row = np.repeat(np.arange(batch.num_rows), np.diff(listed.offsets.to_numpy()))
            pairs = np.unique(np.stack([listed.flatten().to_numpy(), row]), axis=1)
            starts = np.flatnonzero(np.diff(pairs[0], prepend=-1))
            keys, docs = batch.column("_key"), batch.column("_d").to_numpy()
            for q, rows in zip(pairs[0][starts], np.split(pairs[1], starts[1:])):
                total, heap = table[np.ix_(rows, asked.terms[q])].sum(axis=1), heaps[q]
                for i in np.argsort(-total, kind="stable"):
                    s = int(total[i])
                    if s <= 0 or len(heap) == TOP and s < heap[0][0]:
                        break
                    entry = (s, _Falling(keys[int(rows[i])].as_py()), -int(docs[rows[i]]))
                    if len(heap) < TOP:
                        heapq.heappush(heap, entry)
                    elif heap[0] < entry:
                        heapq.heapreplace(heap, entry)
        out = [(q, -d, s, k.key) for q, heap in heaps.items() for s, k, d in heap]
        columns = list(zip(*out)) if out else [()] * 4
        kinds = [pa.int32(), pa.int64(), pa.int64(), _arrow(schema["_key"])]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.fieldNames())

    return chosen.select("_d", "_key", "held", "impacts", "_qs").mapInArrow(score, schema)


def _arrow(field: T.StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def _ranked(scored: DataFrame) -> DataFrame:
    order = W.partitionBy("_i").orderBy(F.desc("score"), F.asc_nulls_last("_key"), "_d")
    return scored.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= TOP)


class Plan:
    """What search goes by: the floors of the queries, which queries go through the list of a term, and at how
    many hyperplanes the list is cut. A block is a term and the sides its documents lie on, as one number."""

    def __init__(self, queries: Queries, floors: list[int], greatest: np.ndarray, df: np.ndarray):
        self.floors = floors
        lists = defaultdict(list)
        for q, listed in enumerate(queries.terms):
            reach = 0
            for t in sorted(listed[greatest[listed] > 0].tolist(), key=lambda t: (greatest[t], t)):
                reach += int(greatest[t])
                if reach >= floors[q]:
                    lists[t].append(q)
        self.lists = dict(lists)
        self.cut = np.full(len(df), -1)
        for t in lists:
            self.cut[t] = depth(int(df[t]))

    def blocks(self, term: np.ndarray, code: np.ndarray) -> np.ndarray:
        return (term << PLANES) | (code >> (PLANES - self.cut[term]))

    def mates(self, queries: Queries, term: int) -> np.ndarray:
        """The coordinates that a query with this list may ask for."""
        return np.unique(np.concatenate([queries.terms[q] for q in self.lists[term]]))


def _maxima(weighed: DataFrame, queries, plan) -> DataFrame:
    """block, others, most: the summary of each block, its coordinates above 0."""
    schema = T.StructType.fromDDL("block bigint, other int, most bigint")

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, by = queries.value, plan.value
        mates: dict[int, np.ndarray] = {}
        for batch, row, term, table in _dense(batches, len(asked.number)):
            listed = by.cut[term] >= 0
            row, term = row[listed], term[listed]
            if not len(row):
                continue
            block = by.blocks(term, batch.column("code").to_numpy().astype(np.int64)[row])
            order = np.argsort(block, kind="stable")
            block, row = block[order], row[order]
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            found = []
            for at, rows in zip(block[starts].tolist(), np.split(row, starts[1:])):
                t = at >> PLANES
                if t not in mates:
                    mates = {} if sum(map(len, mates.values())) > CELLS else mates
                    mates[t] = by.mates(asked, t)
                most = table[np.ix_(rows, mates[t])].max(axis=0)
                there = np.flatnonzero(most)
                found.append((np.full(len(there), at), mates[t][there], most[there]))
            columns = [np.concatenate(c) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0]), pa.array(columns[1].astype("i4")), pa.array(columns[2])], names=schema.fieldNames()
            )

    found = weighed.select("code", "held", "impacts").mapInArrow(sum_up, schema)
    # one shuffle by block serves both groupings
    most = found.repartition("block").groupBy("block", "other").agg(F.max("most").alias("most"))
    return most.groupBy("block").agg(F.collect_list("other").alias("others"), F.collect_list("most").alias("most"))


def _open_blocks(maxima: DataFrame, queries, plan) -> DataFrame:
    """block and _qs: the queries for which the bound of the block does not lie below the floor."""
    schema = T.StructType.fromDDL("block bigint, _qs array<int>")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, by = queries.value, plan.value
        dense = np.zeros(len(asked.number), np.int64)
        for batch in batches:
            blocks, left = [], []
            for block, others, most in zip(*(batch.column(c) for c in ("block", "others", "most"))):
                at, others = block.as_py(), others.values.to_numpy()
                dense[others] = most.values.to_numpy()
                some = [q for q in by.lists[at >> PLANES] if dense[asked.terms[q]].sum() >= by.floors[q]]
                dense[others] = 0
                if some:
                    blocks.append(at)
                    left.append(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(left, pa.list_(pa.int32()))], names=schema.fieldNames()
            )

    return maxima.mapInArrow(ask, schema)


def _members(weighed: DataFrame, plan) -> DataFrame:
    """block, _d for the lists that are gone through."""
    schema = T.StructType.fromDDL("block bigint, _d bigint")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = plan.value
        for whole in batches:
            for batch in _portions(whole, CELLS):
                row, term, _ = _flat(batch, "impacts")
                listed = by.cut[term] >= 0
                row, term = row[listed], term[listed]
                block = by.blocks(term, batch.column("code").to_numpy().astype(np.int64)[row])
                doc = batch.column("_d").to_numpy()[row]
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(doc)], names=schema.fieldNames())

    return weighed.select("_d", "code", "held", "impacts").mapInArrow(place, schema)


def search_together(docs: DataFrame, pairs: list, kind: T.DataType, key: str, text: str,
                    seen: Callable | None = None) -> DataFrame:
    """_q, rank, _key, score for queries given as (key, term) pairs, which have to fit into memory."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    queries = Queries(pairs)
    asked = share(queries)
    found = vectors(docs, asked, key, text).withColumn("_d", F.monotonically_increasing_id())
    found = kept(found, "vectors")
    documents, tokens = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(queries.number), np.int64)
    for r in found.select(F.explode("held").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
        df[r["t"]] = r["n"]  # a row for each of the queries' terms
    weights = np.array([weight(documents, n) for n in df.tolist()])
    weighed = kept(_weighed(found, weights, documents, max(tokens, 1)), "weighed")

    # 1. floors; at most TOP documents for each of the queries' terms
    greatest = np.zeros(len(df), np.int64)
    chosen = defaultdict(set)
    for r in _champions(weighed).collect():
        greatest[r["term"]] = max(greatest[r["term"]], r["impact"])
        chosen[r["_d"]].update(queries.of[r["term"]])
    seeds = spark.createDataFrame([(d, sorted(q)) for d, q in chosen.items()], "_d bigint, _qs array<int>")
    best = _ranked(_scored(weighed.join(F.broadcast(seeds), "_d"), asked))
    floors = [0] * len(queries.keys)
    for r in best.filter(F.col("rank") == TOP).collect():  # a row per query
        floors[r["_i"]] = r["score"]

    # 2. lists and blocks
    made = Plan(queries, floors, greatest, df)
    plan = share(made)
    left = _open_blocks(_maxima(weighed, asked, plan), asked, plan)
    if seen:
        left = kept(left, "blocks")
        seen(queries, made, weighed, left)
    candidates = _members(weighed, plan).join(left, "block")

    # 3. scores; what a document is scored for comes as one list, bounded by the queries searched for together
    wanted = candidates.groupBy("_d").agg(F.array_distinct(F.flatten(F.collect_set("_qs"))).alias("_qs"))
    ranked = _ranked(_scored(weighed.join(wanted, "_d"), asked))
    names = spark.createDataFrame(
        [(i, k) for i, k in enumerate(queries.keys)],
        T.StructType([T.StructField("_i", T.IntegerType()), T.StructField("_q", kind)]),
    )
    return ranked.join(F.broadcast(names), "_i").select("_q", "rank", "_key", "score")


def search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", query: str = "item_id",
           query_text: str = "text", pairs: int = PAIRS, seen: Callable | None = None) -> DataFrame:
    """`query`, rank, `key`, score: each query's TOP documents by score above 0, equal scores by ascending key.

    Queries are taken in groups of about `pairs` (query, term) pairs, chosen by hash, with a pass over the
    documents each: what tasks hold in memory is bounded whatever the number of queries (one query is never
    parted). Null texts have no terms; documents and queries without terms are in no result. Rows of one query
    key count as one query; repeated rows and null keys of documents rank as rows of their own (null last among
    equal scores). Either table may be empty. Extra columns are not read.
    """
    spark = docs.sparkSession
    asked = kept(query_terms(queries, query, query_text), "queries")
    groups = max(1, math.ceil(asked.count() / pairs))
    group = F.pmod(F.xxhash64("_q"), F.lit(groups))
    schema = T.StructType(
        [
            T.StructField("_q", queries.schema[query].dataType),
            T.StructField("rank", T.IntegerType()),
            T.StructField("_key", docs.schema[key].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    whole = spark.createDataFrame([], schema)
    for i in range(groups):
        some = [(r["_q"], r["term"]) for r in asked.filter(group == i).collect()]
        if some:
            part = search_together(docs, some, asked.schema["_q"].dataType, key, text, seen)
            whole = whole.unionByName(part if groups == 1 else kept(part, "found"))
    return whole.select(F.col("_q").alias(query), "rank", F.col("_key").alias(key), "score")


def op13_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH words AS (
    SELECT rowid AS d, doc_id,
        regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS held
    FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
), sized AS (SELECT d, doc_id, len(held) AS n, held FROM words WHERE len(held) > 0
), whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS tokens FROM sized
), counts AS (
    SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, n, unnest(held) AS term FROM sized)
    GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, whole GROUP BY term
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, d, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // tokens))))::BIGINT AS score
    FROM asked JOIN counts USING (term) JOIN weights USING (term), whole
    GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, doc_id, score,
        row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, d)::INTEGER AS rank
    FROM scored WHERE score > 0)
WHERE rank <= 10
"""
