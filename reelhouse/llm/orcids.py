"""Token ids in ORC files, one row for each document, in the order of the keys.

ORC writes the ids of a stripe as run-length encoded integers, and keeps minima and maxima of every column for
each group of rows and a Bloom filter on the keys. So stripes can be read side by side, and a search for some
documents or for a stretch of the token stream skips the stripes and row groups that cannot hold it.

A file knows the place of its documents' tokens in the file (`before`); where the files begin follows from
their totals, one number per file. Nothing else has to be counted over the whole corpus.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from reelhouse.llm.common import read
from reelhouse.session import shared_folder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END = 2  # the id after each document
STRIPE_BYTES = 64 << 20
INDEX_ROWS = 1_000  # rows of an index entry, and of a Bloom filter
FALSE_HITS = 0.01
PIECES = 1 << 19  # pieces a worker remembers, some 100 MB; it remembers no more then
PIECE_BYTES = 64  # longer ones are not remembered
CHUNK = 12 << 20  # bytes of text encoded together, or one text that is longer; each time the known pieces are hashed
TOGETHER = 4096  # new pieces encoded as one text

# A blank between two characters that no definition of white space takes for white space.
_SOLID = r"[^\x00-\x20\x7f-\xa0 ᠎ -‏ -  -⁯　﻿]"
_CUT = re.compile(rf" (?={_SOLID})(?<={_SOLID} )")
_WHOLE = rf"(?s)^{_SOLID}(?:.*{_SOLID})?$"


class Encoder:
    """Ids of texts as the tokenizers library gives them.

    The vocabulary's rules part a text before every blank between two solid characters, and no merge
    crosses such a place. So the ids of pieces between these places may be remembered, as words repeat. New
    pieces are handed to the library in one text; the lengths of the tokens tell where each piece ends.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, int)  # a character of a token stands for a byte
        for token, i in vocabulary.items():
            self.lengths[i] = len(token)
        self.known = pa.array([], pa.large_string())  # pieces, and where their ids lie in `values`
        self.values = np.zeros(0, "<i4")
        self.begins = self.sizes = np.zeros(0, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<i4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learned(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, each with a blank before it, and how many each has; all begin and end with solid
        characters."""
        if not len(pieces):
            return np.zeros(0, "<i4"), np.zeros(0, np.int64)
        listed = pieces.to_pylist()
        groups = [" " + " ".join(listed[i : i + TOGETHER]) for i in range(0, len(listed), TOGETHER)]
        ids = np.concatenate(self._ids(groups))
        ends = np.cumsum(pc.binary_length(pieces).to_numpy() + 1)
        reached = np.cumsum(self.lengths[ids])
        at = np.searchsorted(reached, ends) + 1
        if not np.array_equal(reached[at - 1], ends):
            raise ValueError("a token crosses a place where the vocabulary parts a text")
        return ids, np.diff(at, prepend=0)

    def _looked_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each piece where its ids begin and how many they are; none where the piece begins or
        ends otherwise than with a solid character."""
        coded = pieces.dictionary_encode()
        several, codes = coded.dictionary, coded.indices.to_numpy()
        place = pc.fill_null(pc.index_in(several, value_set=self.known), -1).to_numpy()
        new = np.flatnonzero(place < 0)
        whole = pc.match_substring_regex(several.take(pa.array(new)), _WHOLE).to_numpy(zero_copy_only=False)
        new = new[whole]
        fresh = several.take(pa.array(new))
        ids, sizes = self._learned(fresh)
        values = np.concatenate([self.values, ids])
        at = len(self.values) + np.cumsum(sizes) - sizes
        begins, counts = np.zeros(len(several), np.int64), np.zeros(len(several), np.int64)
        begins[place >= 0], counts[place >= 0] = self.begins[place[place >= 0]], self.sizes[place[place >= 0]]
        begins[new], counts[new] = at, sizes
        if len(self.known) < PIECES and len(fresh):  # words that occur often come early
            short = pc.less_equal(pc.binary_length(fresh), PIECE_BYTES).to_numpy(zero_copy_only=False)
            self.known = pa.concat_arrays([self.known, fresh.filter(pa.array(short))])
            self.begins, self.sizes = np.append(self.begins, at[short]), np.append(self.sizes, sizes[short])
            self.values = values
        return values, begins[codes], counts[codes]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has. Null counts as empty.

        Most texts are cut at every blank, as all their blanks stand between solid characters; the others
        are cut at the places themselves.
        """
        n = len(texts)
        if not n:
            return np.zeros(0, "<i4"), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        parts = pc.split_pattern(texts, " ")
        at = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        pieces, owner = parts.flatten(), np.repeat(np.arange(n), np.diff(at))
        values, begins, sizes = self._looked_up(pieces)
        rough = np.add.reduceat(sizes == 0, at[:-1]) > 0
        firsts = pieces.take(pa.array(at[:-1])).to_pylist()
        cut = {i: _CUT.split(texts[i].as_py()) for i in np.flatnonzero(rough).tolist()}
        for i, listed in cut.items():
            firsts[i] = listed[0]
        middle = pa.array([p for listed in cut.values() for p in listed[1:-1]], pa.large_string())
        of_middle = np.repeat(np.array(list(cut), int), [max(len(x) - 2, 0) for x in cut.values()])
        more, begins_more, sizes_more = self._looked_up(middle)
        lasts = {i: " " + listed[-1] for i, listed in cut.items() if len(listed) > 1}  # may end with a space
        edges = self._ids([*firsts, *lasts.values()])

        plain = np.flatnonzero(~rough[owner])
        plain = plain[plain != at[owner[plain]]]  # the first piece of a text has no blank before it
        edge_sizes = np.array([len(x) for x in edges], np.int64)
        edge_begins = len(values) + len(more) + np.cumsum(edge_sizes) - edge_sizes
        values = np.concatenate([values, more, *edges])
        owners = [np.arange(n), owner[plain], of_middle, np.array(list(lasts), int)]
        begins = [edge_begins[:n], begins[plain], begins_more + len(values) - len(more) - edge_sizes.sum(), edge_begins[n:]]
        sizes = [edge_sizes[:n], sizes[plain], sizes_more, edge_sizes[n:]]
        owner, begins, sizes = (np.concatenate(x) for x in (owners, begins, sizes))
        order = np.argsort(owner, kind="stable")
        begins, sizes = begins[order], sizes[order]
        before = np.cumsum(sizes) - sizes
        ids = values[np.repeat(begins - before, sizes) + np.arange(sizes.sum())]
        return ids, np.add.reduceat(sizes, np.searchsorted(owner[order], np.arange(n)))


@cache
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker process."""
    return Encoder(path)


def _schema(key: T.DataType) -> T.StructType:
    kinds = {
        "key": key, "part": T.IntegerType(), "row": T.LongType(), "before": T.LongType(), "n_tokens": T.LongType(),
        "ids": T.ArrayType(T.IntegerType()),
    }
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about CHUNK bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes.astype(np.int64)), 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
        yield batch.slice(at, to - at)
        at = to


def write_ids(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
              end: int = END) -> None:
    """Write the ids of every whole text, with `end` after each, as ORC files below `path`.

    Rows come in ascending order of the key (nulls first; rows of one key by a hash of their text, so repeated
    rows stand together, each with a row of its own). A key with very many rows is spread over files.
    Null texts count as empty and give `end` alone; an empty table gives no rows. Only the two columns are read.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.withColumns({"_text": F.xxhash64("text"), "_from": F.spark_partition_id()})
    order = [F.col("key").asc_nulls_first(), "_text", "_from"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    schema = _schema(df.schema[key].dataType)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, row, before = _encoder(vocabulary), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for some in _chunks(batch):
                ids, sizes = encoder(some.column("text"))
                ids = np.insert(ids, np.cumsum(sizes), end)
                ends = np.concatenate([[0], np.cumsum(sizes + 1)])
                n = some.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("key"),
                        pa.array(np.full(n, part, "i4")),
                        pa.array(np.arange(row, row + n)),
                        pa.array(before + ends[:-1]),
                        pa.array(np.diff(ends)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                    ],
                    names=schema.fieldNames(),
                )
                row, before = row + n, before + int(ends[-1])

    placed.mapInArrow(encode, schema).write.options(
        **{
            "orc.stripe.size": STRIPE_BYTES,
            "orc.create.index": "true",
            "orc.row.index.stride": INDEX_ROWS,
            "orc.bloom.filter.columns": "key",
            "orc.bloom.filter.fpp": FALSE_HITS,
            "orc.compress": "ZSTD",
        }
    ).orc(path)


def read_ids(spark: SparkSession, path: str, key: T.DataType = T.LongType()) -> DataFrame:
    """What `write_ids` wrote: key, part (the file), row and before (its place in the file), n_tokens, ids.

    Filters on key, part, row and before reach the files' statistics.
    """
    return spark.read.schema(_schema(key)).orc(path)


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """part and `first`, the tokens in the files before it: a row per file, from two narrow columns."""
    totals = read_ids(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"), "n")


def find(spark: SparkSession, path: str, keys: list) -> DataFrame:
    """The rows of some documents; Bloom filters and minima spare most of the files."""
    return read_ids(spark, path).filter(F.col("key").isin(*keys))


def stretch(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """start, key and ids of the documents that hold tokens `first` to `last` - 1 of the whole stream, cut to
    them. The files that hold none are not read, nor the row groups outside it."""
    files = file_starts(spark, path).filter((F.col("first") < last) & (F.col("first") + F.col("n") > first)).collect()
    found = []
    for f in files:
        start = F.lit(f["first"]) + F.col("before")
        low, high = F.greatest(F.lit(first) - start, F.lit(0)), F.least(F.lit(last) - start, F.col("n_tokens"))
        rows = read_ids(spark, path).filter((F.col("part") == f["part"]) & (F.col("before") < last - f["first"]))
        rows = rows.filter(start + F.col("n_tokens") > first)
        cut = F.slice("ids", (low + 1).cast("int"), (high - low).cast("int"))
        found.append(rows.select((start + low).alias("start"), "key", cut.alias("ids")))
    if not found:
        return read_ids(spark, path).select(F.col("before").alias("start"), "key", "ids").limit(0)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def digests(spark: SparkSession, path: str, key: T.DataType = T.LongType()) -> DataFrame:
    """key, start (tokens of all documents before it), n_tokens and ids_crc32, all from the files.

    A row whose ids are not as many as the file says fails the job.
    """
    schema = T.StructType(
        [*_schema(key)[:4], T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("ids")
            ends = held.offsets.to_numpy()
            values = held.values.to_numpy(zero_copy_only=False).astype("<u4")
            if (np.diff(ends) != batch.column("n_tokens").to_numpy()).any():
                raise ValueError("ids of a document are not as many as the file says")
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            columns = [batch.column(n) for n in ("key", "part", "row", "before")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.diff(ends).astype("i8")), pa.array(crc, pa.int64())], names=schema.fieldNames()
            )

    looked = read_ids(spark, path, key).mapInArrow(look, schema)
    return looked.join(file_starts(spark, path), "part").select(
        "key", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op11_orc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by `write_ids`, read back by `digests`; doc_id, start, n_tokens, ids_crc32."""
    docs, path = read(spark, sf_dir, "documents"), shared_folder(spark, "ids")
    write_ids(docs, path)
    return digests(spark, path, docs.schema["doc_id"].dataType).withColumnRenamed("key", "doc_id")
