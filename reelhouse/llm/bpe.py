"""Byte-level BPE encoding and decoding in linear time.

The bytes of a piece, read as Latin-1, run through an Aho-Corasick automaton over the vocabulary. From
the left the longest token that may follow the one before is taken; where nothing may follow, the last
token gives way to its next shorter one, and the place is never tried again. Two tokens may stand
side by side if their joined bytes merge into just these two; that is remembered. A row of tokens of
which all neighbours may stand side by side is the one that the merges themselves give.
"""

from __future__ import annotations

import base64
import functools

import ahocorasick
import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import map_rows, read, stage

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
REMEMBERED = 500_000  # pieces, and neighbours, that a task keeps in mind before it starts anew


class Memo(dict):
    """A dictionary that computes what it lacks and is emptied when full."""

    def __init__(self, compute, most: int = REMEMBERED):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class Bpe:
    """A vocabulary of byte strings, the rank of each being its id and its place among the merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int = REMEMBERED):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.halves = Memo(self._last_merge, len(ranks))
        self.neighbours = Memo(self._may_meet, most)
        self.packed = Memo(self._pack, most)

    @classmethod
    def from_file(cls, path: str, pattern: str, most: int = REMEMBERED) -> Bpe:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return cls(ranks, pattern, most)

    def merge(self, piece: bytes) -> list[int]:
        """The plain way, for short pieces: always join the pair of the lowest rank, leftmost first."""
        return [self.ranks[p] for p in self._merge_parts(piece)]

    def _merge_parts(self, piece: bytes, stop: int = 1) -> list[bytes]:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > stop:
            pairs = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = min((p for p in pairs if p[0] is not None), default=None)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _last_merge(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose join makes this one; None for a single byte or what no merges make."""
        halves = self._merge_parts(self.tokens[token], stop=2)
        return tuple(self.ranks[h] for h in halves) if len(halves) == 2 else None

    def _may_meet(self, pair: tuple[int, int]) -> bool:
        """Undo the merges at the seam, the latest first; no join across it may have come before them.

        Of equal ranks the left one is merged first, hence the uneven comparisons.
        """
        left, right = pair
        left_used = right_used = len(self.ranks)  # rank of the merge that took up what is at the seam
        while True:
            joined = self.joined(left, right)
            if joined is not None and (joined < left_used and joined <= right_used):
                return False
            a, b = self.halves[left], self.halves[right]
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                left_used, left = left, a[1]
            else:
                right_used, right = right, b[0]

    def joined(self, left: int, right: int) -> int | None:
        return self.ranks.get(self.tokens[left] + self.tokens[right])

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        at: list[list[tuple[int, int]]] = [[] for _ in range(size)]  # tokens from a place, longest last
        for end, match in self.automaton.iter(piece.decode("latin-1")):
            at[end + 1 - match[1]].append(match)
        ids: list[int] = []
        steps: list[tuple[int, int]] = []  # where each chosen token begins, and which of those there
        open_ = [True] * (size + 1)
        place, k = 0, len(at[0]) - 1
        while place < size:
            found = at[place]
            while k >= 0:
                rank, length = found[k]
                if open_[place + length] and (not ids or self.neighbours[ids[-1], rank]):
                    break
                k -= 1
            if k >= 0:
                ids.append(rank)
                steps.append((place, k))
                place += length
                k = len(at[place]) - 1 if place < size else 0
            else:
                open_[place] = False
                place, k = steps.pop()
                ids.pop()
                k -= 1
        return ids

    def _pack(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece.encode()), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.pieces.findall(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@functools.cache
def worker_bpe(path: str, pattern: str) -> Bpe:
    """One for all tasks of a Python worker."""
    return Bpe.from_file(path, pattern)


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The ids of every text: `key`, `n_tokens`, `ids` (packed) and `decoded`, the bytes they stand for.

    `path` leads to a rank file that every executor has. A null text counts as empty and has no ids; any
    row gives one row, repeated ones too; columns other than the two named are not looked at.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def start():
        bpe = worker_bpe(path, pattern)

        def work(rows: dict[str, list]) -> dict[str, list]:
            ids = [bpe.encode(t or "") for t in rows["_text"]]
            return {
                "_key": rows["_key"],
                "n_tokens": [len(i) // 4 for i in ids],
                "ids": ids,
                "decoded": [bpe.decode(i) for i in ids],
            }

        return work

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    out = map_rows(rows, start, f"_key {kind}, n_tokens bigint, ids binary, decoded binary")
    return out.withColumnRenamed("_key", key)


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_tokens and sha256 of ids and of the decoded bytes."""
    return encode(df).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))


@stage
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed) and the digests of ids and decoded bytes."""
    return encode(docs).select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
