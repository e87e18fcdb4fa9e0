"""Encoding of a whole corpus with a public byte-level BPE (problem 7).

Merges of a pre-token are taken from a hierarchical-bitmap rank queue: one bucket of linked-list
positions per merge rank, a two-level bitmap whose find-first-set names the next rank, and stale
positions skipped when they come up. A pre-token of n bytes needs O(n log n) whatever its length.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
import regex
from foliant.session import ship
from pyspark.sql import DataFrame

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
#: A memo of short pre-tokens is emptied when it holds so many; it changes speed, never a result.
MEMO_ENTRIES = 200_000
MEMO_CHARS = 40

# Fixed value: the published split pattern of this vocabulary.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def load_ranks(name: str = VOCABULARY, folder: str = TOKENIZER_DIR) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    with open(f"{folder}/{name}.tiktoken") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class RankQueue:
    """Positions by rank; ``pop`` gives the least rank and in it the leftmost position."""

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.leaves: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        leaf = rank >> 6
        self.leaves[leaf] = self.leaves.get(leaf, 0) | (1 << (rank & 63))
        self.top |= 1 << leaf

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        leaf = (self.top & -self.top).bit_length() - 1
        bits = self.leaves[leaf]
        rank = (leaf << 6) | ((bits & -bits).bit_length() - 1)
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            bits &= bits - 1
            self.leaves[leaf] = bits
            if not bits:
                self.top &= ~(1 << leaf)
        return rank, position


class Encoder:
    """Token ids of texts under one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.split = regex.compile(SPLIT)
        self.memo: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = RankQueue()
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                queue.push(rank, i)
        while (best := queue.pop()) is not None:
            rank, i = best
            left, j = part[i], after[i]
            if left is None or j >= n or ranks.get(left + part[j]) != rank:
                continue
            joined = left + part[j]
            part[i], part[j] = joined, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get(joined + part[k])
                if rank is not None:
                    queue.push(rank, i)
            h = before[i]
            if h >= 0:
                rank = ranks.get(part[h] + joined)
                if rank is not None:
                    queue.push(rank, h)
        return tuple(ranks[p] for p in part if p is not None)

    def extend(self, text: str | None, out: array) -> None:
        """Appends the ids of ``text``; null and empty texts have none."""
        if not text:
            return
        memo = self.memo
        for piece in self.split.findall(text):
            ids = memo.get(piece)
            if ids is None:
                ids = self.merge(piece.encode())
                if len(piece) <= MEMO_CHARS:
                    if len(memo) >= MEMO_ENTRIES:
                        memo.clear()
                    memo[piece] = ids
            out.extend(ids)

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        self.extend(text, out)
        return out.tolist()


_ENCODERS: dict[str, Encoder] = {}


def _encoder(key: str, ranks) -> Encoder:
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(ranks.value)
    return _ENCODERS[key]


def _run(df: DataFrame, id_col: str, text_col: str, name: str, folder: str, counts: bool) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    ranks = spark.sparkContext.broadcast(load_ranks(name, folder))
    key = f"{folder}/{name}"
    source = df.select(id_col, text_col)
    id_type = source.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(key, ranks)
        for batch in batches:
            ids, ends = array("i"), array("i", [0])
            for text in batch.column(1):
                enc.extend(text.as_py(), ids)
                ends.append(len(ids))
            offsets = pa.array(ends, pa.int32())
            if counts:
                import numpy as np

                value = pa.array(np.diff(np.asarray(ends)), pa.int32())
            else:
                value = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), value], names=[id_col, "n_tokens" if counts else "ids"])

    what = "n_tokens int" if counts else "ids array<int>"
    return source.mapInArrow(work, f"`{id_col}` {id_type}, {what}")


def encode_corpus(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = VOCABULARY, folder: str = TOKENIZER_DIR
) -> DataFrame:
    """(id, ids array<int>): the token ids of each text, one output row for each input row.

    No special tokens are added, and their strings in a text are ordinary text. Null and empty
    texts give the empty list. Other columns are left out, so names cannot clash. Only the
    vocabulary (a fixed file) is broadcast.
    """
    return _run(df, id_col, text_col, name, folder, False)


def token_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = VOCABULARY, folder: str = TOKENIZER_DIR
) -> DataFrame:
    """(id, n_tokens int): sizes in tokens; 0 for null and empty texts."""
    return _run(df, id_col, text_col, name, folder, True)
