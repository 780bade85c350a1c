"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes are a linked list.  Adjacent pairs that the vocabulary can
merge wait in a bucket of their merge rank; a bitmap over the ranks, under a
bitmap over its words, gives the lowest waiting rank by find-first-set on each
level.  A merge changes its two neighbours' pairs;
entries left behind are stale and skipped when they come up.  A merge costs a
few word operations however long the pre-token is.

Tasks keep the ids of the pre-tokens seen lately (two generations of
``CACHE_ROWS``), so common ones are merged once for a worker process.

Defined results: a null or empty text has no ids and decodes to no bytes;
special tokens' strings are ordinary text; repeated rows are encoded alike;
other columns are kept as they are.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillwise.llm.common import blocks, raw_texts, utf8

#: Pre-tokens that a generation of a worker's cache holds, and the longest it takes (characters).
CACHE_ROWS, CACHE_LONGEST = 1 << 19, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A .tiktoken file: base64 of the token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Buckets of positions by rank; the lowest rank comes from a bitmap of two levels.

    A word has 256 ranks' bits; the top has a bit for each word.  Find-first-set on the
    top and then on one word gives the lowest rank.
    """

    __slots__ = ("buckets", "top", "words")

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.words = [0] * ((ranks >> 8) + 1)
        self.top = 0

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [at]
            self.words[rank >> 8] |= 1 << (rank & 255)
            self.top |= 1 << (rank >> 8)
        else:
            heapq.heappush(bucket, at)

    def pop(self) -> tuple[int, int]:
        """The lowest rank that waits, and the first position of its bucket."""
        top = self.top
        w = (top & -top).bit_length() - 1
        word = self.words[w]
        rank = (w << 8) + (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heapq.heappop(bucket)
        del self.buckets[rank]
        word &= word - 1
        self.words[w] = word
        if not word:
            self.top = top & (top - 1)
        return rank, bucket[0]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.cache = _Cache(self)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        queue, n, get = self.queue, len(piece), ranks.get
        part: list[bytes | None] = [piece[i: i + 1] for i in range(n)]
        push = queue.push
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waits = [-1] * n  # rank of the pair that starts here; other entries of the queue are stale
        for i in range(n - 1):
            rank = get(piece[i: i + 2])
            if rank is not None:
                waits[i] = rank
                push(rank, i)
        while queue.top:
            rank, i = queue.pop()
            if waits[i] != rank:
                continue
            j = after[i]
            part[i] += part[j]
            part[j], waits[j] = None, -1
            after[i] = k = after[j]
            waits[i] = -1
            if k < n:
                before[k] = i
                pair = get(part[i] + part[k])
                if pair is not None:
                    waits[i] = pair
                    push(pair, i)
            if (h := before[i]) >= 0:
                pair = get(part[h] + part[i])
                if pair is None:
                    waits[h] = -1
                elif waits[h] != pair:
                    waits[h] = pair
                    push(pair, h)
        out, i = [], 0
        while i < n:
            out.append(ranks[part[i]])
            i = after[i]
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        return np.frombuffer(b"".join(map(self.cache.__getitem__, self.split(text))), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Cache(dict):
    """Pre-token to its packed ids; the older generation goes when the younger is full."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.old = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(self.encoder.merge(piece.encode()), np.int32).tobytes()
        if len(piece) <= CACHE_LONGEST:
            if len(self) >= CACHE_ROWS:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


_ENCODERS: dict[tuple, Encoder] = {}


def worker_encoder(path: str, pattern: str) -> Encoder:
    """This process's encoder; the vocabulary file is part of the installation of every node."""
    key = (path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(read_ranks(path), pattern)
    return _ENCODERS[key]


def _lists(each: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, each)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*each, np.zeros(0, np.int32)])))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", decoded: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all) columns plus ``ids`` (array of int); with ``decoded``, also the bytes that the ids stand for."""
    keep = df.columns if keep is None else keep
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField(decoded, T.BinaryType()))
    schema = T.StructType([df.schema[c] for c in keep] + fields)

    def run(batches) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for i, j in blocks(utf8(column)[1]):
                part = batch.slice(i, j - i)
                each = [encoder.encode(raw.decode()) for raw in raw_texts(column.slice(i, j - i))]
                out = [*(part.column(part.schema.get_field_index(c)) for c in keep), _lists(each)]
                if decoded:
                    out.append(pa.array([encoder.decode(x.tolist()) for x in each], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Append the bytes that each row's ids stand for (null ids: none)."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            got = pa.array([encoder.decode(x or []) for x in column.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))
