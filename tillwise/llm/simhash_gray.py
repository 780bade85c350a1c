"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprint: the majority bits of the XXH64 hashes (seed 42) of all word
shingles.  Two fingerprints link at ``distance`` differing bits or fewer.

Linking.  Equal fingerprints are one node first, so exact copies cost one row.
The 64 bits are cut into ``distance + 2`` pieces; two codes within the distance
agree in at least two of them, so each pair of pieces gives one bucket table:
the two pieces are moved to the top of the code and rows are shuffled by them.
Inside a bucket the codes stand in the order of their Gray rank.  In that order
all codes that share their top bits are neighbours, so every prefix length is a
level of a tree whose nodes hold the shared bits once.  Pairs of nodes are
walked from the top down; the differences gathered so far prune whole groups.
Codes that link inside a task leave as a star (one edge for each code at most),
so a large group of near copies never leaves as pairs.

Defined results: a null, empty or blank text has fingerprint zero, which links
like any other; a null ``doc_id`` is linked but never names a component unless
all its members are null; repeated rows get one row each; an empty table gives
an empty result; other columns are left alone.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import Scratch, components, fresh, map_batches, raw_texts

SEED = 42
#: Depth of the tree's levels below the bucket's bits, and node pairs expanded at once.
LEVEL_BITS, WAVE = 8, 1 << 21
#: Rows that a task sorts out together (whole buckets; a larger bucket is taken whole).
ROWS_AT_ONCE = 1 << 17


def fingerprint(raw: bytes, width: int) -> int:
    """The 64-bit code of one text (UTF-8), with A-Z in lower case."""
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    last = min(width, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - last].tolist(), (ends[last:] - 1).tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):  # bits of very long texts in parts
        part = hashes[i: i + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint", width: int = 3, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all) columns plus the signed 64-bit code ``out``."""
    def add(batch):
        codes = [fingerprint(raw, width) for raw in raw_texts(batch.column(batch.schema.get_field_index(text)))]
        return [pa.array(np.array(codes, np.uint64).view(np.int64), pa.int64())]

    return map_batches(df, add, [T.StructField(out, T.LongType())], keep)


def pieces(distance: int) -> list[tuple[int, int]]:
    """(low bit, bits) of each of the ``distance + 2`` pieces of 64 bits."""
    k = distance + 2
    cuts = [64 * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(cuts)]


def arranged(codes: np.ndarray, top: tuple[int, int], cut: list[tuple[int, int]]) -> tuple[np.ndarray, int]:
    """Codes with the pieces ``top`` moved to the high end, and the bits they take."""
    out, bits = np.zeros_like(codes), 0
    for i in [*top, *(i for i in range(len(cut)) if i not in top)]:
        low, n = cut[i]
        piece = (codes >> np.uint64(low)) & np.uint64((1 << n) - 1)
        out = (out << np.uint64(n)) | piece
        bits += n if i in top else 0
    return out, bits


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


def gray_code(rank: np.ndarray) -> np.ndarray:
    return rank ^ (rank >> np.uint64(1))


def stars(codes: np.ndarray, group: np.ndarray, bits: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (member, root) that connect all codes linked inside their group.

    ``codes`` stand in Gray order inside each run of equal ``group``; the codes
    of a group share their top ``bits``.
    """
    n = len(codes)
    root = np.arange(n)
    depths = [*range(bits, 64, LEVEL_BITS), 64]
    edge = np.concatenate(([True], group[1:] != group[:-1]))
    levels = []
    for depth in depths:  # the nodes of a level are runs of equal top bits
        head = codes >> np.uint64(64 - depth)
        edge = edge | np.concatenate(([True], head[1:] != head[:-1]))
        at = np.flatnonzero(edge)
        levels.append((at, head[at]))
    child = [np.append(np.searchsorted(low[0], up[0]), len(low[0])) for up, low in itertools.pairwise(levels)]
    many = np.flatnonzero(np.diff(np.append(levels[0][0], n)) > 1)
    waves = [(0, many, many)] if len(many) else []
    while waves:
        level, a, b = waves.pop()
        if level == len(child):  # leaves: single codes
            at = levels[level][0]
            root = joined(root, at[a], at[b])
            continue
        first = child[level]
        na, nb = first[a + 1] - first[a], first[b + 1] - first[b]
        size = np.cumsum(na * nb)
        if len(a) > 1 and size[-1] > WAVE:  # a wave at a time
            cut = min(max(int(np.searchsorted(size, WAVE)), 1), len(a) - 1)
            waves += [(level, a[cut:], b[cut:]), (level, a[:cut], b[:cut])]
            continue
        if size[-1] > WAVE and na[0] > 1:  # one pair of very wide nodes: by the children of the first
            got = [(level + 1, *pruned(levels[level + 1][1], np.full(nb[0], i), np.arange(first[b[0]], first[b[0] + 1]), distance, a[0] == b[0])) for i in range(first[a[0]], first[a[0] + 1])]
            waves += [w for w in got if len(w[1])]
            continue
        of = np.repeat(np.arange(len(a)), na * nb)
        k = np.arange(size[-1]) - np.repeat(size - na * nb, na * nb)
        x, y = first[a[of]] + k // nb[of], first[b[of]] + k % nb[of]
        x, y = pruned(levels[level + 1][1], x, y, distance, a[of] == b[of], leaf=level + 1 == len(child))
        if len(x):
            waves.append((level + 1, x, y))
    member = np.flatnonzero(root != np.arange(n))
    return member, root[member]


def pruned(head, x, y, distance, same, leaf=False):
    """Node pairs whose shared bits differ in at most ``distance`` places, each once."""
    keep = np.bitwise_count(head[x] ^ head[y]) <= distance
    keep &= ~same | ((x < y) if leaf else (x <= y))
    return x[keep], y[keep]


def joined(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Roots after joining x[i] with y[i]: every node points at the smallest of its set."""
    while len(x):
        rx, ry = root[x], root[y]
        low = np.minimum(rx, ry)
        open_ = rx != ry
        if not open_.any():
            break
        np.minimum.at(root, rx[open_], low[open_])
        np.minimum.at(root, ry[open_], low[open_])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        x, y = x[open_], y[open_]
    return root


def linked_codes(codes: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) that connect all distinct ``code`` rows within ``distance`` bits."""
    cut = pieces(distance)
    tables = list(itertools.combinations(range(len(cut)), 2))

    def copies(batches):
        for batch in batches:
            code = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for t, top in enumerate(tables):
                moved, bits = arranged(code, top, cut)
                rank = gray_rank(moved)
                bucket = (rank >> np.uint64(64 - bits)).astype(np.int64) * len(tables) + t
                # the sign bit is flipped so that signed order is the order of ranks
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array((rank ^ np.uint64(1 << 63)).view(np.int64))], names=["bucket", "rank"])

    def back(moved, t):
        """The code as it was before its pieces were moved."""
        out, left = np.zeros_like(moved), 64
        for i in [*tables[t], *(i for i in range(len(cut)) if i not in tables[t])]:
            low, n = cut[i]
            left -= n
            out |= ((moved >> np.uint64(left)) & np.uint64((1 << n) - 1)) << np.uint64(low)
        return out

    def search(batches):
        def edges(bucket, rank):
            for t in range(len(tables)):
                own = bucket % len(tables) == t
                if not own.any():
                    continue
                moved = gray_code(rank[own].view(np.uint64) ^ np.uint64(1 << 63))
                member, root = stars(moved, bucket[own], sum(cut[i][1] for i in tables[t]), distance)
                code = back(moved, t).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(code[member]), pa.array(code[root])], names=["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
            rows += batch.num_rows
            if rows >= ROWS_AT_ONCE:
                bucket, rank = (np.concatenate(x) for x in zip(*held, strict=True))
                end = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                if end:
                    yield from edges(bucket[:end], rank[:end])
                held, rows = [(bucket[end:], rank[end:])], len(bucket) - end
        if rows:
            yield from edges(*(np.concatenate(x) for x in zip(*held, strict=True)))

    spread = codes.select("code").mapInArrow(copies, "bucket long, rank long")
    return spread.repartition("bucket").sortWithinPartitions("bucket", "rank").mapInArrow(search, "a long, b long")


def near_duplicates(scratch: Scratch, marked: DataFrame, code: str, doc_id: str = "doc_id", distance: int = 3, tie: str | None = None) -> DataFrame:
    """One row for each distinct code: ``code``, ``component`` (its smallest code) and the
    first document of the component: ``first_id`` and, with ``tie``, ``first_tie``.

    Null ids come last.  ``tie`` is a column that tells repeated rows apart.
    """
    who = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), (F.col(tie) if tie else F.lit(None).cast("long")).alias("tie"))
    own = scratch.save(marked.groupBy(F.col(code).alias("code")).agg(F.min(who).alias("who")))
    roots = components(scratch, linked_codes(own, distance))
    own = own.join(roots.withColumnRenamed("node", "code"), "code", "left").select("code", "who", F.coalesce("root", "code").alias("component"))
    own = scratch.save(own)
    first = own.groupBy("component").agg(F.min("who").alias("first"))
    return own.select("code", "component").join(first, "component").select("code", "component", F.col("first.id").alias("first_id"), F.col("first.tie").alias("first_tie"))


def component_ids(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) for every row."""
    scratch = Scratch(df.sparkSession, "simhash")
    marked = scratch.save(fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "code", width, ["doc_id"]))
    found = near_duplicates(scratch, marked, "code", distance=distance)
    return marked.join(found, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), F.col("first_id").alias("component_id"))


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``df`` that come first in their group of near duplicates (smallest id)."""
    scratch = Scratch(df.sparkSession, "simhash-keep")
    code, row = fresh(df, "code"), fresh(df, "row")
    marked = scratch.save(fingerprints(df.withColumn(row, F.monotonically_increasing_id()), text, code, width))
    found = near_duplicates(scratch, marked, code, doc_id, distance, tie=row)
    # written first, so that its size is known when the join is planned
    later = scratch.save(marked.select(row, code).join(found.select(F.col("code").alias(code), "first_tie"), code).where(F.col(row) != F.col("first_tie")).select(row))
    return marked.join(later, row, "left_anti").select(df.columns)
