import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.conftest import SF01
from tillwise.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth int"


def plain(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[q] for q in children[k]) or 1
        saved[k] = sum(saved[q] for q in children[k]) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
        ends = ",".join(str(c) for c in sorted(members[k]) if len(rebuilt[c]) == len(k))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(prefix_trie.NODE).collect()), key=str)


@pytest.fixture
def make(spark):
    def build(rows):
        return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)

    return build


#: Null and repeated turns, null role and text, no id, ids below zero, copies, a long text, conversations shorter than their given beginning.
ODD = [(None, 0, "user", "no id"), (0, 0, "user", "hello"), (0, 1, None, None), (0, 1, "user", "x" * 40_000), (0, 2, "a", "é漢\U0001f600"), (0, 3, "a", "b"), (0, 4, "a", "c"), (0, 5, "a", "d"),
       (1, None, "user", "first"), (1, 0, "user", "hello"), (1, 0, "user", "hello"), (1, 9, "", ""), (-7, 3, "user", "hello"), (-7, 4, "user", "bye"), (-250, 0, "u", "lonely"),
       (305, 0, "user", "only turn"), (306, 0, "user", "only turn"), (2, 0, "ab", "c"), (3, 0, "a", "bc")] + [(c, t, "user", f"same {t}") for c in range(10, 40) for t in range(8)]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op12_prefix_trie(spark, SF01)) == plain(rows)


def test_odd_rows(spark, make, folder):
    assert got(queries.op12_prefix_trie(spark, folder(conversations=make(ODD)))) == plain(ODD)


def test_empty_table(spark, make, folder):
    assert got(queries.op12_prefix_trie(spark, folder(conversations=make([])))) == []


def test_blocks_pieces_and_a_full_sketch(make, monkeypatch):
    # long conversations over several blocks, lists over several pieces, and a sketch in which every estimate is two
    rows = ODD + [(c, t, "u", f"{t % 7}") for c in (500, 501, 650) for t in range(40)] + [(c, 0, "u", "t") for c in range(1000, 1300, 3)]
    want = plain(rows)
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    monkeypatch.setattr(prefix_trie, "PIECE", 16)
    assert got(prefix_trie.hundreds_trie(make(rows))) == want
    monkeypatch.setattr(prefix_trie, "CELLS", 3)
    monkeypatch.setattr(prefix_trie, "SEGMENT", 8)
    assert got(prefix_trie.hundreds_trie(make(rows))) == want


def test_sketch_never_misses_a_pair(spark):
    n = 5_000
    keys = spark.range(n).selectExpr("xxhash64(id % 4000) as a", "xxhash64(id % 4000, 7) as b").repartition(5)
    width = prefix_trie.SEGMENT
    bits = {r["segment"]: r["bits"] for r in prefix_trie.sketch(keys, width).collect()}
    two = np.concatenate([np.unpackbits(np.frombuffer(bits[i], np.uint8).reshape(2, -1)[1]) for i in sorted(bits)])
    rows = keys.distinct().collect()
    low, high = (np.array([r[c] for r in rows], np.int64).view(np.uint64) for c in "ab")
    many = np.logical_and.reduce([two[c] == 1 for c in prefix_trie._cells(low, high, width)])
    twice = {tuple(r) for r in keys.groupBy("a", "b").count().where("count > 1").select("a", "b").collect()}
    assert all(m for m, r in zip(many, rows) if tuple(r) in twice)
    assert sum(many) < len(twice) + 100
