import itertools
import random
import re

import numpy as np
import xxhash

from tests.conftest import SF001
from tests.llm.conftest import ODD
from tillwise.llm import queries, simhash_gray


def plain_code(text, width=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i: i + width]).encode(), 42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, distance=3):
    codes = [plain_code(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (codes[a] ^ codes[b]).bit_count() <= distance:
            root[find(a)] = find(b)
    first = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            first[find(k)] = min(i, first.get(find(k), i))
    return sorted(((i, f"{codes[k]:016x}", first.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def test_whole_table(spark, corpus):
    want = plain(corpus)
    assert len({r[2] for r in want}) < len(want)
    assert sorted(map(tuple, queries.op9_simhash(spark, SF001).collect()), key=str) == want


def test_odd_rows(spark, make_docs, folder):
    rows = [*ODD, (0, "Hello hello hello"), (30, "one"), (31, "ONE"), (32, "one two")]
    assert sorted(map(tuple, queries.op9_simhash(spark, folder(documents=make_docs(rows))).collect()), key=str) == plain(rows)


def test_empty_table(spark, make_docs, folder):
    assert queries.op9_simhash(spark, folder(documents=make_docs([]))).collect() == []


def test_every_link_is_found(spark, monkeypatch):
    monkeypatch.setattr(simhash_gray, "WAVE", 64)  # small waves walk the other branches too
    pick = random.Random(2)
    codes = set()
    for _ in range(12):
        x = pick.getrandbits(64)
        for _ in range(60):
            codes.add(x)
            x ^= sum(1 << b for b in pick.sample(range(64), pick.randrange(1, 6)))
    codes = np.unique(np.array(sorted(codes), np.uint64))
    cut = simhash_gray.pieces(3)
    root = np.arange(len(codes))
    for top in itertools.combinations(range(len(cut)), 2):
        moved, bits = simhash_gray.arranged(codes, top, cut)
        rank = simhash_gray.gray_rank(moved)
        assert (simhash_gray.gray_code(rank) == moved).all()
        order = np.argsort(rank)
        member, own = simhash_gray.stars(moved[order], (rank[order] >> np.uint64(64 - bits)).astype(np.int64), bits, 3)
        root = simhash_gray.joined(root, order[member], order[own])
    want = np.arange(len(codes))
    x, y = np.triu_indices(len(codes), 1)
    near = np.bitwise_count(codes[x] ^ codes[y]) <= 3
    assert near.sum() > 100
    assert (simhash_gray.joined(want, x[near], y[near]) == root).all()


def test_keep_first(spark, make_docs):
    rows = [(5, "a b c d e"), (3, "A b c d e"), (3, "a  b c d e"), (None, "a b c d e"), (9, "quite another text than this one"), (8, None), (8, "")]
    got = simhash_gray.keep_first(make_docs(rows)).collect()
    assert sorted(r.doc_id for r in got) == [3, 8, 9]
    assert got[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
