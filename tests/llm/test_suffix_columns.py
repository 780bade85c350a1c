import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm.conftest import ODD
from tillwise.llm import queries, suffix_columns


def plain(docs, length=400):
    raws = [(t or "").encode() for _, t in docs]
    seen = Counter(hash(r[s: s + length]) for r in raws for s in range(len(r) - length + 1))
    out = []
    for (i, _), r in zip(docs, raws, strict=True):
        gone, end = bytearray(len(r)), 0
        for s in range(len(r) - length + 1):
            if seen[hash(r[s: s + length])] > 1:
                for x in range(max(end, s), s + length):
                    gone[x] = 1
                end = s + length
        spans = len(suffix_columns.runs(np.frombuffer(bytes(gone), np.uint8) > 0))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((i, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_whole_table(spark, corpus):
    want = plain(corpus)
    assert sum(0 < r[2] < r[1] for r in want) > 5
    assert sorted(map(tuple, queries.op10_suffix_columns(spark, SF001).collect()), key=str) == want


def test_odd_rows(spark, make_docs, folder, monkeypatch):
    monkeypatch.setattr(suffix_columns, "PIECE", 3000)
    pick = random.Random(4)
    noise = lambda n: "".join(pick.choice("abcdefgh é") for _ in range(n))
    a, b, c = noise(380), noise(401), noise(900)
    docs = [*ODD[:7], (8, "x" * 1500), (9, "xy" * 700), (10, a + "1" + a), (11, b + "2" + noise(50)), (12, noise(30) + b), (13, c + b[:200]), (14, noise(9) + c[100:700] + noise(5) + c[:500]), (15, c[300:]), (16, "é" * 399), (17, "é" * 200), (18, c), (18, c), (19, noise(5000))]
    docs += [(100 + k, noise(20 + k) + c[:600] + noise(300)) for k in range(8)]  # one passage in different surroundings
    assert sorted(map(tuple, queries.op10_suffix_columns(spark, folder(documents=make_docs(docs))).collect()), key=str) == plain(docs)


def test_hot_anchors_are_dealt(spark, make_docs, monkeypatch):
    monkeypatch.setattr(suffix_columns, "HOT", 5, raising=False)
    pick = random.Random(6)
    noise = lambda n: "".join(pick.choice("abcdefgh é") for _ in range(n))
    c, d = noise(900), noise(500)
    docs = [(k, noise(20 + k) + c[k % 7: 700 - k] + noise(300) + d * (k < 3)) for k in range(40)] + [(50, c + c), (51, "x" * 1500), (52, c), (52, c)]
    found = suffix_columns.RepeatedStrings(make_docs(docs), keep=["doc_id"])
    largest = found.segments.where("anchor is not null").groupBy("anchor").agg({"row": "count"}).collect()
    assert 1 < max(r[1] for r in largest) <= 2 * suffix_columns.HOT
    got = found.stripped().collect()
    want = plain(docs)
    assert sorted((r.doc_id, len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted((r[0], r[3], r[4]) for r in want)


def test_empty_table(spark, make_docs, folder):
    assert queries.op10_suffix_columns(spark, folder(documents=make_docs([]))).collect() == []


@pytest.mark.parametrize("letters", ["ab", "abc"])
def test_short_strings(spark, make_docs, letters, monkeypatch):
    monkeypatch.setattr(suffix_columns, "TOGETHER", 7)
    pick = random.Random(len(letters))
    docs = [(i, "".join(pick.choice(letters) for _ in range(pick.randrange(0, 120)))) for i in range(60)]
    got = suffix_columns.RepeatedStrings(make_docs(docs), keep=["doc_id"], length=9, gram=4).stripped().collect()
    want = plain(docs, 9)
    assert sorted((r.doc_id, len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted((r[0], r[3], r[4]) for r in want)
    assert any(0 < r[2] < r[1] for r in want)
