import hashlib
import random
import re

from tests.conftest import SF001
from tests.llm.conftest import ODD
from tillwise.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def plain(docs, items):
    out = []
    windows = []
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        windows += [(item, tuple(w[i: i + n])) for i in range(len(w) - n + 1) if n]
    by = {}
    for item, w in windows:
        by.setdefault(w, set()).add(item)
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in {len(x) for x in by}:
            for a in range(len(w) - n + 1):
                if (own := by.get(tuple(w[a: a + n]))) is not None:
                    hit.update(range(a, a + n))
                    found |= own
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((i, len(w), len(hit), len([x for x in found if x is not None]), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_whole_table(spark, corpus):
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    want = plain(corpus, items)
    assert any(r[-1] for r in want) and not all(r[-1] for r in want)
    assert sorted(map(tuple, queries.op5_decontamination(spark, SF001).collect()), key=str) == want


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_odd_rows(spark, make_docs, folder):
    items = [(1, None), (2, ""), (3, "Hello"), (4, "hello hello hello"), (5, "no. id"), (5, "no. id"), (None, "word word word"), (6, "word " * 12), (7, "漢字"), (10, "HELLO!"), (11, "1 2 3 4 1 2 3 4 1 2 3")]
    docs = [*ODD, (20, "hel-lo 1.2.3 4 1 2 3 4 1 2 3 4 1 2 3 4"), (21, "no\nid no id no")]
    got = queries.op5_decontamination(spark, folder(documents=make_docs(docs), benchmark=bench(spark, items)))
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_random_words(spark, make_docs, folder):
    pick = random.Random(3)
    text = lambda n: " ".join(pick.choice("abc") for _ in range(n))
    items = [(i, text(pick.choice([1, 2, 3, 9, 10, 11, 25]))) for i in range(2, 30) if i % 5]
    docs = [(i, text(pick.randrange(0, 200))) for i in range(60)] + [(100, items[3][1] + " " + items[-1][1])]
    got = queries.op5_decontamination(spark, folder(documents=make_docs(docs), benchmark=bench(spark, items)))
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_empty_tables(spark, make_docs, folder):
    d = folder(documents=make_docs([]), benchmark=bench(spark, [(1, "a b c")]))
    assert queries.op5_decontamination(spark, d).collect() == []


def test_empty_benchmark(spark, make_docs, folder):
    d = folder(documents=make_docs([(1, "a b c"), (2, None)]), benchmark=bench(spark, []))
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in queries.op5_decontamination(spark, d).collect()) == [(1, 3, 0, False), (2, 0, 0, False)]
