import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.llm.conftest import ODD
from tillwise.llm import exact_dedup, queries


def plain(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda i: (i is None, -(i or 0)))
        out += [(i, ids[0], len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_whole_table(spark, corpus):
    assert got(queries.op11_exact_dedup(spark, SF001)) == plain(corpus)


def test_odd_rows(spark, make_docs, folder):
    assert got(queries.op11_exact_dedup(spark, folder(documents=make_docs(ODD)))) == plain(ODD)


def test_empty_table(spark, make_docs, folder):
    assert queries.op11_exact_dedup(spark, folder(documents=make_docs([]))).collect() == []


def test_heavy_hitters_and_the_rest(make_docs):
    rows = [(i, "hot" if i % 3 == 0 else f"pair {i // 2}" if i % 2 else f"text {i}") for i in range(600)]
    dedup = exact_dedup.ExactDedup(make_docs(rows), share=8)
    assert got(dedup.classes()) == plain(rows)
    digests = dedup.docs.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("row"), dedup._digest().alias("digest"))
    heavy = dedup.heavy(digests).collect()
    assert [(r["best"]["id"], r["size"]) for r in heavy] == [(597, 200)]


def test_kept_rows_and_clashing_names(spark):
    rows = [(i, t, i, "x", b"1") for i, t in enumerate([None, "", "a", "a", "b", "A"] + ["c"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long, digest string, best binary")
    kept = exact_dedup.ExactDedup(docs, share=4).keep()
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 25]
    folded = exact_dedup.ExactDedup(docs, normalise=F.lower).keep()
    assert sorted(r["doc_id"] for r in folded.collect()) == [1, 4, 5, 25]


def test_counters_keep_every_frequent_item():
    few = exact_dedup.MisraGries(9)
    stream = [f"x{i}" for i in range(500)] + ["a"] * 120 + [f"y{i}" for i in range(300)] + ["b"] * 110
    stream = stream[::7] + stream[1::7] + stream[2::7] + stream[3::7] + stream[4::7] + stream[5::7] + stream[6::7]
    for k in range(0, len(stream), 50):
        some = Counter(stream[k:k + 50])
        few.add(list(some), list(some.values()))
    assert len(few.counts) <= 9
    for item, n in Counter(stream).items():
        assert n - len(stream) / 10 <= few.counts.get(item, 0) <= n
