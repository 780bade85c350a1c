import re

import corpus_pipeline
from tests.conftest import SF001, SF01
from tests.llm import test_decontaminate, test_pii, test_quality_rules, test_simhash_gray
from tests.llm.conftest import ODD
from tillwise.llm import byte_bpe, queries


def plain(rows, labels, items):
    """(doc_id, text) of what the stages keep, by the operators' brute-force versions; ids are unique."""
    judged, _ = test_quality_rules.plain([(i, t, lang) for i, t, lang in rows], labels)
    kept = {r[0] for r in judged if r[-1]}
    docs = [(i, t) for i, t, _ in rows if i in kept]
    first = {c for _, _, c in test_simhash_gray.plain(docs)}
    docs = [(i, t) for i, t in docs if i in first]
    bad = {r[0] for r in test_decontaminate.plain(docs, items) if r[-1]}
    out = {}
    for i, t in docs:
        if i in bad:
            continue
        spans = sorted((a, b, k) for k, own in test_pii.base(t).items() for a, b in own)
        text, at = [], 0
        for a, b, k in spans:
            if a >= at:
                text += [t[at:a], f"[{k.upper()}]"]
            at = max(at, b)
        out[i] = "".join(text) + t[at:]
    return out


def check(got, want):
    encoder = byte_bpe.worker_encoder(queries.VOCABULARY, queries.PATTERN)
    assert {r.doc_id: encoder.decode(r.token_ids).decode() for r in got} == want
    assert len(got) == len(want)
    assert all(r.n_tokens == len(r.token_ids) and r.n_chars == len(want[r.doc_id]) for r in got)


def read(spark, d):
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality").collect()]
    return docs, labels, [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]


def test_whole_tables(spark):
    for sf in (SF001, SF01):
        docs, labels, items = read(spark, sf)
        want = plain(docs, labels, items)
        assert 0.5 * len(docs) < len(want) < len(docs)
        check(corpus_pipeline.run(spark, sf).collect(), want)
    assert any(re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", t) for t in want.values())


def test_odd_rows_and_extra_columns(spark, make_docs, folder):
    words = " ".join(f"word{k}" for k in range(60))
    rows = [*ODD, (70, words), (71, words + " more"), (72, " ".join(f"other{k}" for k in range(40)) + " a@b.cd"), (73, " ".join(f"third{k}" for k in range(30)) + " secret item of the benchmark that has more than ten words in it ok")]
    docs = make_docs(rows).selectExpr("*", "'x' AS row", "1 AS code", "'z' AS judged", "array(1) AS seeds", "2 AS _words")
    d = folder(documents=docs, labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"), benchmark=spark.createDataFrame([(1, "secret item of the benchmark that has more than ten words in it ok")], "item_id long, text string"))
    own = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, own, d).columns == own.columns
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, d).collect()}
    assert {70, 72} <= set(got) and not {1, 2, 3, 73} & set(got)
    assert (got[70].row, got[70].code, got[70].judged, got[70].seeds, got[70]["_words"]) == ("x", 1, "z", [1], 2)


def test_empty_tables(spark, make_docs, folder):
    d = folder(documents=make_docs([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, d).collect() == []
