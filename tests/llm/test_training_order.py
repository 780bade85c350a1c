import hashlib

import numpy as np
import pytest
import tiktoken

from tests.conftest import SF001
from tests.llm.conftest import ODD
from tillwise.llm import byte_bpe, queries, training_order
from tillwise.llm.common import Scratch


def expected(rows):
    library = tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=byte_bpe.read_ranks(queries.VOCABULARY), special_tokens={})
    out = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        out += [(i, k, len(ids[a: a + 512]), hashlib.sha256(" ".join(map(str, ids[a: a + 512])).encode()).hexdigest()) for k, a in enumerate(range(0, max(len(ids), 1), 512))]
    return sorted(out, key=str)


def check(got, rows):
    assert sorted(((r.doc_id, r.part, r.n_ids, r.ids_sha256) for r in got), key=str) == expected(rows)
    n = len(got)
    assert sorted(r.slot for r in got) == list(range(n)) == sorted(r.number for r in got)
    slots = training_order.permuted(np.array([r.number for r in got]), n, queries.ORDER_KEY)
    for r, s in zip(got, slots.tolist(), strict=True):
        assert r.slot == s
        assert (r.shard, r.place) == divmod(s, training_order.PER_SHARD)


def test_whole_table(spark, corpus):
    check(queries.op6_training_order(spark, SF001).collect(), corpus)


def test_odd_rows_in_small_shards(spark, make_docs, folder, monkeypatch):
    monkeypatch.setattr(training_order, "PER_SHARD", 7)
    got = training_order.materialise(make_docs(ODD), queries.VOCABULARY, queries.PATTERN, 5, per_shard=7).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert all((r.shard, r.place) == divmod(r.slot, 7) for r in got)
    assert sorted((str(r.doc_id), r.part, len(r.ids)) for r in got) == sorted((str(i), k, n) for i, k, n, _ in expected(ODD))


def test_empty_table(spark, make_docs, folder):
    assert queries.op6_training_order(spark, folder(documents=make_docs([]))).collect() == []


def test_reading_goes_on_from_a_slot(spark, make_docs):
    scratch = Scratch(spark, "test")
    df = make_docs([(i, f"text number {i}") for i in range(50)])
    path = scratch.path("out")
    n = training_order.write_shards(scratch, training_order.sequences(df, queries.VOCABULARY, queries.PATTERN, width=8), path, 9, 8, 6)
    got = training_order.read_shards(spark, path, 8, 20, 33, 6).collect()
    assert n == 50 and sorted(r.slot for r in got) == list(range(20, 33))


def test_long_texts_have_the_same_ids():
    tokenize = training_order.worker_tokenizer(queries.VOCABULARY, queries.PATTERN)
    own = byte_bpe.worker_encoder(queries.VOCABULARY, queries.PATTERN)
    for text in ("", "a b", "word " * 30_000, "x" * 99_999, " " * 99_999, "\n" * 99_999 + "x", " " * 1_500_000, "é" * 150_000):
        assert tokenize(text).tolist() == own.encode(text).tolist()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    numbers = np.arange(n)
    slots = training_order.permuted(numbers, n, 77)
    assert sorted(slots.tolist()) == numbers.tolist()
    assert (training_order.permuted(slots, n, 77, back=True) == numbers).all()
    if n >= 1000:
        assert (slots != training_order.permuted(numbers, n, 78)).mean() > 0.9
        assert abs(np.corrcoef(numbers, slots)[0, 1]) < 0.1


def test_shards_are_written_in_runs_without_old_shuffles(spark, make_docs):
    """Each run of shards has a folder; the shuffle of a run is gone when it is written."""
    import glob
    import os
    import time

    scratch = Scratch(spark, "test")
    df = make_docs([(i, f"text number {i}") for i in range(50)])
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    old, path = files(), scratch.path("runs")
    n = training_order.write_shards(scratch, training_order.sequences(df, queries.VOCABULARY, queries.PATTERN, width=8), path, 9, 8, 6)
    assert sorted(f for f in os.listdir(path) if f.startswith("first=")) == ["first=0", "first=3", "first=6"]
    assert spark.conf.get(training_order.CLEANUP) != "true"
    got = training_order.read_shards(spark, path, 8, per_shard=6).collect()
    assert n == 50 and sorted((r.shard, r.place, r.slot) for r in got) == [(*divmod(s, 6), s) for s in range(50)]
    # records that fill the shuffle: what is left is the counts' shuffle, files being deleted in the background
    pick = np.random.default_rng(4)
    large = make_docs([(i, " ".join(map(str, pick.integers(0, 1 << 60, 300)))) for i in range(50)])
    n = training_order.write_shards(scratch, training_order.sequences(large, queries.VOCABULARY, queries.PATTERN), scratch.path("large"), 9, per_shard=20)
    size = lambda: sum(os.path.getsize(f) for f in files() - old if os.path.exists(f))
    end = time.time() + 10
    while size() > n * 200 and time.time() < end:
        time.sleep(0.2)
    assert size() <= n * 200  # a record has 1,057 bytes
