import zlib
from collections import defaultdict

import numpy as np

from tests.conftest import SF001
from tests.llm.conftest import ODD
from tillwise.llm import queries, sharding


def plain_jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def check(got, rows):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted((i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        key = -(1 << 63) if r.doc_id is None else r.doc_id
        assert (r.law, r.shard, r.grown_shard) == ("key", plain_jump(key, 16), plain_jump(key, 17))
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_whole_table(spark, corpus):
    check(queries.op2_jump_sharding(spark, SF001).collect(), corpus)


def test_odd_rows(spark, make_docs, folder):
    check(queries.op2_jump_sharding(spark, folder(documents=make_docs(ODD))).collect(), ODD)


def test_empty_table(spark, make_docs, folder):
    assert queries.op2_jump_sharding(spark, folder(documents=make_docs([]))).collect() == []


def test_shares_are_even():
    got = np.bincount(sharding.jump(np.arange(100_000, dtype=np.uint64), 16), minlength=16)
    assert got.min() > 5_800 and got.max() < 6_700


def test_written_shards(spark, make_docs, tmp_path):
    df = sharding.with_slot(sharding.with_shard(make_docs([(i, "t") for i in range(300)]), "doc_id", 4), "shard", ["doc_id"])
    sharding.write_shards(df, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, back.select("doc_id", "shard", "slot").collect())) == sorted(map(tuple, df.select("doc_id", "shard", "slot").collect()))
