import hashlib
import random

import pytest
import tiktoken

from tests.conftest import SF001
from tests.llm.conftest import ODD
from tillwise.llm import byte_bpe, queries


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(queries.VOCABULARY)
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.worker_encoder(queries.VOCABULARY, queries.PATTERN)


def expected(library, rows):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        out.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    return sorted(out, key=str)


def test_whole_table(spark, corpus, library):
    got = queries.op1_byte_bpe(spark, SF001).collect()
    assert sorted(map(tuple, got), key=str) == expected(library, corpus)


def test_odd_rows(spark, make_docs, folder, library):
    rows = [*ODD, (10, "<|endoftext|> it's we'll 12345\r\n\r\n  x     y")]
    got = queries.op1_byte_bpe(spark, folder(documents=make_docs(rows))).collect()
    assert sorted(map(tuple, got), key=str) == expected(library, rows)


def test_empty_table(spark, make_docs, folder):
    assert queries.op1_byte_bpe(spark, folder(documents=make_docs([]))).collect() == []


def test_random_texts(encoder, library):
    pick = random.Random(5)
    for _ in range(300):
        alphabet = pick.choice(["ab", "aAé ", " \n\t", "".join(chr(pick.randrange(0x20, 0x3000)) for _ in range(40)), "the cat's  "])
        text = "".join(pick.choice(alphabet) for _ in range(pick.randrange(0, 400)))
        ids = encoder.encode(text).tolist()
        assert ids == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_queue_is_ordered():
    queue, pick = byte_bpe.RankQueue(300_000), random.Random(1)
    put = [(pick.randrange(300_000), i) for i in range(500)] + [(7, i) for i in range(50)]
    pick.shuffle(put)
    for rank, at in put:
        queue.push(rank, at)
    out = []
    while queue.top:
        out.append(queue.pop())
    assert out == sorted(put)


def test_decode_and_clashing_names(spark):
    df = spark.createDataFrame([("hi there", [1]), (None, None)], "TEXT string, decoded array<int>")
    got = byte_bpe.encode(df, queries.VOCABULARY, queries.PATTERN, text="TEXT", ids="ids")
    back = byte_bpe.decode(got, queries.VOCABULARY, queries.PATTERN, "ids", "raw")
    assert [(r["TEXT"], bytes(r["raw"]), r["decoded"]) for r in back.collect()] == [("hi there", b"hi there", [1]), (None, b"", None)]
