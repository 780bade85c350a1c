import hashlib
import random
import re

from tests.conftest import SF001
from tests.llm.conftest import ODD
from tillwise.llm import pii, queries

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [2 * x - 9 * (2 * x > 9) if i % 2 else x for i, x in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def base(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in FORMS.items()}


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k in FORMS for a, b in spans[k])


def row(i, text):
    found = base(text)
    return (i, *(len(found[k]) for k in FORMS), hashlib.sha256(listed(found).encode()).hexdigest())


def check(got, docs):
    assert sorted((tuple(r[:6]) for r in got), key=str) == sorted((row(i, t) for i, t in docs), key=str)
    for r in got:  # the base spans are among all spans, by kind and start
        order = [(list(FORMS).index(k), int(a)) for k, a, _ in (x.split(":") for x in r.spans.split(",") if x)]
        assert order == sorted(order)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append(set(filter(None, listed(base(t)).split(","))))
    for r in got:
        assert any(x <= set(r.spans.split(",")) for x in texts[r.doc_id])


def test_whole_table(spark, corpus):
    got = queries.op7_pii(spark, SF001).collect()
    check(got, corpus)
    assert any(r.n_email for r in got) and any(r.n_card for r in got)
    assert all(r.spans == listed(base(t)) for r, t in ((r, dict(corpus)[r.doc_id]) for r in got))  # nothing else in these texts


HARD = [
    (50, "a@b.c_d@e.f x@y x@y.z..w 1@2.3 é@a.b ñ.a@b-c.de-"), (51, "1.2.3.4.5 256.1.1.1 01.002.0255.3 1.2.3 999999999999999999999999.1.1.1 0000000000000000000000000000255.1.1.1.9"),
    (52, "4845168114407329 4845-1681-1440-7329 4845 1681 1440 7328 7536784127813050 4845168114407329 x4845168114407329y 48451681144073290000"),
    (53, "+1 (017) 555-7713 +1234567 +12345678 ++123456789 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +9(8)7-6.5 4 3 2 1) +1"),
    (54, "1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1  2-2 -3 4- 5 \U0001f600 a@b.cd \U0001f600 1.1.1.1"), (55, "9" * 20_000), (56, "1 " * 20_000), (57, "a.b" * 9_000 + "@" + "c." * 9_000 + "d"),
    (58, "+" + "1 (" * 5_000), (59, "x@" * 5_000), (60, "1.1.1.1 " * 300),
]


def test_odd_rows(spark, make_docs, folder):
    docs = [*ODD, *HARD]
    check(queries.op7_pii(spark, folder(documents=make_docs(docs))).collect(), docs)


def test_random_strings(spark, make_docs, folder):
    pick = random.Random(8)
    docs = [(i, "".join(pick.choice(pick.choice(["0123456789 -", "+1() .-", "a@.b", "1.2", "ab@c. 1+"])) for _ in range(pick.randrange(5, 300)))) for i in range(400)]
    check(queries.op7_pii(spark, folder(documents=make_docs(docs))).collect(), docs)


def test_empty_table(spark, make_docs, folder):
    assert queries.op7_pii(spark, folder(documents=make_docs([]))).collect() == []


def test_contexts_discover_new_writings(spark, make_docs, folder):
    docs = [(i, f"some words tel: +1 (017) 555-77{i:02d} and the rest of it") for i in range(10)]
    docs += [(20, "call tel: 017 555 9913, please"), (21, "the 017 555 9913 is not known here"), (22, "tel: soon"), (23, "the +1 (017) 555-1234 the +1 (017) 555-1235 the +1 (017) 555-1236 " + "the word " * 50)]
    got = {r.doc_id: r.spans for r in queries.op7_pii(spark, folder(documents=make_docs(docs))).collect()}
    assert got[20] == "phone:10:22"
    assert got[21] == "" and got[22] == ""


def test_redaction(spark, make_docs):
    docs = [(1, "mail a@b.cd or 4845168114407329."), (2, None), (3, "none"), (4, "+1 (017) 555-7713")]
    df = make_docs(docs)
    got = pii.Extractor(df).redacted(df.columns)
    assert {r.doc_id: r.text for r in got.collect()} == {1: "mail [EMAIL] or [CARD].", 2: None, 3: "none", 4: "[PHONE]"}
    assert got.columns == df.columns


def test_no_python_in_the_plan(spark):
    got = queries.op7_pii(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in got and "Arrow" not in got and "Pandas" not in got


def test_many_matches_and_long_pieces(spark):
    """A text of many separate matches, and spans at the seams of the pieces that redaction cuts a text into."""
    seams = "x" * 4094 + " 1.2.3.4 " + "é" * 4085 + " a@b.org " + "\U0001f600" * 9000 + " +49 30 1234567 end"
    many = " ".join(f"{i % 250}.7.2.{i % 99}" if i % 3 else f"n{i}" for i in range(6_000))
    rows = [(1, many), (2, seams), (3, "1.2.3.4"), (4, "x" * 4096), (5, None)]
    found = pii.Extractor(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = {r.doc_id: [(x["kind"], x["start"], x["end"]) for x in r.spans] for r in found.spans().collect()}
    want = {i: [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}", t or "")] for i, t in rows}
    want[2] = want[2][:1] + [("email", seams.index("a@b.org"), seams.index("a@b.org") + 7), ("phone", seams.index("+49"), seams.index(" end"))]
    for i in want:
        assert sorted(spans[i], key=lambda x: x[1]) == want[i]
    for r in found.redacted(["doc_id", "text"]).collect():
        out, at = [], 0
        text = dict(rows)[r.doc_id]
        for kind, start, end in want[r.doc_id]:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        assert r.text == (None if text is None else "".join(out) + text[at:])
