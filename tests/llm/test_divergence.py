import re
from collections import Counter, defaultdict

import pytest

from tests.conftest import SF001
from tests.llm.conftest import DOC, ODD
from tillwise.llm import divergence, queries

UNIT = 10 ** 9


def plain(rows, top=200):
    langs, out = defaultdict(list), []
    for text, lang, source in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        langs[lang or ""].append((source or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)))
    for lang, docs in langs.items():
        df, by, every = Counter(), defaultdict(Counter), Counter()
        for source, words in docs:
            df.update(set(words))
            by[source].update(words)
            every.update(words)
        kept = [t for t in df if df[t] >= 3]
        n = {s: sum(c[t] for t in kept) + len(kept) for s, c in by.items()}
        share = {s: {t: 1 + UNIT * (by[s][t] + 1) // n[s] for t in kept} for s in by}
        whole = {t: 1 + UNIT * (every[t] + 1) // (sum(every[x] for x in kept) + len(kept)) for t in kept}
        for s in by:
            pairs = [(o, sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept)) for o in by if o != s]
            terms = [(t, (share[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if by[s][t] and share[s][t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, o, v, i + 1) for i, (o, v) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture
def make(spark):
    def build(rows):
        return spark.createDataFrame([(i, t, lang, source, 0) for i, (t, lang, source) in enumerate(rows)], DOC).repartition(3)

    return build


ROWS = [(t, lang, source) for _, t in ODD for lang, source in (("en", "a"), ("en", None), (None, "a"), ("", ""))]
ROWS += [("Ä ä É é", "xx", "one"), ("ſ K k", "xx", "two"), ("lonely words here", "yy", "one"), (None, "yy", "two"), ("tie tie", "zz", "c"), ("tie", "zz", "b"), ("tie", "zz", "a"), ("1 2 3", "zz", "none")]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text", "lang", "source").collect()]
    assert got(queries.op13_divergence(spark, SF001)) == plain(rows)


def test_odd_rows(spark, make, folder):
    assert got(queries.op13_divergence(spark, folder(documents=make(ROWS)))) == plain(ROWS)


def test_empty_table(spark, make, folder):
    assert got(queries.op13_divergence(spark, folder(documents=make([])))) == []


def test_spills_blocks_and_pieces_change_nothing(make, monkeypatch):
    want = plain(ROWS)
    text = b"aa bb" * 1000 + "é".encode() * 500 + b" end"
    whole = Counter(x for block in divergence.terms(text) for x in block)
    monkeypatch.setattr(divergence, "BLOCK", 7)
    assert Counter(x for block in divergence.terms(text) for x in block) == whole
    assert list(divergence._pieces(divergence.np.array([3, 3, 9, 1]), 6)) == [(0, 2), (2, 3), (3, 4)]
    rows = make(ROWS)
    original = divergence.fold
    monkeypatch.setattr(divergence, "fold", lambda batches: original(batches, 5))
    assert got(divergence.Divergence(rows).report()) == want


def test_top_and_clashing_names(spark):
    rows = [("a a b", "en", "s", 1, "x"), ("a b c", "en", "t", 2, "x"), ("a c c", "en", "u", 3, "x"), ("b c", "en", "s", 4, None)]
    docs = spark.createDataFrame(rows, "body string, language string, source string, g long, term string")
    made = divergence.Divergence(docs, text="body", lang="language")
    assert got(made.report(top=1)) == plain([r[:3] for r in rows], top=1)


def test_large_counts_stay_exact(spark):
    n, m = 10 ** 12 + 7, 3 * 10 ** 13 + 11
    row = spark.createDataFrame([(n, m)], "n long, m long").selectExpr(divergence._share("n", "m") + " as p").first()
    assert row["p"] == 1 + UNIT * (n + 1) // m
