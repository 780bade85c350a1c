"""Cleaning, tokens, stop words, bigrams (T1-T4) and TF-IDF (T5) against plain Python."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tillwise.functions.text import PUNCTUATION, SPECIAL_CHARS, STOP_WORDS, clean_special, terms
from tillwise.operators.tfidf import fit_idf, term_counts, tfidf

TEXTS = ["Arroz (tipo-1) 5kg/fardo; CAFÉ & açúcar!!", "a o de", "", "x y z", "Leite de vaca - 1L, leite"]


def py_terms(text):
    t = re.sub(SPECIAL_CHARS, " ", text)
    t = re.sub(PUNCTUATION, " ", t)
    toks = [w for w in re.findall(r"(?u)\b\w\w+\b", t.lower()) if w not in STOP_WORDS]
    return toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]


def test_terms_match_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    got = {r.id: list(r.t) for r in df.select("id", terms(F.col("text")).alias("t")).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == py_terms(t), t


def test_clean_keeps_spaces_untrimmed(spark):
    df = spark.createDataFrame([("(a)--b,,c!",)], "t string")
    assert df.select(clean_special(F.col("t")).alias("c")).first().c == " a b c "


def test_frequent_terms_join_map_side(spark):
    """A term that holds a third of the rows, rare ones and one that the fit has not seen: each row once, with its own idf."""
    from tillwise.operators.tfidf import SHARE, frequent, with_idf

    tf = spark.range(6000).select("id", F.explode(F.array(F.lit("the"), F.concat(F.lit("a"), F.col("id") % 1500), F.concat(F.lit("b"), F.col("id")))).alias("term")).select(F.col("id").alias("doc_id"), "term", F.lit(1).alias("tf"))
    idf = fit_idf(tf, 6000)
    assert [r.term for r in frequent(idf).collect()] == ["the"]
    assert frequent(idf.where("term != 'the'")).count() < SHARE
    unseen = spark.createDataFrame([(1, "new", 1)], "doc_id long, term string, tf int")
    got = with_idf(tf.union(unseen), idf)
    want = tf.join(idf, "term").select(*got.columns)
    assert got.count() == 18000 and got.exceptAll(want).count() == 0
    assert frequent(idf.limit(0)).count() == 0 and with_idf(tf, idf.limit(0)).count() == 0


def test_tfidf_matches_formula(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")
    tf = term_counts(df, "doc_id", terms(F.col("text")))
    w = {(r.doc_id, r.term): r.weight for r in tfidf(tf, fit_idf(tf, len(TEXTS))).collect()}
    docs = {i: Counter(py_terms(t)) for i, t in enumerate(TEXTS)}
    dfreq = Counter(term for c in docs.values() for term in c)
    for i, c in docs.items():
        raw = {term: n * (math.log((1 + len(TEXTS)) / (1 + dfreq[term])) + 1) for term, n in c.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for term, v in raw.items():
            assert math.isclose(w[(i, term)], v / norm, rel_tol=1e-12)


def test_unseen_terms_are_dropped(spark):
    from tillwise.operators.text_model import fit_features, transform_features
    train = spark.createDataFrame([(1, "arroz branco"), (2, "feijao preto")], "id int, text string")
    feats = fit_features(train)
    out = transform_features(feats, spark.createDataFrame([(3, "cafe torrado"), (4, "arroz torrado")],
                                                          "id int, text string")).collect()
    by_id = {r.id: r.features for r in out}
    assert by_id[3].numNonzeros() == 0          # only unseen terms: empty vector, no failure
    assert by_id[4].numNonzeros() == 1          # 'arroz' kept, 'torrado' and the bigram dropped
    assert abs(by_id[4].norm(2) - 1.0) < 1e-12


WORDS = {"bebidas": ["suco", "refrigerante", "agua", "cerveja"], "limpeza": ["sabao", "detergente", "esponja", "alvejante"],
         "padaria": ["pao", "bolo", "biscoito", "torrada"]}


def planted(spark, words=WORDS, each=40):
    rows = [(f"{v[k % len(v)]} {v[(k + 1) % len(v)]} marca {k % 7} embalagem {k % 3}", label) for label, v in words.items() for k in range(each)]
    return spark.createDataFrame([(i, t, y, i % 5 == 0) for i, (t, y) in enumerate(rows)], "id int, text string, label string, is_test boolean")


def test_classifier_planted_signal(spark):
    from tillwise.operators.text_model import LinearTexts, accuracy
    scored = LinearTexts(planted(spark), "id", "label").scored("id")
    assert accuracy(scored).first().accuracy > 0.95
    rows = scored.collect()
    assert len(rows) == 24 and all(0 < r.conf <= 1 for r in rows)


def test_classifier_odd_rows(spark):
    from tillwise.operators.text_model import LinearTexts
    odd = spark.createDataFrame([(900, None, "bebidas", False), (901, "", "padaria", True), (902, "suco agua", None, False), (903, "pao bolo", None, True), (904, "nunca visto", "limpeza", True)],
                                "id int, text string, label string, is_test boolean")
    got = {r.id: r for r in LinearTexts(planted(spark).unionByName(odd), "id", "label").scored("id").collect()}
    assert got[903].pred == "padaria" and got[903].correct is None
    assert got[901].pred == got[904].pred is not None and got[901].conf == got[904].conf
    assert 902 not in got and 900 not in got


def test_margins_over_blocks_and_class_groups(spark, monkeypatch):
    """Several blocks and groups of classes reach the optimum that one block reaches by itself."""
    import numpy as np

    from tillwise.operators import linear_margins as LM
    words = {f"c{c:02d}": [f"w{c}a", f"w{c}b", f"w{(c + 1) % 8}a"] for c in range(8)}
    rng = np.random.default_rng(3)
    rows, folds = [], 2
    for i in range(160):
        c = int(rng.integers(8))
        ts = sorted({int(t) for t in rng.choice(np.arange(1, 40), 5)} | {100 + 2 * c, 101 + 2 * ((c + 1) % 8)})
        x = rng.random(len(ts)) + 0.2
        rows.append((i, [0, *ts], [1.0, *(x / np.linalg.norm(x)).tolist()], c, i % folds))
    assert len(words) == 8
    df = spark.createDataFrame(rows, "row long, ts array<long>, xs array<double>, y int, fold int")
    # plain dual ascent to the end, one class and model at a time
    dense = np.zeros((160, 120))
    for i, ts, xs, _, _ in rows:
        dense[i, ts] = xs
    y, fold = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])

    def plain(c, use):
        sign, a, w = np.where(y == c, 1.0, -1.0), np.zeros(160), np.zeros(120)
        for _ in range(400):
            for i in np.flatnonzero(use):
                new = np.clip(a[i] + (1 - sign[i] * dense[i] @ w) / (dense[i] @ dense[i]), 0, 1)
                w += (new - a[i]) * sign[i] * dense[i]
                a[i] = new
        return w

    monkeypatch.setattr(LM, "BLOCK_TERMS", 400)
    monkeypatch.setattr(LM, "COLUMNS", 9)
    monkeypatch.setattr(LM, "TOLERANCE", 1e-4)
    fitted = LM.Margins(df, 8, folds)
    assert fitted.groups == 3
    steps = zip(fitted.progress, fitted.progress[1:], strict=False)
    assert all(after[k][0] > before[k][0] - 1e-9 for before, after in steps for k in before)  # the dual never falls
    w = np.zeros((8, 120))
    for r in fitted.weights.collect():
        w[r.cls, r.t] = r.w

    def objective(c, v, use):
        sign = np.where(y == c, 1.0, -1.0)
        return 0.5 * v @ v + np.maximum(0, 1 - sign * (dense @ v))[use].sum()
    every = np.ones(160, bool)
    for c in range(8):
        best = plain(c, every)
        least = objective(c, best, every)
        dual = fitted.progress[-1][c // 3, c % 3 * (folds + 1)][0]
        # the optimum lies between dual and objective, and the dual's distance bounds that of the weights
        assert 0.98 * least < dual < least + 1e-6 and objective(c, w[c], every) > least - 1e-6, (c, least, dual)
        assert np.sum((w[c] - best) ** 2) <= 2 * (least - dual) + 1e-6
    oof = {(r.row, r.cls): r.margin for r in fitted.out_of_fold.collect()}
    assert len(oof) == 160 * 8
    best = plain(2, fold != 1)
    mine = np.array([oof[i, 2] for i in range(160) if fold[i] == 1])
    assert np.corrcoef(mine, (dense @ best)[fold == 1])[0, 1] > 0.99


def test_platt_equals_a_plain_newton_fit(spark):
    import numpy as np

    from tillwise.operators import linear_margins as LM
    rng = np.random.default_rng(1)
    rows = [(c, float(m), float(rng.random() < 1 / (1 + np.exp(-(c + 1) * m + 0.5 * c)))) for c in range(3) for m in rng.normal(size=80)]
    rows += [(3, float(m), float(m > 0)) for m in rng.normal(size=40)] + [(4, 0.5, 0.0)] * 5  # separable; one class without members
    got = {r.cls: (r.a, r.b) for r in LM.platt(spark.createDataFrame(rows, "cls int, margin double, target double").repartition(4)).collect()}
    for c in range(5):
        m, y = (np.array([r[i] for r in rows if r[0] == c]) for i in (1, 2))
        pos, neg = y.sum(), len(y) - y.sum()
        t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
        a, b = 0.0, np.log((neg + 1) / (pos + 1))
        for _ in range(100):
            p = 1 / (1 + np.exp(np.clip(a * m + b, -30, 30)))
            g, v = np.array([((t - p) * m).sum(), (t - p).sum()]), p * (1 - p)
            h = np.array([[(v * m * m).sum(), (v * m).sum()], [(v * m).sum(), v.sum()]]) + 1e-12 * np.eye(2)
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-10:
                break
        if c < 4:
            assert np.allclose(got[c], (a, b), rtol=1e-9, atol=1e-9)
        else:  # only a * 0.5 + b is determined
            assert abs(got[c][0] * 0.5 + got[c][1] - (a * 0.5 + b)) < 1e-6


def test_bayes_scores_labels_without_shared_terms(spark):
    from tillwise.operators.naive_bayes import fit, predict
    train = spark.createDataFrame([(i, "A") for i in range(2)] + [(9, "B")], "doc_id long, label string")
    tf = spark.createDataFrame([(0, "x", 1), (0, "y", 300), (1, "z", 400), (9, "q", 1), (50, "x", 1), (51, "never", 3)], "doc_id long, term string, tf long")
    got = {r.doc_id: r for r in predict(tf, spark.createDataFrame([(50,), (51,)], "doc_id long"), *fit(tf, train)).collect()}
    # ln(2/3) + ln 2 - ln(701 + 4) against ln(1/3) - ln(1 + 4): B is likelier although it never saw the word
    a, b = 2 / 3 * 2 / 705, 1 / 3 / 5
    assert got[50].pred == "B" and math.isclose(got[50].conf, b / (a + b), rel_tol=1e-9)
    assert got[51].pred == "A" and math.isclose(got[51].conf, 2 / 3, rel_tol=1e-9)


def shuffled_columns(df):
    """The different shuffles of a plan (adaptive plans are printed twice)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sorted({line[line.index("Exchange"):].split(", [plan_id")[0] for line in plan.splitlines() if "Exchange hash" in line})


def test_term_counts_shuffle_texts_not_terms(spark):
    """Dealt by id, the (id, term) rows are counted where the texts land; repeated and null ids count as before."""
    rows = [(1, "arroz branco arroz"), (1, "arroz"), (None, "feijao preto"), (None, "feijao"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain, dealt = (term_counts(df, "doc_id", terms(F.col("text")), n) for n in (None, 3))
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))
    assert {(r.doc_id, r.term): r.tf for r in dealt.collect()}[1, "arroz"] == 3
    moves = shuffled_columns(dealt)
    assert len(moves) == 1 and "REPARTITION_BY_NUM" in moves[0]


def test_bayes_joins_labels_where_terms_were_counted(spark):
    """``tasks`` changes the plan, not the rows, with repeated and null ids; the counts themselves are not shuffled on the id."""
    from tillwise.operators.naive_bayes import classify
    words = {"A": "suco agua cerveja", "B": "sabao esponja agua", "C": "pao bolo"}
    rows = [(i % 90, f"{words[k]} n{i % 11}", k) for i in range(120) for k in [list(words)[i % 3]]] + [(None, "pao", "A"), (500, "nunca", "B"), (501, "", "C"), (502, None, "C")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = []
    for tasks in (None, 4):
        tf = term_counts(df, "doc_id", terms(F.col("text")), tasks)
        out = classify(df.select("doc_id", "lang"), tf, "doc_id", "lang", tasks=tasks)
        got.append(sorted(map(str, out.collect())))
    assert got[0] == got[1] and len(got[0]) > 20
    tf = term_counts(df, "doc_id", terms(F.col("text")), 4)
    marks = df.select("doc_id", "lang").repartition(4, "doc_id").hint("shuffle_hash")
    assert len(shuffled_columns(tf.join(marks, "doc_id"))) == 2  # texts and marks; no (id, term) row


def test_tfidf_dealt_gives_the_same_rows(spark):
    """``tasks`` bounds the parts of both shuffles; weights are worked out after the rows are back with their text."""
    rows = [(i % 50, " ".join(f"w{(i * k) % 37} comum" for k in range(1, 6))) for i in range(60)] + [(None, "comum raro"), (70, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tf = term_counts(df, "doc_id", terms(F.col("text")), 3).localCheckpoint()
    idf = fit_idf(tf, len(rows)).localCheckpoint()
    key = lambda r: (r.doc_id is None, r.doc_id, r.term)
    plain, dealt = (sorted(tfidf(tf, idf, n).collect(), key=key) for n in (None, 3))
    assert [key(r) for r in plain] == [key(r) for r in dealt] and len(plain) > 300
    assert all(math.isclose(a.weight, b.weight, rel_tol=1e-12) for a, b in zip(plain, dealt, strict=True))
    assert any("hashpartitioning(doc_id" in m and ", 3), REPARTITION_BY_NUM" in m for m in shuffled_columns(tfidf(tf, idf, 3)))


def block_documents(spark, folder):
    """A documents table with repeated, null and test ids, null and empty texts, and terms of one text alone."""
    say = {"A": "suco água cerveja", "B": "sabão esponja água", "C": "pão bolo de milho"}
    rows = [(i % 160, f"{say[k]} n{i % 13} só{i} n{i % 13} {say[k]}", k) for i in range(200) for k in [list(say)[i % 3]]]
    rows += [(None, "pão raro", "A"), (None, "pão", "B"), (500, "nunca dito", "B"), (501, "", "C"), (502, None, "C"), (7, "sem rótulo água", None), (503, "água\nsuco", None)]
    df = spark.createDataFrame([(i, t, k, "web", 0) for i, t, k in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{folder}/documents.parquet")
    return df


def test_tfidf_long_shuffles_texts_not_terms(spark, tmp_path, monkeypatch):
    """Blocks exchange document frequencies: the rows are those of the joins, and none of them is shuffled."""
    from tillwise.operators import term_blocks
    from tillwise.plans.text import tfidf_long_q

    df = block_documents(spark, tmp_path)
    tf = term_counts(df, "doc_id", terms(F.col("text"))).localCheckpoint()
    plain = tfidf(tf, fit_idf(tf, df.count()).localCheckpoint()).withColumns({c: F.round(c, 9) for c in ("idf", "weight")})
    monkeypatch.setattr(term_blocks, "BLOCK_BYTES", 900)
    assert term_blocks.TermBlocks(df.withColumnRenamed("doc_id", "id")).blocks > 5
    got = tfidf_long_q(spark, str(tmp_path))
    moves = shuffled_columns(got)
    assert moves and all("hashpartitioning(block" in m for m in moves)
    want = {(r.doc_id, r.term): r for r in plain.collect()}
    rows = got.collect()
    assert len(rows) == len(want) > 1000
    for r in rows:
        x = want[r.doc_id, r.term]
        assert (r.tf, r.df) == (x.tf, x.df) and math.isclose(r.idf, x.idf, abs_tol=2e-9) and math.isclose(r.weight, x.weight, abs_tol=2e-9)


def test_bayes_sums_by_term_between_blocks(spark, tmp_path, monkeypatch):
    """Blocks exchange label sums: the rows are those of the joins, and only texts and (document, label) rows are shuffled."""
    from tillwise.operators import naive_bayes, term_blocks
    from tillwise.plans.text import bayes_classifier_q, classifier_accuracy_q

    df = block_documents(spark, tmp_path)
    plain = naive_bayes.classify(df.select("doc_id", "lang"), term_counts(df, "doc_id", terms(F.col("text"))).localCheckpoint(), "doc_id", "lang")
    monkeypatch.setattr(term_blocks, "BLOCK_BYTES", 900)
    names, write = [], naive_bayes.saved
    monkeypatch.setattr(naive_bayes, "saved", lambda x, name, *by: names.append(name) or write(x, name, *by))
    got = sorted(map(str, bayes_classifier_q(spark, str(tmp_path)).collect()))
    assert names == ["labels", "label-scores"]  # no (document, term, label) rows
    assert got == sorted(map(str, plain.collect())) and len(got) > 20
    assert sum(r.n for r in classifier_accuracy_q(spark, str(tmp_path)).collect()) == len(got)


def test_linear_scores_keep_vectors_in_blocks(spark, tmp_path, monkeypatch):
    """Vectors, class means and margins between blocks are those of the joins, repeated ids counting as often as there; only texts are shuffled."""
    from tillwise.operators import linear_margins as LM
    from tillwise.operators import term_blocks
    from tillwise.operators.naive_bayes import split_md5
    from tillwise.plans.text import linear_scores_q

    docs = split_md5(block_documents(spark, tmp_path).where("lang is not null"), "doc_id")
    rows = docs.select(F.col("doc_id").alias("row"), F.col("lang").alias("cls"), "is_test")
    tf = term_counts(docs, "doc_id", terms(F.col("text"))).withColumnRenamed("doc_id", "row").localCheckpoint()
    train = rows.where("not is_test")
    x = LM.Vocabulary(tf.join(train.select("row"), "row"), train.count()).vectors(rows, tf).join(rows, "row").localCheckpoint()
    known = x.where("not is_test")
    sums = known.select("cls", F.explode(F.arrays_zip("ts", "xs")).alias("e")).groupBy("cls", F.col("e.ts").alias("t")).agg(F.sum("e.xs").alias("s"))
    weights = sums.join(known.groupBy("cls").agg(F.count("*").alias("n")), "cls").select("t", "cls", (F.col("s") / F.col("n")).alias("w"))
    want = {(r.row, r.cls): r.margin for r in LM.score(x.where("is_test"), weights).collect()}
    for size in (term_blocks.BLOCK_BYTES, 900):
        monkeypatch.setattr(term_blocks, "BLOCK_BYTES", size)
        got = linear_scores_q(spark, str(tmp_path))
        assert all("hashpartitioning(block" in m for m in shuffled_columns(got))
        rows = got.collect()
        assert len(rows) == len(want) > 60
        assert all(math.isclose(r.margin, want[r.doc_id, r.cls], abs_tol=2e-9) for r in rows)


def test_vectors_join_frequent_terms_map_side(spark):
    from tillwise.operators import linear_margins as LM
    rows = spark.createDataFrame([(1,), (2,), (3,)], "row long")
    tf = spark.createDataFrame([(1, "hot", 2), (2, "hot", 1), (1, "rare", 1), (2, "unknown", 4)], "row long, term string, tf long")
    vocabulary = LM.Vocabulary(tf.where("term != 'unknown'"), 3)
    plan = vocabulary.vectors(rows, tf, 2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(row" in plan
    for tasks in (None, 2):
        got = {r.row: dict(zip(r.ts, r.xs, strict=True)) for r in vocabulary.vectors(rows, tf, tasks).collect()}
        assert got[3] == {LM.BIAS: 1.0} and len(got[1]) == 3 and len(got[2]) == 2
        assert math.isclose(sum(x * x for t, x in got[1].items() if t != LM.BIAS), 1.0, rel_tol=1e-12)


def svm_rows(n=90, seed=5):
    import numpy as np
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        ts = sorted({int(t) for t in rng.choice(np.arange(1, 60), 6)} | {1000 + i, 1000 + i // 2})
        x = rng.random(len(ts)) + 0.2
        rows.append((i, [0, *ts], [1.0, *(x / np.linalg.norm(x)).tolist()], int(rng.integers(3)), i % 2))
    return rows


def test_block_moves_like_plain_coordinate_ascent(monkeypatch):
    """Margins kept by the Gram matrix, whole or a few texts at a time, give the moves that the weights give."""
    import numpy as np
    import pyarrow as pa

    from tillwise.operators import linear_margins as LM
    rows, rng = svm_rows(), np.random.default_rng(6)
    left = pa.table({name: [r[k] for r in rows] for k, name in enumerate(("row", "ts", "xs", "y", "fold"))})
    shared = np.array([0, *range(1, 60, 3), 1000, 1004, 1041])
    uses, given = rng.integers(2, 5, len(shared)), rng.normal(size=(len(shared), 9)) * 0.1
    right = pa.concat_tables([LM._table(0, 0, LM.WEIGHT, part, shared[own], uses[own], given[own]) for part, own in enumerate(LM.spread_terms(shared, 4))])
    dense = np.zeros((len(rows), 1100))
    for i, ts, xs, _, _ in rows:
        dense[i, ts] = xs
    spread, w = np.ones(1100), np.zeros((1100, 9))
    spread[shared], w[shared] = uses, given
    for side, pairs, share in ((2048, 1 << 20, 10), (17, 50, 3), (2048, 64, 1000)):
        monkeypatch.setattr(LM, "SIDE", side)
        monkeypatch.setattr(LM, "PAIRS", pairs)
        monkeypatch.setattr(LM, "DENSE", share)
        block = LM.Block(left, right, [0, 1, 2], 2)
        np.testing.assert_allclose(block.margins().T, dense @ w, atol=1e-12)
        block.ascend(3, 11)
        order, v, alpha = np.random.default_rng(11), w.copy(), np.zeros((len(rows), 9))
        for _ in range(3):
            for i in order.permutation(len(rows)):
                new = np.clip(alpha[i] + (1 - block.sign[i] * (dense[i] @ v)) / (spread * dense[i] @ dense[i]), 0, LM.COST) * block.active[i]
                v += (spread * dense[i])[:, None] * ((new - alpha[i]) * block.sign[i])[None, :]
                alpha[i] = new
        np.testing.assert_allclose(block.alpha, alpha, atol=1e-12)
        np.testing.assert_allclose(block.parts(*block.every, len(block.terms)).T, (dense.T @ (alpha * block.sign))[block.terms], atol=1e-12)


def test_blocks_exchange_rows_of_many_terms(spark, monkeypatch):
    """A round writes one row for each block and part, not one for each term; rounds that no later one reads are deleted."""
    import os

    from tillwise.operators import linear_margins as LM
    monkeypatch.setattr(LM, "BLOCK_TERMS", 300)
    monkeypatch.setattr(LM, "ROUNDS", 4)
    monkeypatch.setattr(LM, "TOLERANCE", -1.0)
    counts, paths, write = [], [], LM.saved

    def saved(df, name, *by):
        out = write(df, name, *by)
        if name == "svm-round":
            counts.append(out.where(f"kind = {LM.WEIGHT}").count())
            paths.append(out._saved)
        return out
    monkeypatch.setattr(LM, "saved", saved)
    rows = svm_rows()
    blocks = -(-sum(len(r[1]) for r in rows) // 300)
    fitted = LM.Margins(spark.createDataFrame(rows, "row long, ts array<long>, xs array<double>, y int, fold int"), 3, 2)
    assert blocks > 2 and len(counts) == 5 and all(0 < n <= blocks**2 for n in counts)
    assert [os.path.exists(p) for p in paths] == [False] * 4 + [True]
    assert fitted.weights.count() == 3 * len({t for r in rows for t in r[1]})
    assert fitted.out_of_fold.count() == 3 * len(rows)


def test_boosted_fit_has_no_more_tasks_than_cores_need():
    """every level of a tree shuffles the sums of all slots for each task, so tasks must not grow with the megabytes."""
    from tillwise.operators.text_model import BYTES_PER_TASK, GBT_BYTES_PER_TASK, classes_at_once, fit_tasks

    assert fit_tasks(0, "gbt", 12) == 1
    assert fit_tasks(3 * BYTES_PER_TASK, "gbt", 12) == fit_tasks(3 * BYTES_PER_TASK, "logreg", 12) == 4
    assert fit_tasks(1 << 30, "gbt", 12) == 12
    assert fit_tasks(1 << 30, "logreg", 12) == 1 + (1 << 30) // BYTES_PER_TASK
    for size in (1 << 33, 1 << 36):  # a task's text stays bounded
        assert size / fit_tasks(size, "gbt", 12) <= GBT_BYTES_PER_TASK
    assert classes_at_once(0) == classes_at_once(10_000) == 4
    assert classes_at_once(400_000) == 1
