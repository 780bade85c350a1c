"""Price resolution (F3, J12), catalogue and slots (J13, F4-F6), caption wrap (F7), preferences."""

import json

import pytest
from pyspark.sql import functions as F

from tillwise.operators import flyer as FL


def test_resolve_prices_cases(spark):
    req = spark.createDataFrame([(1, c) for c in ["p1", "p2", "p3", "p4", "s1", "s2", "s3", "s4"]],
                                "codcli long, codmersrr string")
    body = {
        "resultado": [
            {"codigoMercadoria": "p1", "precos": [{"precoNormal": 10.0, "precoCaixa": 100.0}]},
            {"codigoMercadoria": "p2", "precos": [{"precoNormal": 0.0, "precoCaixa": 50.0}]},
            {"codigoMercadoria": "p3", "precos": [{"precoNormal": 7.0}]},
            {"codigoMercadoria": "p3", "precos": [{"precoNormal": 9.0}]},
            {"codigoMercadoria": "s3", "precos": [{"precoNormal": 5.0, "precoCaixa": 0.0}]},
        ],
        "lstPrecoSeller": [
            {"codigoMercadoria": "s1", "preco": 3.0}, {"codigoMercadoria": "s1", "preco": 4.0},
            {"codigoMercadoria": "s2", "preco": 0.0}, {"codigoMercadoria": "s3", "preco": 8.0},
        ],
    }
    resp = spark.createDataFrame([(1, 0, json.dumps(body))], "codcli long, page int, body string")
    got = {r.codmersrr: (r.preco, r.preco_cx, r.status) for r in FL.resolve_prices(req, resp).collect()}
    assert got["p1"] == (10.0, 100.0, "priced")
    assert got["p2"] == (None, 50.0, "zero")          # unit 0 -> not found, box price kept
    assert got["p3"] == (7.0, None, "priced")         # first duplicate wins; absent box -> NULL
    assert got["p4"] == (None, None, "missing")
    assert got["s1"] == (3.0, None, "priced")
    assert got["s2"] == (None, None, "zero")
    assert got["s3"] == (5.0, None, "priced")         # 1P entry overrides 3P; box 0 -> NULL
    assert got["s4"] == (None, None, "missing")


def test_resolve_prices_parses_each_answer_once(spark):
    """Both lists come from one pass; a missing list, a null entry and an empty answer are no entries."""
    req = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a"), (4, "a")], "codcli long, codmersrr string")
    bodies = [(1, 1, '{"resultado": [{"codigoMercadoria": "a", "precos": []}], "lstPrecoSeller": [{"codigoMercadoria": "b", "preco": 2.0}]}'),
              (1, 0, '{"lstPrecoSeller": [null, {"codigoMercadoria": "b", "preco": 3.0}]}'),
              (2, 0, '{"resultado": [{"codigoMercadoria": "a", "precos": [{"precoNormal": 4.0, "precoCaixa": 9.0}]}]}'), (3, 0, "{}"), (4, 0, None)]
    out = FL.resolve_prices(req, spark.createDataFrame(bodies, "codcli long, page int, body string"))
    got = {(r.codcli, r.codmersrr): (r.preco, r.preco_cx, r.status) for r in out.collect()}
    assert got == {(1, "a"): (None, None, "zero"), (1, "b"): (3.0, None, "priced"), (2, "a"): (4.0, 9.0, "priced"),
                   (3, "a"): (None, None, "missing"), (4, "a"): (None, None, "missing")}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def py_wrap(desc, width=FL.CAPTION_WIDTH, n=FL.CAPTION_LINES):
    lines, cur = [""] * n, 0
    for w in desc.upper().split(" "):
        test = (lines[cur] + " " + w).strip() if lines[cur] else w
        if len(test) <= width:
            lines[cur] += " " + w if lines[cur] else w
        else:
            cur += 1
            if cur >= n:
                break
            lines[cur] = w
    return [x.strip() for x in lines]


@pytest.mark.parametrize("text", [
    "123 - arroz branco tipo 1 pacote 5kg fardo com 6 unidades marca boa qualidade extra longa",
    "9 - supercalifragilisticexpialidocious-word-too-wide-for-a-line short",
    "1 - a", "", "two  spaces here"])
def test_wrap_matches_python(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert list(df.select(FL.wrap_caption(F.col("t")).alias("l")).first().l) == py_wrap(text)


def test_flyer_takes_first_eight_valid(spark):
    best = spark.createDataFrame(
        [(1, f"intenal_{k}", k, float(100 - k)) for k in range(12)], "codcli long, codmersrr string, partkey long, qty double")
    cat = spark.createDataFrame([(f"intenal_{k}", f"prod {k}", f"http://i/{k}.jpeg") for k in range(12)]
                                + [("intenal_3", "dup", "http://i/dup.jpeg")],
                                "idproduto string, descproduto string, url_imagem string")
    prices = spark.createDataFrame(
        [(1, f"intenal_{k}", None if k in (1, 4) else float(k + 1), None, "zero" if k in (1, 4) else "priced")
         for k in range(12)], "codcli long, codmersrr string, preco double, preco_cx double, status string")
    slots = spark.createDataFrame([(f"{kind}_{i}", i, i) for i in range(1, 9) for kind in ("imagem", "nome", "preco")],
                                  "name string, x int, y int")
    feed = FL.flyer_feed(best, cat, prices, slots).orderBy("slot").collect()
    assert [r.codmersrr for r in feed] == [f"intenal_{k}" for k in (0, 2, 3, 5, 6, 7, 8, 9)]
    assert feed[0].price_text == "R$1.0 und | R$1.0 cx"
    assert feed[0].url_imagem == "http://i/0100x"
    assert feed[0].coluna == "left" and feed[1].coluna == "right"
    assert feed[2].caption == "3 - dup"  # duplicate catalogue id: one row kept


def test_preferences_missing_fields(spark):
    bodies = [(1, json.dumps({"listCustomerRestriction": [{"fil_delivery": "rio", "ufFilialFaturamento": "rj"}],
                              "lstCondicoesPamento": []})),
              (2, json.dumps({"listCustomerRestriction": [], "lstCondicoesPamento": [{"CODIGO_CONDICAO": "C1"}]}))]
    got = {r.codcli: r for r in FL.ingest_preferences(spark.createDataFrame(bodies, "codcli long, body string")).collect()}
    assert (got[1].fil_entrega, got[1].uf_faturamento, got[1].cond_pagamento) == ("RIO", "RJ", "")
    assert (got[2].fil_entrega, got[2].cond_pagamento) == ("", "C1")


def test_slot_table_from_json(spark):
    cfg = spark.createDataFrame([(json.dumps({"imagem_1": [10, 20], "nome_1": [30, 40]}),)], "value string")
    got = sorted(tuple(r) for r in FL.slot_table_from_json(cfg).collect())
    assert got == [("imagem_1", 10, 20), ("nome_1", 30, 40)]


def test_missing_slot_drops_that_position(spark):
    best = spark.createDataFrame([(1, f"intenal_{k}", k, float(100 - k)) for k in range(3)],
                                 "codcli long, codmersrr string, partkey long, qty double")
    cat = spark.createDataFrame([(f"intenal_{k}", f"p{k}", f"http://i/{k}.jpeg") for k in range(3)],
                                "idproduto string, descproduto string, url_imagem string")
    prices = spark.createDataFrame([(1, f"intenal_{k}", 1.0, None, "priced") for k in range(3)],
                                   "codcli long, codmersrr string, preco double, preco_cx double, status string")
    slots = spark.createDataFrame([(f"{kind}_{i}", i, i) for i in (1, 3) for kind in ("imagem", "nome", "preco")],
                                  "name string, x int, y int")
    assert [(r.slot, r.codmersrr) for r in FL.flyer_feed(best, cat, prices, slots).orderBy("slot").collect()] == \
        [(1, "intenal_0"), (3, "intenal_2")]


def test_flyer_with_rank_order_from_catalog(spark, tmp_path):
    from tillwise.sources.tables import read_best_sellers_table, read_catalogue_table
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tw_fly LOCATION '{tmp_path}/fly'")
    spark.createDataFrame([(1, "intenal_5", 2), (1, "intenal_7", 1)], "CODCLI long, CODMERSRR string, POS int") \
        .write.mode("overwrite").saveAsTable("tw_fly.mais_vendidos")
    spark.createDataFrame([("intenal_5", "cinco", "http://i/5.jpeg"), ("intenal_7", "sete", "http://i/7.jpeg")],
                          "IDPRODUTO string, DESCPRODUTO string, URL_IMAGEM string") \
        .write.mode("overwrite").saveAsTable("tw_fly.sup_produtos")
    best = read_best_sellers_table(spark, "tw_fly.mais_vendidos", "POS")
    prices = spark.createDataFrame([(1, "intenal_5", 2.0, None, "priced"), (1, "intenal_7", 3.0, None, "priced")],
                                   "codcli long, codmersrr string, preco double, preco_cx double, status string")
    slots = spark.createDataFrame([(f"{k}_{i}", i, i) for i in (1, 2) for k in ("imagem", "nome", "preco")],
                                  "name string, x int, y int")
    feed = FL.flyer_feed(best, read_catalogue_table(spark, "tw_fly.sup_produtos"), prices, slots,
                         order=[F.col("rank")]).orderBy("slot").collect()
    assert [r.codmersrr for r in feed] == ["intenal_7", "intenal_5"]


def test_price_request_has_all_fields(spark):
    paged = spark.createDataFrame([(1, 0, "intenal_5", 5, 2.0), (1, 0, "loja_7", 7, 9.0)],
                                  "codcli long, page int, codmersrr string, partkey long, qty double")
    paged = paged.select("*", *FL.party_columns(F.col("codmersrr")))
    prefs = spark.createDataFrame([], "codcli long, uf_faturamento string, cond_pagamento string, "
                                      "wh_delivery string, wh_billing string")
    body = json.loads(FL.price_requests(paged, prefs).first().request)
    assert list(body) == list(FL.REQUEST_FIELDS) and len(body) == 38
    assert body["produtos"] == [{"CodigoMercadoria": "intenal_5", "Quantidade": 1, "codGroupMerFrac": 0}]
    assert body["produtosSeller"] == [{"CodigoMercadoria": "loja_7", "Quantidade": 1, "seller": "loja"}]
    assert body["CODBRRUNDVNDCSM"] is None and body["listaProdutosEdl"] == [] and body["ufTarget"] == ""


@pytest.mark.parametrize("value, text", [(10.5, "10.5"), (1.0, "1.0"), (12345678.0, "12345678.0"), (0.01, "0.01"), (100.0, "100.0")])
def test_plain_numbers(spark, value, text):
    assert spark.createDataFrame([(value,)], "x double").select(FL.plain_number(F.col("x")).alias("t")).first().t == text


def test_flyer_footer_and_lines(spark):
    best = spark.createDataFrame([(1, "intenal_5", 5, 9.0), (2, "intenal_5", 5, 9.0)], "codcli long, codmersrr string, partkey long, qty double")
    cat = spark.createDataFrame([("intenal_5", "arroz branco tipo 1 pacote 5kg", "http://i/5.jpeg")],
                                "idproduto string, descproduto string, url_imagem string")
    prices = spark.createDataFrame([(c, "intenal_5", 2.0, None, "priced") for c in (1, 2)],
                                   "codcli long, codmersrr string, preco double, preco_cx double, status string")
    slots = spark.createDataFrame([(f"{k}_1", 1, 1) for k in ("imagem", "nome", "preco")], "name string, x int, y int")
    prefs = spark.createDataFrame([(1, "C1", " - 30 dias", "RIO", "RJ")],
                                  "codcli long, cond_pagamento string, desc_pagamento string, fil_entrega string, uf_faturamento string")
    one, two = FL.flyer_feed(best, cat, prices, slots, prefs=prefs).orderBy("codcli").collect()
    assert [one[f"linha_{i}"] for i in range(1, 5)] == py_wrap("5 - arroz branco tipo 1 pacote 5kg")
    assert one.rodape_pagamento == "Condição de Pagamento: C1 - 30 dias"
    assert one.rodape_filial == "Vendido por RIO e faturado por RJ"
    assert two.rodape_filial == "Vendido por  e faturado por "  # a customer without preferences
