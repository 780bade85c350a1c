"""Per-customer best-seller flyer feed.

One batch job over all customers instead of one call per customer:

* best sellers: (customer, product) quantities from a single join + aggregate;
* price requests are paged: each customer's products are spread over pages of
  about ``page_size`` products (by a hash of the product), so a request - and
  the group that builds it - stays bounded however many products one
  customer bought;
* landed responses are parsed with ``from_json``; the first entry per product
  wins (by position), and an own-product (1P) entry overrides a seller (3P)
  entry for the same product;
* the flyer takes the first eight *valid* products per customer with a
  ``row_number() <= 8`` filter, which Spark turns into a partial per-task
  top-k before the shuffle, so no customer's list is sorted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Prefix marking own (1P) products - spelled as the product ids
# spell it - and the fields of a price request in the service's order.
OWN_PREFIX = "intenal"
REQUEST_ORIGIN = "CRT"
FILLED = object()  # taken from the customer or the products
REQUEST_FIELDS = {
    "origemChamada": REQUEST_ORIGIN,
    "uid": FILLED,
    "cupons_novos": [],
    "segment": 0,
    "tipoLimiteCred": "",
    "precoEspecial": "",
    "territorioRca": 0,
    "ie": "",
    "classEstadual": 0,
    "tipoSituacaoJuridica": "",
    "codSegNegCliTer": 0,
    "email": "@",
    "tipoConsulta": 1,
    "numberSpinPrice": "0",
    "codeDeliveryRegion": "0",
    "commercialActivity": 0,
    "group": 0,
    "codCidade": 0,
    "codCidadeEntrega": 0,
    "codRegiaoPreco": 0,
    "temVendor": "",
    "codigoCanal": 0,
    "ufTarget": FILLED,
    "ufFilialFaturamento": "",
    "bu": 0,
    "manual": "N",
    "produtos": FILLED,
    "asm": 0,
    "produtosSeller": FILLED,
    "condicaoPagamento": FILLED,
    "ProdutosExclusaoEan": [],
    "CODBRRUNDVNDCSM": None,
    "codeWarehouseDelivery": FILLED,
    "codeWarehouseBilling": FILLED,
    "codeDeliveryMode": 0,
    "codopdtrcetn": 0,
    "codVrsSis": 0,
    "listaProdutosEdl": [],
}
MAX_PRODUCTS = 8
CAPTION_LINES = 4
# Caption width re-aimed from font pixels (127 px) to characters.
CAPTION_WIDTH = 22

FOOTER_FIELDS = ("cond_pagamento", "desc_pagamento", "fil_entrega", "uf_faturamento")

PRICED, ZERO, MISSING = "priced", "zero", "missing"
# The two "price not found" texts - a zero price from the
# service, and a product the service did not answer for.
ZERO_PRICE_TEXT = "Preço não encontrado"
MISSING_PRICE_TEXT = "preço não encontrado"

PRICE_RESPONSE_SCHEMA = T.StructType([
    T.StructField("resultado", T.ArrayType(T.StructType([
        T.StructField("codigoMercadoria", T.StringType()),
        T.StructField("precos", T.ArrayType(T.StructType([
            T.StructField("precoNormal", T.DoubleType()),
            T.StructField("precoCaixa", T.DoubleType()),
        ]))),
    ]))),
    T.StructField("lstPrecoSeller", T.ArrayType(T.StructType([
        T.StructField("codigoMercadoria", T.StringType()),
        T.StructField("preco", T.DoubleType()),
    ]))),
])

PREFERENCE_SCHEMA = T.StructType([
    T.StructField("listCustomerRestriction", T.ArrayType(T.StructType([
        T.StructField("fil_delivery", T.StringType()),
        T.StructField("ufFilialFaturamento", T.StringType()),
        T.StructField("codeWarehouseBilling", T.StringType()),
        T.StructField("codeWarehouseDelivery", T.StringType()),
    ]))),
    T.StructField("lstCondicoesPamento", T.ArrayType(T.StructType([
        T.StructField("CODIGO_CONDICAO", T.StringType()),
        T.StructField("observacao", T.StringType()),
    ]))),
])


# --------------------------------------------------------------------------- F1 / F2
def party_columns(product: Column) -> list[Column]:
    """1P/3P split; seller = text before the first '_' for 3P; quantity 1."""
    own = product.startswith(OWN_PREFIX)
    return [
        F.when(own, F.lit("1P")).otherwise(F.lit("3P")).alias("party"),
        F.when(own, F.lit(None).cast("string")).otherwise(F.split(product, "_").getItem(0)).alias("seller"),
        F.lit(1).alias("quantidade"),
        F.when(own, F.lit(0)).alias("codGroupMerFrac"),
    ]


def product_hash(product: Column) -> Column:
    """Portable 32-bit hash of a product id: the first 8 hex digits of its MD5."""
    return F.conv(F.substring(F.md5(product), 1, 8), 16, 10).cast("long")


def assign_pages(best: DataFrame, page_size: int = 50) -> DataFrame:
    """Page number per (customer, product): ceil(n / page_size) pages per customer, product hashed."""
    counts = best.groupBy("codcli").agg(F.count(F.lit(1)).alias("_n"))
    pages = F.greatest(F.ceil(F.col("_n") / page_size), F.lit(1))
    return (best.join(counts, "codcli")
            .withColumn("page", F.pmod(product_hash(F.col("codmersrr")), pages).cast("int"))
            .drop("_n"))


def price_requests(paged: DataFrame, prefs: DataFrame) -> DataFrame:
    """one JSON request per (customer, page); product lists in best-seller order."""
    item = F.struct(
        (-F.col("qty")).alias("_k1"), F.col("partkey").alias("_k2"),
        F.col("codmersrr").alias("CodigoMercadoria"), F.col("quantidade").alias("Quantidade"),
        F.col("codGroupMerFrac"), F.col("seller"))
    own = F.col("party") == "1P"
    grouped = paged.groupBy("codcli", "page").agg(
        F.array_sort(F.collect_list(F.when(own, item))).alias("_p1"),
        F.array_sort(F.collect_list(F.when(~own, item))).alias("_p3"))
    j = grouped.join(prefs, "codcli", "left")

    def strip(arr: str, fields: list[str]) -> Column:
        return F.transform(F.col(arr), lambda s: F.struct(*[s[f].alias(f) for f in fields]))

    def given(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    filled = {
        "uid": F.col("codcli"),
        "ufTarget": given("uf_faturamento"),
        "produtos": strip("_p1", ["CodigoMercadoria", "Quantidade", "codGroupMerFrac"]),
        "produtosSeller": strip("_p3", ["CodigoMercadoria", "Quantidade", "seller"]),
        "condicaoPagamento": given("cond_pagamento"),
        "codeWarehouseDelivery": given("wh_delivery"),
        "codeWarehouseBilling": given("wh_billing"),
    }

    def constant(value) -> Column:
        if value is None:
            return F.lit(None).cast("string")
        return F.array().cast("array<string>") if value == [] else F.lit(value)

    body = F.struct(*[(filled[name] if value is FILLED else constant(value)).alias(name)
                      for name, value in REQUEST_FIELDS.items()])
    return j.select("codcli", "page", F.size("_p1").alias("n_1p"), F.size("_p3").alias("n_3p"),
                    F.to_json(body, {"ignoreNullFields": "false"}).alias("request"))


# --------------------------------------------------------------------------- S7 / S8 / F3 / J12
def ingest_preferences(responses: DataFrame) -> DataFrame:
    """First restriction and first payment condition; upper-cased; missing -> ''."""
    r = F.from_json(F.col("body"), PREFERENCE_SCHEMA)
    first_r = F.get(r["listCustomerRestriction"], 0)
    first_c = F.get(r["lstCondicoesPamento"], 0)
    return responses.select(
        "codcli",
        F.coalesce(F.upper(first_r["fil_delivery"]), F.lit("")).alias("fil_entrega"),
        F.coalesce(F.upper(first_r["ufFilialFaturamento"]), F.lit("")).alias("uf_faturamento"),
        F.coalesce(first_r["codeWarehouseBilling"], F.lit("")).alias("wh_billing"),
        F.coalesce(first_r["codeWarehouseDelivery"], F.lit("")).alias("wh_delivery"),
        F.coalesce(first_c["CODIGO_CONDICAO"], F.lit("")).alias("cond_pagamento"),
        F.coalesce(first_c["observacao"], F.lit("")).alias("desc_pagamento"),
    )


def _entries(field: str, own: bool, normal, box) -> Column:
    """One response list as (own, pos, codmersrr, normal, box); a missing list has no entries."""
    none = F.array().cast("array<struct<own:boolean,pos:int,codmersrr:string,normal:double,box:double>>")
    return F.coalesce(F.transform(F.col(f"r.{field}"), lambda e, i: F.struct(
        F.lit(own).alias("own"), i.alias("pos"), e["codigoMercadoria"].alias("codmersrr"), normal(e).alias("normal"), box(e).alias("box"))), none)


def resolve_prices(requested: DataFrame, responses: DataFrame) -> DataFrame:
    """F3 + J12: (codcli, codmersrr) -> preco, preco_cx, status (priced / zero / missing).

    A 1P entry wins over a 3P entry for the same product.  Price 0 -> no unit
    price (status 'zero') but the box price is kept; box price 0 or absent ->
    NULL.  Products absent from both lists are 'missing'.
    """
    parsed = responses.select("codcli", "page", F.from_json("body", PRICE_RESPONSE_SCHEMA).alias("r"))
    # both lists of an answer in one pass, so each body is built and parsed once
    own = _entries("resultado", True, lambda e: F.get(e["precos"], 0)["precoNormal"], lambda e: F.get(e["precos"], 0)["precoCaixa"])
    sold = _entries("lstPrecoSeller", False, lambda e: e["preco"], lambda e: F.lit(None).cast("double"))
    first = F.struct("page", F.col("e.pos"))
    payload = F.struct(F.col("e.normal"), F.col("e.box"))
    keys = ["codcli", "codmersrr"]
    prices = (parsed.select("codcli", "page", F.explode(F.concat(own, sold)).alias("e"))
              .groupBy("codcli", F.col("e.codmersrr").alias("codmersrr"))
              .agg(F.min_by(payload, F.when(F.col("e.own"), first)).alias("p1"), F.min_by(payload, F.when(~F.col("e.own"), first)).alias("p3")))
    j = requested.select(*keys).join(prices, keys, "left")
    hit1, hit3 = F.col("p1").isNotNull(), F.col("p3").isNotNull()
    unit = F.when(hit1, F.col("p1.normal")).when(hit3, F.col("p3.normal"))
    box = F.when(hit1, F.coalesce(F.col("p1.box"), F.lit(0.0)))
    status = (F.when(~hit1 & ~hit3, F.lit(MISSING))
              .when(F.coalesce(unit, F.lit(0.0)) == 0, F.lit(ZERO)).otherwise(F.lit(PRICED)))
    return j.select(*keys,
                    F.when(status == PRICED, unit).alias("preco"),
                    F.when(box != 0, box).alias("preco_cx"),
                    status.alias("status"))


# --------------------------------------------------------------------------- S6 / J13 / F4-F7
def slot_table_from_json(config: DataFrame, col: str = "value") -> DataFrame:
    """A JSON object {slot name: [x, y]} per row -> (name, x, y)."""
    m = F.from_json(F.col(col), T.MapType(T.StringType(), T.ArrayType(T.IntegerType())))
    return config.select(F.explode(m).alias("name", "xy")).select(
        "name", F.col("xy")[0].alias("x"), F.col("xy")[1].alias("y"))


def slots_by_index(slots: DataFrame) -> DataFrame:
    """(name, x, y) rows -> one row per slot number with image, name and price positions."""
    parsed = slots.select(
        F.regexp_extract("name", "^(imagem|nome|preco)_(\\d+)$", 1).alias("kind"),
        F.regexp_extract("name", "^(imagem|nome|preco)_(\\d+)$", 2).alias("k"), "x", "y"
    ).where(F.col("kind") != "")
    return parsed.groupBy(F.col("k").cast("int").alias("slot")).agg(*[
        F.max(F.when(F.col("kind") == kind, F.col(axis))).alias(f"{kind}_{axis}")
        for kind in ("imagem", "nome", "preco") for axis in ("x", "y")])


def dedupe_catalogue(catalogue: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per product id; the first by ``order_col`` (else smallest description) wins."""
    order = F.col(order_col) if order_col else F.struct("descproduto", "url_imagem")
    payload = F.struct("descproduto", "url_imagem")
    return (catalogue.groupBy("idproduto").agg(F.min_by(payload, order).alias("v"))
            .select("idproduto", "v.*"))


def plain_number(x: Column) -> Column:
    """A double in plain decimal notation with at least one decimal (10.5, 12000000.0)."""
    return F.regexp_replace(x.cast("decimal(38,10)").cast("string"), "(\\.[0-9]+?)0+$", "$1")


def price_text(preco: Column, preco_cx: Column, status: Column) -> Column:
    """'R$<unit> und | R$<box> cx' (box falls back to unit); unpriced -> status text."""
    unit = plain_number(preco)
    box = plain_number(F.coalesce(preco_cx, preco))
    return (F.when(preco.isNotNull(), F.concat(F.lit("R$"), unit, F.lit(" und | R$"), box, F.lit(" cx")))
            .when(status == MISSING, F.lit(MISSING_PRICE_TEXT)).otherwise(F.lit(ZERO_PRICE_TEXT)))


def flyer_feed(best: DataFrame, catalogue: DataFrame, prices: DataFrame, slots: DataFrame,
               keep_missing: bool = False, order: list[Column] | None = None,
               prefs: DataFrame | None = None) -> DataFrame:
    """First eight valid products per customer with slot, caption (whole and wrapped to
    lines), price text, image URL.  ``prefs`` (one row per customer, ``ingest_preferences``)
    adds the flyer's footer: payment condition, and delivery and billing branch.

    Valid = priced.  ``keep_missing=True`` also keeps products absent from the
    price response (the behaviour of the original, whose two spellings of
    "price not found" let them through).
    """
    cat = dedupe_catalogue(catalogue)
    keys = ["codcli", "codmersrr"]
    p = (best.join(cat, best["codmersrr"] == cat["idproduto"]).drop("idproduto")
         .join(prices, keys, "left")
         .withColumn("status", F.coalesce(F.col("status"), F.lit(MISSING))))
    valid = (F.col("status") == PRICED) | ((F.col("status") == MISSING) if keep_missing else F.lit(False))
    # best-seller order: quantity, then part key; a list stored as ranks passes ``order=[F.col("rank")]``
    order = order or [F.col("qty").desc(), F.col("partkey").asc()]
    w = Window.partitionBy("codcli").orderBy(*order)
    top = (p.where(valid).withColumn("slot", F.row_number().over(w))
           .where(F.col("slot") <= MAX_PRODUCTS))
    url = F.concat(F.expr("substring(url_imagem, 1, length(url_imagem) - 5)"), F.lit("100x"))
    caption = F.concat(F.element_at(F.split("codmersrr", "_"), 2), F.lit(" - "), F.col("descproduto"))
    lines = wrap_caption(caption)
    footer = []
    if prefs is not None:
        top = top.join(prefs.select("codcli", *FOOTER_FIELDS), "codcli", "left")
        pay, text, sold, billed = (F.coalesce(F.col(c), F.lit("")) for c in FOOTER_FIELDS)
        footer = [F.concat(F.lit("Condição de Pagamento: "), pay, text).alias("rodape_pagamento"),
                  F.concat(F.lit("Vendido por "), sold, F.lit(" e faturado por "), billed).alias("rodape_filial")]
    placed = top.withColumn("_lines", lines).join(F.broadcast(slots_by_index(slots)), "slot")
    return placed.select(
        "codcli", "slot", "codmersrr",
        caption.alias("caption"),
        *[F.col("_lines")[i].alias(f"linha_{i + 1}") for i in range(CAPTION_LINES)],
        price_text(F.col("preco"), F.col("preco_cx"), F.col("status")).alias("price_text"),
        "preco", "preco_cx",
        url.alias("url_imagem"),
        F.when(F.col("slot") % 2 == 1, F.lit("left")).otherwise(F.lit("right")).alias("coluna"),
        *[F.col(f"{k}_{a}") for k in ("imagem", "nome", "preco") for a in ("x", "y")],
        *footer,
    )


def wrap_caption(text: Column, width: int = CAPTION_WIDTH, lines: int = CAPTION_LINES) -> Column:
    """upper-case greedy line fill; a word that does not fit opens the next line
    (even when it is wider than a line); words after the last line are dropped."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("line"))

    def add(state, word):
        longer = F.when(state["line"] == "", word).otherwise(F.concat_ws(" ", state["line"], word))
        more = F.struct(state["done"].alias("done"), longer.alias("line"))
        full = F.struct(F.array_append(state["done"], state["line"]).alias("done"), word.alias("line"))
        return F.when(F.length(F.trim(longer)) <= width, more).otherwise(full)

    def padded(state):
        filled = F.concat(state["done"], F.array(state["line"]), F.array_repeat(F.lit(""), lines))
        return F.transform(F.slice(filled, 1, lines), lambda x: F.trim(x))

    return F.aggregate(F.split(F.upper(text), " "), start, add, padded)
