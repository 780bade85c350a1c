"""Job inputs derived from the supplied tables (FIXTURES.md part C).

The jobs are written against the shapes their production sources have
(transactions, client dimension, billing usage, SCD2 price list, best-seller
list, product catalogue, landed service responses).  These functions build
those shapes from the TPC-H-like test tables with plain projections and
aggregates, so every job's work grows with the supplied data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.calendar import yyyymm
from tillwise.sources.tables import Tables

SMART = "SMART"
VAREJO = "VAREJO ALIMENTAR"
PIX = "Compra Pix"


def transactions(t: Tables) -> DataFrame:
    """store, anomes (yyyyMM int), data_trn (yyyyMMdd string), tipo, valor decimal.

    valor casts both factors to decimal(18,2) before multiplying, so sums are
    exact and independent of the order rows are added in.
    """
    li = t.lineitem
    return li.select(
        F.col("l_suppkey").alias("store"),
        yyyymm(F.col("l_shipdate")).alias("anomes"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("data_trn"),
        F.when(F.col("l_returnflag") == "A", F.lit(PIX)).otherwise(F.lit("Compra Cartao")).alias("tipo"),
        (F.col("l_extendedprice").cast("decimal(18,2)")
         * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)"))).alias("valor"),
    )


def client_dim(t: Tables) -> DataFrame:
    """codcliend, segment: ASIA -> SMART, AMERICA/EUROPE -> VAREJO ALIMENTAR, else region name."""
    seg = (F.when(F.col("r_name") == "ASIA", F.lit(SMART))
           .when(F.col("r_name").isin("AMERICA", "EUROPE"), F.lit(VAREJO))
           .otherwise(F.col("r_name")))
    return (t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("s_suppkey").alias("codcliend"), seg.alias("segment")))


# Billing SKU names given to each event type (the usage rows
# stand in for billing usage).  Chosen so that every SKU-family rule fires,
# including a name that contains two rule words.
SKU_BY_EVENT = {
    "view": "STANDARD_ALL_PURPOSE_COMPUTE",
    "click": "PREMIUM_JOBS_COMPUTE",
    "error": "PREMIUM_DLT_ADVANCED_COMPUTE",
    "purchase": "PREMIUM_SQL_PRO_COMPUTE",
    "signup": "PREMIUM_SERVERLESS_REAL_TIME_INFERENCE",
}
SKU_ODD_PURCHASE = "PREMIUM_JOBS_SQL_COMPUTE"
SKU_ODD_SIGNUP = "ENTERPRISE_NETWORKING"
STORAGE_SKU = "PREMIUM_STORAGE"


def _sku_name() -> F.Column:
    by_event = F.create_map(*[x for k, v in SKU_BY_EVENT.items() for x in (F.lit(k), F.lit(v))])
    odd = F.col("user_id") % 2 == 1
    return (F.when((F.col("event_type") == "purchase") & odd, F.lit(SKU_ODD_PURCHASE))
            .when((F.col("event_type") == "signup") & odd, F.lit(SKU_ODD_SIGNUP))
            .otherwise(by_event[F.col("event_type")]))


def usage(t: Tables) -> DataFrame:
    """Billing usage: one DBU row per event (one hour long), plus one storage row
    ('GB', a whole day) per workspace and day with the day's event count as volume."""
    ev = t.events
    workspace = F.concat(F.lit("ws"), (F.col("user_id") % 4).cast("string"))
    compute = ev.select(
        workspace.alias("workspace_id"),
        F.to_date("ts").alias("usage_date"),
        _sku_name().alias("sku_name"),
        F.col("value").cast("decimal(18,2)").alias("usage_quantity"),
        F.lit("AWS").alias("cloud"),
        F.col("ts").alias("usage_start_time"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("usage_end_time"),
        F.lit("DBU").alias("usage_unit"),
    )
    storage = (ev.groupBy(workspace.alias("workspace_id"), F.to_date("ts").alias("usage_date"))
               .agg(F.count(F.lit(1)).cast("decimal(18,2)").alias("usage_quantity"))
               .select("workspace_id", "usage_date", F.lit(STORAGE_SKU).alias("sku_name"), "usage_quantity",
                       F.lit("AWS").alias("cloud"), F.col("usage_date").cast("timestamp").alias("usage_start_time"),
                       F.date_add("usage_date", 1).cast("timestamp").alias("usage_end_time"),
                       F.lit("GB").alias("usage_unit")))
    return compute.unionByName(storage)


def list_prices(t: Tables) -> DataFrame:
    """SCD2 price list: weekly average quantity per SKU as the price; open-ended last row.

    Aggregated to (cloud, sku, week) first, so the ``lead`` window runs over a
    few rows per SKU, never over the events themselves.
    """
    u = usage(t).where(F.col("usage_unit") == "DBU")
    weekly = (u.groupBy("cloud", "sku_name", F.date_trunc("week", "usage_start_time").alias("price_start_time"))
              .agg(F.round(F.avg(F.col("usage_quantity").cast("double")) / 100, 4).alias("p")))
    w = Window.partitionBy("cloud", "sku_name").orderBy("price_start_time")
    return weekly.select(
        "cloud", "sku_name", "price_start_time",
        F.lead("price_start_time").over(w).alias("price_end_time"),
        F.struct(F.col("p").cast("decimal(12,4)").alias("default")).alias("pricing"),
    )


def product_id(partkey: F.Column) -> F.Column:
    """Catalogue id: own products 'intenal_<key>' (even keys), sellers 'seller<k>_<key>'."""
    key = partkey.cast("string")
    return F.when(partkey % 2 == 0, F.concat(F.lit("intenal_"), key)).otherwise(
        F.concat(F.lit("seller"), (partkey % 7).cast("string"), F.lit("_"), key))


def catalogue(t: Tables) -> DataFrame:
    """idproduto, descproduto, url_imagem (one per part)."""
    p = t.part
    return p.select(
        product_id(F.col("p_partkey")).alias("idproduto"),
        F.concat_ws(" ", F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("descproduto"),
        F.concat(F.lit("https://img.example/p/"), F.col("p_partkey").cast("string"), F.lit(".jpeg")).alias("url_imagem"),
    )


def slots(spark, n: int = 8) -> DataFrame:
    """Slot layout: image/name/price positions for ``n`` products, two columns."""
    k = F.col("id") + 1
    left = (F.col("id") % 2) == 0
    x = F.when(left, F.lit(40)).otherwise(F.lit(300))
    y = (F.floor(F.col("id") / 2) * 180 + 120).cast("int")
    base = spark.range(n)
    return base.select(F.inline(F.array(
        F.struct(F.concat(F.lit("imagem_"), k.cast("string")).alias("name"), x.alias("x"), y.alias("y")),
        F.struct(F.concat(F.lit("nome_"), k.cast("string")).alias("name"), (x + 95).alias("x"), y.alias("y")),
        F.struct(F.concat(F.lit("preco_"), k.cast("string")).alias("name"), x.alias("x"), (y + 110).alias("y")),
    )))


def slot_config(spark) -> DataFrame:
    """The slot layout as it is stored: one JSON object {slot name: [x, y]}."""
    entry = F.struct("name", F.array("x", "y").alias("xy"))
    return slots(spark).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))


def scored_labels(t: Tables) -> DataFrame:
    """Scored-text stand-in: truth = quality label, confidence a fixed arithmetic of doc_id.

    Confidences are multiples of 0.001, so some equal a sweep threshold exactly.
    """
    lab = t.labels
    conf = F.pmod(F.col("doc_id") * 7919 + F.col("quality") * 400, F.lit(1000)).cast("double") / 1000
    return lab.select("doc_id", F.col("quality").alias("truth"), conf.alias("conf"))


def best_sellers(t: Tables) -> DataFrame:
    """(codcli, codmersrr, partkey, qty): quantity bought per customer and product.

    The ranking is (qty desc, partkey asc); it is applied where needed (top-k),
    never as a full sort of one customer's list.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    od = t.orders.select("o_orderkey", "o_custkey")
    agg = (li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
           .groupBy("o_custkey", "l_partkey").agg(F.sum("l_quantity").alias("qty")))
    return agg.select(F.col("o_custkey").alias("codcli"), product_id(F.col("l_partkey")).alias("codmersrr"),
                      F.col("l_partkey").alias("partkey"), "qty")


def preference_responses(t: Tables) -> DataFrame:
    """Landed customer-preference responses (codcli, body JSON) built from customer + nation.

    Every 9th customer has no delivery branch field, every 13th no payment
    condition; names arrive in lower case.
    """
    c = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    restriction = F.struct(
        F.when(key % 9 != 0, F.lower(F.col("n_name"))).alias("fil_delivery"),
        F.lower(F.substring("n_name", 1, 2)).alias("ufFilialFaturamento"),
        F.concat(F.lit("WB"), F.col("n_nationkey").cast("string")).alias("codeWarehouseBilling"),
        F.concat(F.lit("WD"), (F.col("n_nationkey") % 5).cast("string")).alias("codeWarehouseDelivery"))
    condition = F.struct(
        F.concat(F.lit("C"), (key % 4).cast("string")).alias("CODIGO_CONDICAO"),
        F.concat(F.lit(" - "), F.col("c_mktsegment")).alias("observacao"))
    body = F.struct(
        F.array(restriction).alias("listCustomerRestriction"),
        F.when(key % 13 != 0, F.array(condition)).otherwise(F.array()).alias("lstCondicoesPamento"))
    return c.select(key.alias("codcli"), F.to_json(body).alias("body"))


UNPRICED_SIZE = 47


def price_responses(t: Tables, paged: DataFrame) -> DataFrame:
    """Landed price-service responses, one per (customer, page) request.

    Prices follow fixed rules on the part so every resolution case occurs:
    own products (even keys) price 0 when key % 10 == 0, box price absent when
    key % 3 == 0 and 0 when key % 3 == 1; seller products price 0 when
    key % 9 == 1, are listed twice (second entry +1) when key % 5 == 3, are
    also in the own list when key % 7 == 2.  The service has no price for the
    largest pack sizes (p_size > 47): those products are missing from the answer.
    """
    part = t.part.select(F.col("p_partkey").alias("partkey"),
                         F.col("p_retailprice").cast("decimal(12,2)").alias("p_retailprice"), "p_size")
    r = paged.join(part, "partkey").where(F.col("p_size") <= UNPRICED_SIZE)
    k, price = F.col("partkey"), F.col("p_retailprice")
    own = F.col("party") == "1P"
    def scaled(f: str) -> F.Column:  # decimal arithmetic: cents rounded half-up
        return F.round(price * F.lit(f).cast("decimal(4,2)"), 2).cast("double")

    box = (F.when(k % 3 == 0, F.lit(None).cast("double")).when(k % 3 == 1, F.lit(0.0))
           .otherwise(scaled("11.5")))
    e1 = F.struct(F.col("codmersrr").alias("codigoMercadoria"),
                  F.array(F.struct(F.when(k % 10 == 0, F.lit(0.0)).otherwise(price.cast("double")).alias("precoNormal"),
                                   box.alias("precoCaixa"))).alias("precos"))
    e1_also = F.struct(F.col("codmersrr").alias("codigoMercadoria"),
                       F.array(F.struct(scaled("1.1").alias("precoNormal"),
                                        F.lit(None).cast("double").alias("precoCaixa"))).alias("precos"))
    p3 = F.when(k % 9 == 1, F.lit(0.0)).otherwise(scaled("0.95"))
    e3 = F.struct(F.col("codmersrr").alias("codigoMercadoria"), p3.alias("preco"))
    e3_dup = F.struct(F.col("codmersrr").alias("codigoMercadoria"), (p3 + 1).alias("preco"))
    item = F.struct((-F.col("qty")).alias("_k1"), k.alias("_k2"))
    grouped = r.groupBy("codcli", "page").agg(
        F.array_sort(F.collect_list(F.when(own, F.struct(item.alias("k"), e1.alias("e"))))).alias("a1"),
        F.array_sort(F.collect_list(F.when(~own & (k % 7 == 2), F.struct(item.alias("k"), e1_also.alias("e"))))).alias("a1b"),
        F.array_sort(F.collect_list(F.when(~own, F.struct(item.alias("k"), e3.alias("e"))))).alias("a3"),
        F.array_sort(F.collect_list(F.when(~own & (k % 5 == 3), F.struct(item.alias("k"), e3_dup.alias("e"))))).alias("a3b"),
    )
    body = F.struct(
        F.concat(F.transform("a1", lambda s: s["e"]), F.transform("a1b", lambda s: s["e"])).alias("resultado"),
        F.concat(F.transform("a3", lambda s: s["e"]), F.transform("a3b", lambda s: s["e"])).alias("lstPrecoSeller"))
    return grouped.select("codcli", "page", F.to_json(body).alias("body"))
