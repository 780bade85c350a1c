"""Quality rules whose cutoffs are certified on labelled documents (DataFrame functions only).

Every rule gives a document a score in whole per cent; a document goes if one
reaches the rule's cutoff in its stratum (language).  Cutoffs come from
the labelled documents of good quality, the holdout:

* The cutoffs of a stratum form one nested family.  The lift of a rule's cutoff is
  the share of the poor labelled documents that reach it, divided by the share of
  all documents but the good labelled ones (running maximum, so it never falls as
  the cutoff rises).  A document's combined score is the largest lift that one of
  its scores reaches; to reject from a lift on is to set one cutoff for each rule.
  The good labelled documents, on which the family is tested, do not shape it.
* A lift that rejects k of a stratum's n good documents is certified if the exact
  binomial tail P(X <= k | n, limit) is at most the level, that is, if the
  Clopper-Pearson upper bound of its false rejection rate is below ``limit``.
* The level is ``risk`` divided by the strata tested (Bonferroni); inside a stratum
  lifts are tested in a fixed order, from the largest, mildest one on, up to the
  first that is not certified, which needs no further correction.  So with
  probability 1 - ``risk`` no stratum's rules together reject more than ``limit``
  of its good documents.
* Of the certified lifts the one with the largest gain is taken: rejected poor
  documents less ``COST`` times rejected good ones, and none if no lift has a gain.
  A stratum with too few labels (see ``least_labels``) gets no cutoffs, and loses
  nothing.

Defined results: a null or empty text has no words and fails the base rules; a
null language is a stratum of its own; labels without a document, or with a null
quality, count for nothing, and of several labels the lowest counts; repeated
documents are judged alike; without labels only the base rules hold, and so they
do where every document has a label (all lifts are one then, and no order is
left); other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import SPACE, Scratch, fresh

WINDOW = 8
RULES = ("symbols", "dup_lines", "repeats", "capitals")
#: Share of a stratum's good documents that its rules together may reject; chance that a stratum's limit
#: is broken; rejected poor documents that outweigh a good one.
LIMIT, RISK, COST = 0.01, 0.05, 5
TOP = 100


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once (a lambda's variable is not inlined again)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def covered_words(words: Column) -> Column:
    """Words that stand in a window found twice or more in the text."""
    def from_hashes(hashes: Column) -> Column:
        def from_sorted(s: Column) -> Column:
            twin = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
            starts = F.sort_array(F.transform(twin, lambda x: x["i"]))
            zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            step = lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).cast("int").alias("n"), (i + WINDOW).cast("int").alias("end"))
            return F.aggregate(starts, zero, step)["n"]

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bind(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), from_sorted))

    hashes = F.transform(F.slice(words, 1, F.size(words) - (WINDOW - 1)), lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WINDOW))))
    return F.when(F.size(words) > WINDOW, bind(hashes, from_hashes)).otherwise(F.lit(0))


def measures(text: Column) -> Column:
    """Struct of a text's counts; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            covered_words(words).cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    return F.struct(
        bind(words, of_words).alias("words"),
        bind(lines, of_lines).alias("lines"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long").alias("n_capitals"))


def measured(df: DataFrame, text: str, out: str) -> DataFrame:
    """Append the struct ``out`` of a text's counts."""
    made = fresh(df, "made")
    m = F.col(made)
    flat = F.struct(m["words"]["n_words"].alias("n_words"), m["words"]["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"), m["lines"]["n_dup_lines"].alias("n_dup_lines"), m["words"]["n_repeat_words"].alias("n_repeat_words"), m["lines"]["n_lines"].alias("n_lines"), m["n_capitals"].alias("n_capitals"))
    return df.select(*df.columns, bind(measures(F.col(text)), lambda x: x).alias(made)).select(*df.columns, flat.alias(out))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def scores(m: Column) -> dict[str, Column]:
    """Each rule's score, 0 to 100 whole per cent."""
    share = lambda a, b: F.least(F.floor(100 * a / F.greatest(b, F.lit(1))), F.lit(100)).cast("int")
    return {
        "symbols": share(m["n_symbols"], m["word_chars"]),
        "dup_lines": share(m["n_dup_lines"], m["n_lines"]),
        "repeats": share(m["n_repeat_words"], m["n_words"]),
        "capitals": share(m["n_capitals"], m["word_chars"]),
    }


def log_tail(k: Column, n: Column, limit: float) -> Column:
    """log P(X <= k) of a binomial (n, limit); k is at most n * limit."""
    odds = limit / (1 - limit)
    first = n * F.log1p(F.lit(-limit))
    zero = F.struct(first.alias("term"), first.alias("sum"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i * odds)
        high, low = F.greatest(a["sum"], term), F.least(a["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, zero, step)["sum"]


def least_labels(limit: float, risk: float) -> int:
    """Good documents below which no cutoff of a stratum can be certified, even if it rejects none."""
    return math.ceil(math.log(risk) / math.log1p(-limit))


def binned(df: DataFrame, *counts: Column) -> DataFrame:
    """(stratum, rule, score) and the sums ``counts`` of rows with a map ``scores``: at most 404 rows a stratum."""
    return df.select("*", F.explode("scores").alias("rule", "score")).groupBy("stratum", "rule", "score").agg(*counts)


def family(everything: DataFrame, labelled: DataFrame, strata: DataFrame) -> DataFrame:
    """(stratum, rule, cutoff, lift) for the cutoffs 1 to 100 of the ``strata``."""
    rows = binned(everything, F.count(F.lit(1)).alias("rows"))
    known = binned(labelled, F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("poor"))
    grid = strata.select("stratum", F.explode(F.array(*map(F.lit, RULES))).alias("rule")).withColumn("score", F.explode(F.sequence(F.lit(0), F.lit(TOP))))
    own = grid.join(rows, ["stratum", "rule", "score"], "left").join(known, ["stratum", "rule", "score"], "left").na.fill(0, ["rows", "good", "poor"])
    down = Window.partitionBy("stratum", "rule").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("stratum", "rule").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("stratum", "rule")
    other = F.col("rows") - F.col("good")
    sums = own.select("stratum", "rule", "score", F.sum("poor").over(down).alias("poor"), F.sum(other).over(down).alias("others"), F.sum("poor").over(every).alias("all_poor"), F.sum(other).over(every).alias("all_others"))
    lift = F.when(F.col("poor") > 0, (F.col("poor") / F.col("all_poor")) / (F.col("others") / F.col("all_others"))).otherwise(0.0)
    return sums.where(F.col("score") > 0).select("stratum", "rule", F.col("score").alias("cutoff"), F.max(lift).over(up).alias("lift"))


def certified(scratch: Scratch, everything: DataFrame, labelled: DataFrame, limit: float = LIMIT, risk: float = RISK) -> tuple[DataFrame, DataFrame]:
    """The family of cutoffs, and every stratum's lifts, tested.

    ``everything`` has (stratum, scores as a map) of all documents that pass the base
    rules, ``labelled`` (stratum, good, scores) of those with a label.  Both results
    have at most 400 rows a tested stratum, and each of these has hundreds of labels.
    """
    sizes = labelled.groupBy("stratum").agg(F.sum(F.col("good").cast("long")).alias("n"))
    strata = scratch.save(sizes.where(F.col("n") >= least_labels(limit, risk)))
    lifts = scratch.save(family(everything, labelled, strata))
    curves = lifts.groupBy("stratum", "rule").agg(F.transform(F.sort_array(F.collect_list(F.struct("cutoff", "lift"))), lambda x: x["lift"]).alias("curve")).groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "curve"))).alias("curves"))
    reached = [F.when(F.col("scores")[r] > 0, F.element_at(F.col("curves")[r], F.col("scores")[r])).otherwise(0.0) for r in RULES]
    points = labelled.join(F.broadcast(curves), "stratum").select("stratum", "good", F.greatest(*reached).alias("lift"))
    bins = points.groupBy("stratum", "lift").agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("poor"))
    down = Window.partitionBy("stratum").orderBy(F.desc("lift")).rowsBetween(Window.unboundedPreceding, 0)
    sums = bins.join(strata, "stratum").withColumn("k", F.sum("good").over(down)).withColumn("caught", F.sum("poor").over(down)).where("lift > 0")
    level = math.log(risk / max(1, strata.count()))
    passed = (F.col("k") <= F.col("n") * limit) & (log_tail(F.col("k"), F.col("n"), limit) <= level)
    return lifts, sums.withColumn("passed", F.coalesce(passed, F.lit(False))).withColumn("certified", F.min("passed").over(down)).withColumn("gain", F.col("caught") - COST * F.col("k"))


def chosen(lifts: DataFrame, tested: DataFrame) -> DataFrame:
    """(stratum, cutoffs): a map from rule to its cutoff, for strata that have any."""
    best = tested.where("certified and gain > 0").groupBy("stratum").agg(F.max_by("lift", F.struct("gain", "lift")).alias("least"))
    cutoffs = lifts.join(best, "stratum").where("lift >= least").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))
    return cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def judge(df: DataFrame, labels: DataFrame, out: str, text: str = "text", doc_id: str = "doc_id", stratum: str = "lang", keep: list[str] | None = None, limit: float = LIMIT, risk: float = RISK) -> DataFrame:
    """``keep`` (default: all) columns plus the struct ``out``: the counts, base_failed, kept."""
    keep = df.columns if keep is None else keep
    scratch = Scratch(df.sparkSession, "quality")
    made = scratch.save(measured(df.select(*dict.fromkeys([*keep, text, doc_id, stratum])), text, out).select(*dict.fromkeys([*keep, doc_id, stratum]), out))
    m = F.col(out)
    # a null stratum differs from an empty one
    own = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit(""))
    as_map = F.create_map(*(x for name, s in scores(m).items() for x in (F.lit(name), s)))
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good")).select(F.col("doc_id").alias("_id"), "good")
    # documents that the base rules reject are gone before any cutoff is tried
    passing = made.where(~base_failed(m)).select(F.col(doc_id).alias("_id"), own.alias("stratum"), as_map.alias("scores"))
    labelled = scratch.save(passing.join(known, "_id").drop("_id"))
    cutoffs = scratch.save(chosen(*certified(scratch, passing, labelled, limit, risk)))
    # a row for each stratum with a certified cutoff: each of them has hundreds of labels
    wide, at = made.withColumn(fresh(made, "stratum_of"), own), fresh(made, "stratum_of")
    limits = F.broadcast(cutoffs.select(F.col("stratum").alias(f"{at}_"), F.col("cutoffs").alias(f"{at}_cutoffs")))
    wide = wide.join(limits, F.col(at) == F.col(f"{at}_"), "left")
    over = F.lit(False)
    for name, s in scores(m).items():
        over = over | F.coalesce(s >= F.element_at(F.col(f"{at}_cutoffs"), name), F.lit(False))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return wide.select(*keep, F.struct(*(m[f].alias(f) for f in fields), base_failed(m).alias("base_failed"), (~base_failed(m) & ~over).alias("kept")).alias(out))
