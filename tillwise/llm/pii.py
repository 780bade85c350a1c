"""Personal data: fixed forms, and bootstrapped contextual extraction (DataFrame functions only).

Seeds are what the fixed forms find: e-mail and IP addresses, payment cards and
phone numbers.  Bootstrapping then looks for identifiers in other writings:

1. A slot is a run of words that hold a digit or an at sign; its context is the
   word before it.  Seeds and slots give edges (context, kind, value) of a
   pattern-instance graph, aggregated over all documents.
2. Rounds: a context's confidence in a kind is the score of the values it
   introduces over all its occurrences in the corpus, whatever follows; a value's
   score is 1 if it is a seed anywhere, else the noisy-or of its contexts'
   confidence.
3. A context with ``SUPPORT`` distinct seeds and a confidence of ``CONFIDENCE``
   is trusted; slots that it introduces, whose value has the kind's loose shape
   and reaches the same score, become spans of that kind unless they touch a seed.

Common words introduce a number now and then but mostly other words, so they
are never trusted.

Defined results: a null or empty text has no spans; matches that fail their
check (IP part, Luhn, number of digits) are dropped and not searched again;
repeated documents get one row each; positions are code points, the end is
exclusive; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import SPACE, Scratch, fresh
from tillwise.llm.quality_rules import bind

KINDS = ("email", "ip", "card", "phone")
SUPPORT, CONFIDENCE, ROUNDS = 3, 0.5, 3

#: What each kind matches.  Possessive repetition and the look at the character before keep
#: every search linear; a match is the same as with plain greedy repetition.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to be searched at all.
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
#: Words with a digit or an at sign, in a row.
_MARKED = rf"[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
SLOT = rf"(?<![^{SPACE}]){_MARKED}(?:\x20{_MARKED})*+"
#: Loose shapes of slots that a trusted context may turn into spans.
SHAPES = {
    "email": r"^[^@]+(?:@|[(\[]at[)\]]).+[a-z]$",
    "ip": r"^[0-9A-Fa-f]{1,4}(?:[.:]+[0-9A-Fa-f]{1,4}){3,7}$",
    "card": r"^[0-9](?:[\x20./-]?[0-9]){11,18}$",
    "phone": r"^[(+]{0,2}[0-9](?:[\x20().\/-]{0,2}[0-9]){6,14}$",
}


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]+", "")
    if kind == "ip":
        short = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(short, lambda p: F.when(F.length(p) > 3, F.lit(False)).when(p == "", F.lit(True)).otherwise(p.cast("int") <= 255))
    if kind == "card":
        def luhn(d: Column) -> Column:
            def add(a: Column, i: Column) -> Column:
                x = F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
                return a + F.when(x > 9, x - 9).otherwise(x)

            return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0

        return bind(digits, luhn)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


FOUND = "array<struct<start: int, end: int, value: string, context: string>>"


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What ``combine`` makes of 0 and the values before each one, with the total at the end.

    Blocks of about n ** (1/3) values: their totals are run through once, and each value goes
    through its own block only, so that the work grows with n ** (4/3).
    """
    def over(part: Column, start: Column) -> Column:
        return F.aggregate(part, start, combine)

    def scan(s: Column) -> Column:
        v, size = s["v"], s["size"]
        total = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / size).cast("int")), lambda k: over(F.slice(v, k * size + 1, size), F.lit(0)))
        before = F.aggregate(total, F.array(F.lit(0)), lambda out, x: F.concat(out, F.array(combine(F.element_at(out, -1), x))))

        def of(b: Column) -> Column:
            def at(i: Column) -> Column:
                k = F.floor(i / size).cast("int")
                return over(F.slice(v, k * size + 1, i - k * size), F.get(b, k))

            return F.transform(F.sequence(F.lit(0), F.size(v)), at)

        return bind(before, of)

    size = F.greatest(F.lit(8), F.cbrt(F.size(values)).cast("int"))
    return F.when(F.size(values) > 0, bind(F.struct(values.alias("v"), size.alias("size")), scan)).otherwise(F.array(F.lit(0)))


def found(text: Column, pattern: str) -> Column:
    """All matches in order: start, end, value, and the word before, in lower case."""
    def place(v: Column) -> Column:
        part = F.slice(v["part"], 1, F.size(v["hit"]))
        lens = F.zip_with(part, v["hit"], lambda p, h: F.length(p) + F.length(h))

        def one(x: Column) -> Column:
            start = x["at"] + F.length(x["part"])
            before = F.substring_index(F.rtrim(F.translate(x["part"], "\t\n\x0b\x0c\r", "     ")), " ", -1)
            return F.struct(start.alias("start"), (start + F.length(x["hit"])).alias("end"), x["hit"].alias("value"), F.lower(before).alias("context"))

        def placed(at: Column) -> Column:
            pairs = F.arrays_zip(part.alias("part"), v["hit"].alias("hit"), F.slice(at, 1, F.size(v["hit"])).alias("at"))
            return F.transform(pairs, one)

        return F.when(F.size(v["hit"]) > 0, bind(running(lens, lambda a, x: a + x), placed)).otherwise(F.array().cast(FOUND))

    return bind(F.struct(F.split(text, pattern).alias("part"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")), place)


#: Characters of a piece that a long text is cut into; a position is counted inside its piece only.
PIECE = 4096


def between(pieces: Column, a: Column, b: Column) -> Column:
    """Characters ``a`` (included) to ``b`` of the text in ``pieces``."""
    first, last = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
    head, tail = F.coalesce(F.get(pieces, first), F.lit("")), F.coalesce(F.get(pieces, last), F.lit(""))
    whole = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    apart = F.concat(F.substring(head, a % PIECE + 1, F.lit(PIECE)), whole, F.substring(tail, F.lit(1), b % PIECE))
    return F.when(first == last, F.substring(head, a % PIECE + 1, b - a)).otherwise(apart)


def seeds(text: Column, kind: str) -> Column:
    hits = F.filter(found(text, FORMS[kind]), lambda x: valid(kind, x["value"]))
    return F.when(text.rlike(HINTS[kind]), hits).otherwise(F.array().cast(FOUND))


def trimmed(slot: Column) -> Column:
    """A slot without the punctuation around it."""
    value = F.regexp_replace(slot["value"], r"[.,;:!?)\]}\"']+$", "")
    bare = F.regexp_replace(value, r"^[\"'\[{]+", "")
    start = slot["start"] + F.length(value) - F.length(bare)
    return F.struct(start.alias("start"), (start + F.length(bare)).cast("int").alias("end"), bare.alias("value"), slot["context"].alias("context"))


def loose(value: Column) -> Column:
    """Kinds whose loose shape a value has."""
    return F.filter(F.array(*(F.when(value.rlike(SHAPES[k]), F.lit(k)) for k in KINDS)), lambda k: k.isNotNull())


def each_kind(spans: Callable[[str], Column], make: Callable[[str, Column], Column]) -> Column:
    """One array of ``make(kind, span)`` over the spans of every kind, kinds as listed."""
    def of(kind: str) -> Column:
        return F.transform(spans(kind), lambda x: make(kind, x))

    return F.flatten(F.array(*map(of, KINDS)))


class Extractor:
    """Finds the spans of every row of ``df``.

    ``marked``: the kept columns, ``row`` (an id of the row) and ``seeds`` (a
    struct of spans for each kind); ``more``: (row, spans) found by context.
    """

    def __init__(self, df: DataFrame, text: str = "text", keep: list[str] | None = None):
        self.scratch = scratch = Scratch(df.sparkSession, "pii")
        keep = df.columns if keep is None else keep
        self.row, self.seeds, slots = (fresh(df, x) for x in ("row", "seeds", "slots"))
        whole = F.coalesce(F.col(text), F.lit(""))

        def look(t: Column) -> Column:
            slot = F.filter(F.transform(found(t, SLOT), trimmed), lambda x: x["value"].rlike("[0-9@]") & (F.size(loose(x["value"])) > 0))
            return F.struct(F.struct(*(seeds(t, k).alias(k) for k in KINDS)).alias("seeds"), F.when(t.rlike("[0-9@]"), slot).otherwise(F.array().cast(FOUND)).alias("slots"))

        both = fresh(df, "both")
        looked = df.select(*keep, F.monotonically_increasing_id().alias(self.row), bind(whole, look).alias(both))
        self.marked = scratch.save(looked.select(*keep, self.row, F.col(both)["seeds"].alias(self.seeds), F.col(both)["slots"].alias(slots)))
        self.more = self._bootstrapped(df, text, slots)

    def _bootstrapped(self, df: DataFrame, text: str, slots: str) -> DataFrame:
        scratch, marked = self.scratch, self.marked
        sown = each_kind(lambda k: F.col(self.seeds)[k], lambda k, x: F.struct(F.lit(k).alias("kind"), x["value"].alias("value"), x["context"].alias("context")))
        sown = marked.select(F.explode(sown).alias("s")).select("s.*").groupBy("context", "kind", "value").agg(F.count("*").alias("n"))
        sown = scratch.save(sown.where("context <> ''"))
        # contexts that could be trusted at all
        able = scratch.save(sown.groupBy("context", "kind").agg(F.count_distinct("value").alias("support")).where(F.col("support") >= SUPPORT))
        slot = marked.select(self.row, F.explode(slots).alias("s")).select(self.row, "s.*").join(able.select("context").distinct(), "context")
        slot = scratch.save(slot.select(self.row, "start", "end", "value", "context", F.explode(loose(F.col("value"))).alias("kind")))
        words = df.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), f"[{SPACE}]+")).alias("context"))
        # words are counted before the join, so that no common word is shuffled more often than once a task
        words = words.groupBy("context").agg(F.count("*").alias("total"))
        total = scratch.save(words.join(able.select("context").distinct(), "context"))
        plain = slot.join(sown.select("kind", "value").distinct(), ["kind", "value"], "left_anti").groupBy("context", "kind", "value").agg(F.count("*").alias("n"))
        edges = sown.withColumn("seed", F.lit(True)).join(able.select("context", "kind"), ["context", "kind"]).union(plain.withColumn("seed", F.lit(False)).select("context", "kind", "value", "n", "seed"))
        edges = scratch.save(edges)
        score = None
        for _ in range(ROUNDS):
            weighed = edges.withColumn("score", F.col("seed").cast("double")) if score is None else edges.join(score, ["kind", "value"], "left").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))))
            trust = weighed.groupBy("context", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("mass")).join(total, "context").select("context", "kind", F.least(F.col("mass") / F.col("total"), F.lit(1.0)).alias("trust"))
            trust = scratch.save(trust)
            miss = F.sum(F.log1p(-F.least("trust", F.lit(0.999999))))
            score = scratch.save(edges.where("not seed").join(trust, ["context", "kind"]).groupBy("kind", "value").agg((1 - F.exp(miss)).alias("score")))
        trusted = trust.where(F.col("trust") >= CONFIDENCE).join(able, ["context", "kind"]).select("context", "kind")
        hits = slot.join(trusted, ["context", "kind"]).join(score.where(F.col("score") >= CONFIDENCE), ["kind", "value"])
        own = hits.groupBy(self.row).agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("hits"))
        known = marked.select(self.row, F.flatten(F.array(*(F.col(self.seeds)[k] for k in KINDS))).alias("known"))
        # a slot that touches a seed is the seed's; of several kinds for a slot the first listed stands
        joined = own.join(known, self.row)
        apart = F.filter("hits", lambda h: ~F.exists("known", lambda x: (x["start"] < h["end"]) & (h["start"] < x["end"])))
        first = F.filter("apart", lambda h: ~F.exists("apart", lambda g: (g["start"] < h["end"]) & (h["start"] < g["end"]) & (_place(g) < _place(h))))
        out = joined.select(self.row, apart.alias("apart")).select(F.col(self.row), first.alias("more")).where("size(more) > 0")
        return scratch.save(out)

    def spans(self) -> DataFrame:
        """The kept columns, ``row``, ``seeds`` and ``spans``: all spans, by kind as listed, then start."""
        out = fresh(self.marked, "spans")
        more = self.more.select(F.col(self.row), F.col("more").alias(fresh(self.marked, "more")))
        joined = self.marked.join(more, self.row, "left")
        extra = F.coalesce(F.col(more.columns[1]), F.array().cast("array<struct<start: int, end: int, kind: string>>"))
        placed = lambda k, x: F.struct(F.lit(KINDS.index(k)).alias("place"), x["start"].alias("start"), x["end"].alias("end"), F.lit(k).alias("kind"))
        fixed = each_kind(lambda k: F.col(self.seeds)[k], placed)
        found_ = each_kind(lambda k: F.filter(extra, lambda x: x["kind"] == k), placed)
        return joined.select(*self.marked.columns, F.sort_array(F.concat(fixed, found_)).alias(out))

    def redacted(self, columns: list[str], text: str = "text") -> DataFrame:
        """``columns`` with each span (overlapping ones joined) replaced by its kind in brackets."""
        df = self.spans()
        spans = df.columns[-1]
        by_start = F.array_sort(F.transform(F.col(spans), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

        def rebuilt(v: Column) -> Column:
            def joined(at: Column) -> Column:
                def piece(x: Column) -> Column:
                    # a span that begins inside what is already replaced adds nothing
                    new = F.concat(between(v["pieces"], x["at"], x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
                    return F.when(x["start"] >= x["at"], new).otherwise(F.lit(""))

                each = F.zip_with(v["own"], F.slice(at, 1, F.size(v["own"])), lambda x, t: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), t.alias("at")))
                end = F.element_at(at, -1)
                return F.concat(F.array_join(F.transform(each, piece), ""), between(v["pieces"], end, F.size(v["pieces"]) * PIECE))

            return bind(running(F.transform(v["own"], lambda x: x["end"]), lambda a, x: F.greatest(a, x)), joined)

        pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
        clean = F.when(F.size(spans) > 0, bind(F.struct(by_start.alias("own"), pieces.alias("pieces")), rebuilt)).otherwise(F.col(text))
        return df.select(*(clean.alias(c) if c == text else F.col(c) for c in columns))


def _place(x: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), x["kind"])


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
