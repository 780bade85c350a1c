"""Main text of web pages: page structure and substrings that its host repeats.

1. A page is cut into blocks of text.  Markup says of a block whether it stands
   in an article, in a part that never belongs to one (menus, headers, footers,
   sidebars, notices, adverts, forms, comments, scripts, styles), or neither.
2. Substrings of a host's token streams are named by hashes of 64 bits, lengths
   doubling from ``LONG`` tokens to the longest that a block needs, and the
   distinct contents that hold each are counted over the whole host: copies of a
   page count once.  Groups of about ``PAGES`` pages only bound what a task holds;
   their counts are summed, so that they do not change the result.
3. A block goes if ``COVERED`` of it lies in substrings, about half as long as
   itself or longer, that the host repeats: on ``OUTSIDE`` contents on pages without
   main markup; in main texts, on most of the host's main texts.  Unique runs stay.
4. What repeats around a text is less than the text.  A main text that would lose
   more than half of its tokens, or a page without main markup that would lose more
   than four fifths, is a copy or near copy of other pages and stays whole.

Defined results: null or empty html, or a page without an article's text, gives
an empty text; a null or unreadable url is a host of its own (the empty one);
repeated rows get one row each; broken or cut off markup ends with the page;
an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import Scratch, fresh, map_batches, mixed

LONG, PAGES = 4, 512
#: A block is repeated if this share of its tokens is covered.
COVERED = 0.6
#: Contents that must share a substring: outside an article, inside one (least number, share of the host's).
OUTSIDE, INSIDE = (3, 0.0), (8, 0.6)
#: Largest share of its tokens that a page may lose: main texts, pages without main markup.
LOSS = {True: 0.5, False: 0.8}

# HTML's elements by what they mean here, and usual class names.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
RAW_TAGS = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
OUT_TAGS = frozenset("aside audio button canvas dialog footer form head header iframe menu nav noscript object script select style svg template textarea title video".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUT_NAMES = frozenset("ad ads advert advertisement advertising adverts alert alerts banner breadcrumb breadcrumbs byline comment commentlist comments consent cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination paywall popup promo promoted recommended related share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget".split())
OUT_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
LAYOUT_NAMES = frozenset("body container content has inner layout no outer page row with wrap wrapper".split())
MAIN_NAMES = frozenset("article article-body article-content articlebody content entry entry-content main main-content post post-body post-content story story-body".split())

_TAG = re.compile(r"<(?:!--|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?|[!?][^>]*>?)")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _named_out(value: str) -> bool:
    for name in value.lower().split():
        parts = re.split(r"[-_]+", name)
        if name in OUT_NAMES or (len(parts) <= 3 and not LAYOUT_NAMES.intersection(parts) and OUT_NAMES.intersection(parts)):
            return True
    return False


def _kind(tag: str, attributes: str) -> tuple[bool, int]:
    """Is the element left out; the rank of the main text it begins (0: none)."""
    if tag in OUT_TAGS:
        return True, 0
    rank = {"article": 3, "main": 2}.get(tag, 0)
    out = False
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                out |= tag not in ("body", "html") and _named_out(value)
                rank = rank or int(bool(MAIN_NAMES.intersection(value.lower().split())))
            elif name == "role":
                out |= value.lower() in OUT_ROLES
                rank = max(rank, 2 * (value.lower() == "main"))
            elif name == "itemprop":
                rank = max(rank, 3 * (value.lower() == "articlebody"))
                out |= value.lower() == "comment"
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                out = True
    return out, rank


def page_blocks(html: str) -> list[tuple[str, int]]:
    """(text, rank) of each block that markup does not leave out; rank 0 is outside any main text."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    held: list[tuple[str, int]] = []  # open elements that begin a main text
    away: str | None = None  # the element left out, and how often its tag is open
    deep, rank, at = 0, 0, 0

    def close() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((text, rank))
            parts.clear()

    while True:
        m = _TAG.search(html, at)
        text_end = m.start() if m else len(html)
        if away is None and text_end > at:
            parts.append(html[at:text_end])
        if m is None:
            break
        at, tag = m.end(), m[2] and m[2].lower()
        if tag is None:
            if m[0] == "<!--":
                end = _COMMENT_END.search(html, at)
                at = end.end() if end else len(html)
            continue
        if not m[1] and tag in RAW_TAGS and not m[3].endswith("/"):
            close_raw = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = close_raw.end() if close_raw else len(html)
            if away is None and tag in BLOCK_TAGS:
                close()
            continue
        if away is not None:
            if tag == away:
                deep += -1 if m[1] else 1
            if deep == 0 or (away in ("p", "li") and tag in BLOCK_TAGS and tag != away) or (away == "p" and tag == "p") or (away == "head" and tag == "body"):
                ended, away = away, None
                if tag == ended or m[1]:
                    if not (tag == ended and not m[1]):
                        continue
            else:
                continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            close()
        if m[1]:
            for k in range(len(held) - 1, -1, -1):
                if held[k][0] == tag:
                    if held[k][1]:
                        close()
                    del held[k:]
                    rank = max((r for _, r in held), default=0)
                    break
            continue
        if tag in VOID_TAGS or m[3].endswith("/"):
            continue
        left, own = _kind(tag, m[3])
        if left:
            close()
            away, deep = tag, 1
        elif own or any(t == tag for t, _ in held):  # same tags are counted so that their ends match
            close()
            held.append((tag, own))
            rank = max(rank, own)
    close()
    return out


#: Odd factors that join the hashes of two halves of a window.
_JOIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def windows(tokens: np.ndarray, page: np.ndarray, long: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, starts, hashes) of the windows of ``LONG``, 2 ``LONG``, ... up to ``long`` tokens inside one page.

    Lengths double: a window's hash is made of its halves' hashes.
    """
    h, depth = mixed(tokens.astype(np.uint64)), 1
    while depth * 2 <= min(long, len(tokens)):
        h = mixed(h[:-depth] * _JOIN[0] + h[depth:] * _JOIN[1])
        depth *= 2
        if depth >= LONG:
            starts = np.flatnonzero(page[: len(h)] == page[depth - 1:])
            yield depth, starts, h[starts]


def page_counts(hashes: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, and on how many pages each stands."""
    order = np.lexsort((page, hashes))
    r, p = hashes[order], page[order]
    first = np.concatenate((np.ones(min(len(r), 1), bool), r[1:] != r[:-1]))
    other = first | np.concatenate((np.ones(min(len(r), 1), bool), p[1:] != p[:-1]))
    return r[first], np.bincount(np.cumsum(first) - 1, other, int(first.sum())).astype(np.int64)


def repeated_on(tokens: np.ndarray, page: np.ndarray, long: int = LONG) -> np.ndarray:
    """For each token: on how many pages the most widespread window of ``long`` tokens covering it stands."""
    found = np.zeros(len(tokens), np.int64)
    for depth, starts, h in windows(tokens, page, long):
        if depth == long:
            names, n = page_counts(h, page[starts])
            pages = n[np.searchsorted(names, h)]
            for k in range(long):
                np.maximum.at(found, starts + k, pages)
    return found


def window_of(size: int) -> int:
    """Tokens that a repeated substring must share to count for a block of ``size`` tokens."""
    return max(LONG, 1 << max(int(COVERED * size), 1).bit_length() - 1)


_WORDS: dict[str, int] = {}


def token_hashes(text: str) -> list[int]:
    if len(_WORDS) > 1_000_000:
        _WORDS.clear()
    out = []
    for w in text.split(" "):
        h = _WORDS.get(w)
        if h is None:
            h = _WORDS[w] = int.from_bytes(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        out.append(h)
    return out


def content(blocks: list[tuple[str, int]]) -> int:
    data = "\n".join(t for t, _ in blocks).encode("utf-8", "surrogatepass")
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def main_blocks(blocks: list[tuple[str, int]]) -> list[tuple[str, int]]:
    best = max((r for _, r in blocks), default=0)
    return [b for b in blocks if b[1] == best]


def stream(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Token hashes, their pages, and the longest window that a block of them needs."""
    tokens: list[int] = []
    page, long = [], LONG
    for k, texts in enumerate(pages):
        for text in texts:
            words = token_hashes(text)
            tokens += words
            long = max(long, window_of(len(words)))
            page.append((k, len(words)))
    return np.array(tokens, np.uint64), np.repeat(*np.array(page, np.int64).reshape(-1, 2).T), long


def window_counts(pages: list[list[str]], least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows on at least ``least`` of the pages, and their counts; a longer window is on no more pages than its parts."""
    tokens, page, long = stream(pages)
    for _, starts, h in windows(tokens, page, long):
        names, n = page_counts(h, page[starts])
        enough = n >= least
        if not enough.any():
            return
        yield names[enough], n[enough]


def limit(least: tuple[int, float], pages: int) -> float:
    return max(least[0], least[1] * pages)


def main_text(blocks: list[tuple[str, int]], often: dict[bool, np.ndarray]) -> str:
    """The page's main blocks, without those that repeated windows of its host cover."""
    best = max((r for _, r in blocks), default=0)
    names = often.get(best > 0)
    held = main_blocks(blocks) if best else blocks
    if names is None or not len(names):
        return "\n".join(t for t, _ in held)
    tokens, page, long = stream([[t for t, _ in held]])
    covered = {}
    for depth, starts, h in windows(tokens, page, long):
        hit = starts[np.isin(h, names)]
        edge = np.bincount(hit, minlength=len(tokens) + 1) - np.bincount(hit + depth, minlength=len(tokens) + 1)
        covered[depth] = np.concatenate(([0], np.cumsum(np.cumsum(edge)[:-1] > 0)))
    kept, at, lost = [], 0, 0
    for text, _ in held:
        size = text.count(" ") + 1
        sums = covered.get(window_of(size))
        if sums is None or sums[at + size] - sums[at] < COVERED * size:
            kept.append(text)
        else:
            lost += size
        at += size
    return "\n".join(kept if lost <= LOSS[best > 0] * at else (t for t, _ in held))


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


#: Kinds of rows that a host's groups report: a page without main markup, a number of contents, a window and its count.
UNMARKED, CONTENTS, WINDOW, CANDIDATE = range(4)


def contents(marked: DataFrame, inside: bool) -> DataFrame:
    """(host, deals, content, text) of each page, once for each content in a task: main texts, or all blocks.

    ``inside``: a page without main markup gives a row with a null text instead.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            rows = []
            for host, deals, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks = page_blocks(html or "")
                if not blocks:
                    continue
                text: str | None = None
                if not inside or max(r for _, r in blocks):
                    blocks = main_blocks(blocks) if inside else blocks
                    text = "\n".join(t for t, _ in blocks)
                row = host, content(blocks) if text is not None else None
                if row not in seen:
                    seen.add(row)
                    rows.append((row[0], deals, row[1], text))
            yield pa.RecordBatch.from_pylist([dict(zip(("host", "deals", "content", "text"), r, strict=True)) for r in rows], pa.schema([("host", pa.string()), ("deals", pa.int64()), ("content", pa.int64()), ("text", pa.string())]))

    return marked.mapInArrow(run, "host string, deals long, content long, text string")


def reports(found: DataFrame, inside: bool, every: bool) -> DataFrame:
    """(host, kind, name, n) from each group of a host's distinct contents.

    A host of one group gives the windows that reach its limit.  Of a larger
    host each group gives all its windows (``every``), or else the candidates: a
    window on a share of a host's contents is on that share in a group at least.
    """
    def report(host: str, deals: int, texts: dict[int | None, str | None]) -> list[tuple]:
        pages = [t.split("\n") for t in texts.values() if t is not None]
        out = [(host, CONTENTS, None, len(pages))] + [(host, UNMARKED, None, 1)] * (None in texts)
        if deals == 1:
            kind, least = WINDOW, limit(INSIDE if inside else OUTSIDE, len(pages))
        else:
            kind, least = (WINDOW, 0) if every else (CANDIDATE, INSIDE[1] * len(pages))
        if len(pages) >= least:
            for names, n in window_counts(pages, least):
                out += [(host, kind, a, b) for a, b in zip(names.view(np.int64).tolist(), n.tolist(), strict=True)]
        return out

    def run(batches) -> Iterator[pa.RecordBatch]:
        key, texts = None, {}

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["host", "kind", "name", "n"])

        for batch in batches:
            for host, deals, deal, name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (host, deals, deal) != key:
                    if key:
                        yield table(report(key[0], key[1], texts))
                    key, texts = (host, deals, deal), {}
                texts.setdefault(name, text)
        if key:
            yield table(report(key[0], key[1], texts))

    dealt = found.select("host", "deals", F.coalesce(F.pmod("content", "deals"), F.lit(0)).alias("deal"), "content", "text")
    return dealt.repartition("host", "deal").sortWithinPartitions("host", "deal").mapInArrow(run, "host string, kind int, name long, n long")


def repeated_windows(scratch: Scratch, marked: DataFrame) -> DataFrame:
    """(host, inside, name) of the windows that reach the limit of their host, from (host, deals, html)."""
    first = scratch.save(reports(contents(marked, True), True, False))
    parts = [first.where(F.col("kind") == WINDOW).select("host", F.lit(True).alias("inside"), "name")]
    sums = first.where(F.col("kind") == CONTENTS).groupBy("host").agg(F.sum("n").alias("pages"))
    asked = first.where(F.col("kind") == CANDIDATE).select("host", "name").distinct()
    if not asked.isEmpty():
        again = marked.join(asked.select("host").distinct(), "host", "left_semi")
        counts = reports(contents(again, True), True, True).where(F.col("kind") == WINDOW).join(asked, ["host", "name"], "left_semi")
        enough = counts.groupBy("host", "name").agg(F.sum("n").alias("n")).join(sums, "host").where(F.col("n") >= F.greatest(F.lit(INSIDE[0]), INSIDE[1] * F.col("pages")))
        parts.append(enough.select("host", F.lit(True).alias("inside"), "name"))
    mixed_hosts = first.where(F.col("kind") == UNMARKED).select("host").distinct()
    if not mixed_hosts.isEmpty():
        counts = reports(contents(marked.join(mixed_hosts, "host", "left_semi"), False), False, True).where(F.col("kind") == WINDOW)
        enough = counts.groupBy("host", "name").agg(F.sum("n").alias("n")).where(F.col("n") >= OUTSIDE[0])
        parts.append(enough.select("host", F.lit(False).alias("inside"), "name"))
    return scratch.save(functools.reduce(DataFrame.unionByName, parts))


def extract(df: DataFrame, html: str = "html", url: str = "url", page_id: str = "page_id", out: str = "text", keep: list[str] | None = None, pages: int = PAGES) -> DataFrame:
    """``keep`` (default: all but the html) columns plus the main text ``out``."""
    keep = [c for c in df.columns if c != html] if keep is None else keep
    scratch = Scratch(df.sparkSession, "html")
    host, raw, n = (fresh(df, x) for x in ("host", "raw", "pages_of_host"))
    marked = df.select(*keep, host_of(F.col(url)).alias(host), F.col(html).alias(raw))
    # hosts of more than ``pages`` pages, a small share of the pages' number, are counted in several groups
    large = scratch.save(marked.groupBy(host).agg(F.count("*").alias(n)).where(F.col(n) > pages))
    deals = F.ceil(F.coalesce(F.col(n), F.lit(1)) / F.lit(pages))
    dealt = marked.join(large, host, "left").withColumn(n, deals.cast("long"))
    often = repeated_windows(scratch, dealt.select(F.col(host).alias("host"), F.col(n).alias("deals"), F.col(raw).alias("html")))
    fields = [*dealt.select(*keep).schema, T.StructField(out, T.StringType())]

    def texts(column: pa.ChunkedArray | pa.Array, names: dict[bool, np.ndarray]) -> pa.Array:
        return pa.array([main_text(page_blocks(h or ""), names) for h in column.to_pylist()], pa.string())

    hosts = often.select(F.col("host").alias(host)).distinct()
    rest = dealt.join(hosts, host, "left_anti") if not often.isEmpty() else dealt
    whole = map_batches(rest.select(*keep, raw), lambda batch: [texts(batch.column(len(keep)), {})], fields[-1:], keep)
    if often.isEmpty():
        return whole

    def cut(key, left: pa.Table, right: pa.Table) -> pa.Table:
        inside = np.array(right["inside"].to_pylist(), bool)
        names = right["name"].to_numpy().view(np.uint64)
        made = texts(left[raw], {x: names[inside == x] for x in (False, True)})
        return left.select(keep).append_column(out, made)

    # rows are dealt evenly, and each group gets its host's windows
    deal = fresh(dealt, "deal")
    mine = dealt.join(hosts, host, "left_semi").withColumn(deal, F.pmod(F.xxhash64(*keep, raw), F.col(n)))
    theirs = often.select(F.col("host").alias(host), "inside", "name").join(large, host, "left").withColumn(deal, F.explode(F.sequence(F.lit(0).cast("long"), deals.cast("long") - 1)))
    done = mine.groupBy(host, deal).cogroup(theirs.groupBy(host, deal)).applyInArrow(cut, T.StructType(fields))
    return whole.unionByName(done)
