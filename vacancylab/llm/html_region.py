"""Main text of web pages: the maximum-scoring contiguous region of words and tags."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages (with one article element) from which the weights are fitted.
SAMPLE_PAGES = 500

# Elements by how a page uses them.
DROPPED = frozenset("nav header footer aside form dialog menu button select option datalist fieldset label "
                    "object canvas audio video map figcaption address".split())
#: Of these, what may belong to the text of an article.
KEPT_INSIDE = frozenset("fieldset label object map figcaption address".split())
UNREAD = "script|style|noscript|template|textarea|iframe|svg|title|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
CONTENT = frozenset("article main".split())
ROOTS = frozenset("html body article main".split())
#: Words of class, id and role that mark what is not the article.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar widget menu nav "
    "navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent notice notices popup modal "
    "newsletter subscribe subscription share sharing social related recommended comment comments disqus pagination "
    "pager login signup search contentinfo complementary".split())
#: Words after a mark that only say it is a box: share-bar is marked as share is.
BOXES = frozenset("area bar block body box button buttons container content icon icons inner item items link links list "
                  "panel posts section slot unit wrap wrapper".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    rf"|<(?P<unread>{UNREAD})(?=[\s/>])(?:(?<=svg)(?:\"[^\"]*\"|'[^']*'|[^>\"'])*/>"  # only svg may be self-closed
    r"|[^>]*>.*?(?:</(?P=unread)(?:[\s/][^>]*)?>|$))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s>/]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?"
    r"|<[!?/][^>]*>?",
    re.S | re.I)
MARKS = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD_PART = re.compile(r"[a-z]+")


def _is_noise(name: str, attrs: str, inside: bool) -> bool:
    """Tells if an element begins a menu, an advert and the like.  Inside an
    article a mark needs a NOISE word as its whole name or last part (before
    words for boxes); a compound with header names a heading there."""
    if name in ROOTS and not (inside and name in CONTENT):
        return False
    if name in DROPPED and not (inside and name in KEPT_INSIDE):
        return True
    for marks in MARKS.finditer(attrs) if "=" in attrs else ():
        for mark in (marks[1] or marks[2] or marks[3] or "").lower().split():
            parts = WORD_PART.findall(mark)
            if not parts or parts[0] in ("no", "has", "with", "without", "hide"):
                continue
            if inside:
                while len(parts) > 1 and parts[-1] in BOXES:
                    parts.pop()
                parts = parts[-1:] if len(parts) == 1 or parts[-1] != "header" else []
            if NOISE.intersection(parts):
                return True
    return False


def events(page: str) -> Iterator[tuple[str, str, bool, int]]:
    """The page as a sequence of (kind, value, noise, content).

    kind is "text", "open" or "close"; value the raw text or the element's
    name; noise tells if the place is in a menu, advert and the like; content
    counts from 1 the article or main elements that were opened, those inside
    another as part of it, 0 outside.
    Comments and elements without readable text are left out.  Elements that
    the page does not close end with the element around them.
    """
    stack: list[tuple[str, bool, int]] = []
    at, noise, content, opened = 0, False, 0, 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at:m.start()], noise, content
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            if m["unread"]:
                yield "open", m["unread"].lower(), noise, content
            continue
        if m["close"]:
            yield "close", name, noise, content
            if any(x[0] == name for x in stack):
                while stack:
                    last, noise, content = stack.pop()
                    if last == name:
                        break
            continue
        if name not in INLINE and name not in VOID:  # a block ends an open paragraph
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    noise, content = stack[i][1:]
                    del stack[i:]
                    break
                if stack[i][0] not in INLINE:
                    break
        if name not in VOID and not m["attrs"].endswith("/"):
            stack.append((name, noise, content))
            noise = noise or _is_noise(name, m["attrs"], bool(content))
            if name in CONTENT and not content:
                opened += 1
                content = opened
        yield "open", name, noise, content
    if at < len(page):
        yield "text", page[at:], noise, content


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[tuple[str, bool], int] = {}
        for page in batch.column(0).to_pylist():
            found = list(events(page or ""))
            if len({c for *_, c in found if c}) != 1:
                continue
            for kind, value, noise, content in found:
                inside = bool(content) and not noise
                key, n = (("word", len(value.split())) if kind == "text" else (value, 1))
                counts[key, inside] = counts.get((key, inside), 0) + n
        yield pa.RecordBatch.from_pylist(
            [{"key": k, "inside": i, "n": n} for (k, i), n in counts.items()],
            schema=pa.schema([("key", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]))


def tag_costs(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict[str, float]:
    """Costs of tags, fitted on at most ``sample_pages`` labelled pages.

    A labelled page has one article (or main) element: what is inside it and
    not a menu and the like is content.  A tag costs the log of how much more
    often it stands, per word, outside than inside; at least 0.05, as every
    tag interrupts the text.  The key "" holds the cost of an unknown tag.
    """
    marked = pages.select("html", F.xxhash64("html").alias("h")).where(F.col("html").rlike("(?i)<(article|main)\\b"))
    # the least hashes of different pages are chosen first, so no other page crosses the network
    last = marked.select("h").distinct().orderBy("h").limit(sample_pages).agg(F.max("h")).first()[0]
    sample = marked.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.first("html").alias("html")).select("html")
    total: dict[tuple[str, bool], int] = {}
    for r in sample.mapInArrow(_count, "key string, inside boolean, n long").groupBy("key", "inside").agg(
            F.sum("n").alias("n")).collect():
        total[r["key"], r["inside"]] = r["n"]
    words = {side: total.get(("word", side), 0) + 1 for side in (True, False)}
    costs = {"": 1.0}
    for key in {k for k, _ in total if k != "word"}:
        rate = {side: (total.get((key, side), 0) + 0.5) / words[side] for side in (True, False)}
        costs[key] = max(0.05, math.log(rate[False] / rate[True]))
    return costs


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous part with the highest sum, the first and
    shortest one on a tie; empty if no sum is positive.  One linear scan."""
    best, run, begin, found = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if run <= 0:
            run, begin = 0.0, i
        run += score
        if run > best:
            best, found = run, (begin, i + 1)
    return found


def main_text(page: str | None, costs: dict[str, float]) -> str:
    """Text of the best region: words score 1 each (-1 in menus, adverts and
    the like), tags their negative cost; a region inside an article or main
    element grows to the whole element."""
    found = list(events(page or ""))
    scores = []
    for kind, value, noise, _ in found:
        if kind == "text":
            n = len(value.split())
            scores.append(-n if noise else n)
        else:
            scores.append(-costs.get(value, costs[""]))
    start, end = best_region(scores)
    inside = {c for kind, value, noise, c in found[start:end] if kind == "text" and not noise and value.strip()}
    if len(inside) == 1 and (only := inside.pop()):
        whole = [i for i, e in enumerate(found) if e[3] == only]
        start, end = min(start, whole[0]), max(end, whole[-1] + 1)
        found = [e for e in found[start:end] if e[3] == only or e[0] != "text"]
    else:
        found = found[start:end]
    parts = []
    for kind, value, noise, _ in found:
        if kind == "text":
            if not noise:
                parts.append(html.unescape(value))
        elif value not in INLINE:
            parts.append(" ")
    return " ".join("".join(parts).split())


def extract_pages(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    Null and empty pages and pages without words give an empty text; broken
    markup (open elements, cut tags, unknown references) is read as far as it
    goes; null ids and urls stay null; repeated rows are read one by one;
    extra columns are ignored; an empty table gives an empty result.
    """
    costs = tag_costs(pages, sample_pages)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), costs) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, type=pa.string()),
                 pa.array([len(t) for t in texts], type=pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(
        extract, "page_id long, url string, text string, n_chars long")
