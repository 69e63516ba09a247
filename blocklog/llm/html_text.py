"""Main text of web pages by equivalence-class template deduction (operator 10).

Tokens of a page are its containers (by their path of names and classes) and its text runs (by path and text). Over
all pages of a host, tokens with one occurrence vector form a class; the vector is kept as the sum of hashes of
(page, count), so hosts of any size are aggregated, never gathered. Classes of two tokens or more that most pages
have are valid. They nest by their paths into the host's template: a container of a valid class that comes once in
a page is a slot, and the deepest slot that holds most of the pages' text (an article or main element before
others, which is all that these elements decide where the template fits) is the main one. Text runs of valid classes are
template text wherever they stand. Pages with the same text outside marked-up parts count once, so an article that
is copied over a host is not taken for its template.

A page's main text is what its main slot holds, without template text and without parts that are marked up as
something else. A page that the template does not fit is read by its own markup.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from blocklog.llm.bitmap import bitmap_test
from blocklog.llm.text import mix
from blocklog.llm.urls import host_of
from blocklog.session import Staging

#: A host with fewer pages has no template.
LEAST_PAGES = 4
#: Part of a host's pages that a valid class is found in.
SUPPORT = 0.6
#: Part of a host's text that the main slot holds.
MAIN_SHARE = 0.6

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
_PART = re.compile(r"[a-z]+")
_RAW = frozenset(("script", "style", "noscript", "template", "textarea", "iframe", "title", "xmp"))
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
_INLINE = frozenset(
    ("a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr")
)
#: Elements, and words in class, id or role, that mark what is not the article.
_OTHER = frozenset(
    ("head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "svg", "canvas", "object", "audio", "video", "map")
)
_OTHER_WORDS = frozenset(
    (
        "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "menu", "nav", "navbar",
        "navigation", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "contentinfo", "sidebar", "aside", "complementary", "widget", "related",
        "share", "sharing", "social", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter",
        "subscribe", "subscription", "signup", "login", "search", "form", "pagination", "pager", "toolbar", "copyright", "legal",
    )
)
_COMMENT_WORDS = frozenset(("comment", "comments", "commentlist", "reply", "replies", "discussion", "disqus", "respond"))
_LANDMARKS = ("article", "main")


class _Element:
    __slots__ = ("name", "path", "other", "comments", "main")

    def __init__(self, name: str, path: int, other: bool, comments: bool, main: bool):
        self.name, self.path, self.other, self.comments, self.main = name, path, other, comments, main


def _marks(attributes: str) -> tuple[str, frozenset[str], bool]:
    found = _MARK.findall(attributes)
    if not found:
        return "", frozenset(), False
    values = [(k.lower(), v.strip("\"'").lower()) for k, v in found]
    words = frozenset(w for _, v in values for w in _PART.findall(v))
    return " ".join(v for k, v in values if k == "class"), words, ("role", "main") in values


def read_page(html: str) -> tuple[list[tuple[tuple[_Element, ...], str]], list[_Element]]:
    """(open elements, text) of the blocks of a page in order, and its containers in the order they open.

    Only elements that hold blocks are kept open; an end tag closes what was left open inside its element. Text is
    decoded, its white space single spaces; blocks without text are left out. Broken markup is read as far as it goes.
    """
    root = _Element("", 0, False, False, False)
    stack: list[_Element] = [root]
    blocks: list[tuple[tuple[_Element, ...], str]] = []
    opened: list[_Element] = [root]
    run: list[str] = []
    at = 0

    def close_block() -> None:
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                blocks.append((tuple(stack), text))
            run.clear()

    tag = _TAG.search(html, at)
    while tag:
        if tag.start() > at:
            run.append(html[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name or tag[4] == "":
            if name:
                at = len(html)
        elif name in _RAW:
            if not tag[1]:
                close_block()
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
        elif name in _INLINE:
            pass
        elif tag[1]:
            close_block()
            if any(e.name == name for e in stack[1:]):
                while stack.pop().name != name:
                    pass
        else:
            close_block()
            if name == "p" or name in _VOID or name in ("li", "dt", "dd", "td", "th", "tr", "h1", "h2", "h3", "h4", "h5", "h6"):
                kept = name not in _VOID and name != "p"
                if name in ("li", "dt", "dd", "tr", "td", "th") and stack[-1].name == name:
                    stack.pop()
            else:
                kept = True
            if kept:
                css, words, role = _marks(tag[3]) if tag[3] else ("", frozenset(), False)
                main = role or name in _LANDMARKS
                comments = bool(words & _COMMENT_WORDS)
                other = name in _OTHER or comments or bool(words & _OTHER_WORDS) and not main
                if name in _LANDMARKS and not comments:  # an element left open before the article does not hold it
                    while len(stack) > 1 and stack[-1].other and not stack[-1].comments:
                        stack.pop()
                path = xxh3_64_intdigest(f"{stack[-1].path}>{name}.{css}")
                stack.append(_Element(name, path, other, comments, main))
                opened.append(stack[-1])
        tag = _TAG.search(html, at)
    if at < len(html):
        run.append(html[at:])
    close_block()
    return blocks, opened


def _tokens(html: str | None) -> tuple[Counter, dict[int, int], dict[int, int]]:
    """Counts of a page's tokens, the characters of main text in its containers, and 1 for landmarks, 2 for text."""
    blocks, opened = read_page(html or "")
    counts: Counter = Counter(e.path for e in opened)
    kinds = {e.path: int(e.main) for e in opened}
    held: dict[int, int] = {}
    for elements, text in blocks:
        if any(e.other for e in elements):
            continue
        for path in {e.path for e in elements}:
            held[path] = held.get(path, 0) + len(text)
        token = _text_token(elements[-1].path, text)
        counts[token] += 1
        kinds[token] = 2
    return counts, held, kinds


def _text_token(path: int, text: str) -> int:
    return xxh3_64_intdigest(text, seed=path & 0xFFFFFFFF)


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by host and token over a batch: pages, hash of the occurrence vector, whether it comes once, characters."""
    for batch in batches:
        sums: dict[tuple[str, int], list[int]] = {}
        for host, page, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            counts, held, kinds = _tokens(html.as_py())
            hashes = mix(np.array(list(counts.values()), np.uint64) + np.uint64(page & 0xFFFFFFFFFFFFFFFF)).tolist()
            for (token, n), h in zip(counts.items(), hashes, strict=True):
                row = sums.setdefault((host, token), [0, 0, 0, kinds[token], 0])
                row[0] += 1
                row[1] = (row[1] + h) & 0xFFFFFFFFFFFFFFFF
                row[2] = max(row[2], n)
                row[4] += held.get(token, 0)
        rows = list(sums.items())
        columns = [pa.array([k[0] for k, _ in rows], pa.string()), pa.array(np.array([k[1] for k, _ in rows], np.uint64).view(np.int64))]
        values = np.array([v for _, v in rows], np.uint64).reshape(-1, 5)
        columns += [pa.array(values[:, k].view(np.int64)) for k in range(5)]
        yield pa.RecordBatch.from_arrays(columns, ["host", "token", "pages", "vector", "most", "kind", "chars"])


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds a hash of the text that is not in a part marked up as something else."""
    for batch in batches:
        prints = []
        for html in batch.column(2):
            blocks, _ = read_page(html.as_py() or "")
            prints.append(xxh3_64_intdigest("\n".join(text for elements, text in blocks if not any(e.other for e in elements))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(prints, np.uint64).view(np.int64))], ["host", "key", "html", "print"])


def _distinct_pages(pages: DataFrame, stage: Staging) -> DataFrame:
    """One of the rows (host, key, html) of each text of a host; only pages that may have copies are shuffled."""
    printed = pages.select("host", "key", "html").mapInArrow(_print_batches, "host string, key bigint, html string, print bigint")
    times = printed.groupBy("host", "print").agg(F.count("*").alias("times"))
    copied = stage.table(times.where("times > 1").select(F.xxhash64("host", "print").alias("key")), "copied")
    may_be = bitmap_test(copied)(F.xxhash64("host", "print"))
    return printed.where(~may_be).unionByName(printed.where(may_be).dropDuplicates(["host", "print"])).drop("print")


def page_templates(pages: DataFrame, stage: Staging) -> DataFrame:
    """(host, main, texts): the main slot's path and the template's text runs, for hosts that have a template."""
    found = pages.select("host", "key", "html").mapInArrow(_token_batches, "host string, token bigint, pages bigint, vector bigint, most bigint, kind bigint, chars bigint")
    # Sums of hashes go modulo 2**64: two halves are added and put together again.
    tokens = found.groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.sum(F.expr("vector & 4294967295")).alias("low"), F.sum(F.expr("shiftrightunsigned(vector, 32)")).alias("high"),
        F.max("most").alias("most"), F.max("kind").alias("kind"), F.sum("chars").alias("chars"),
    )
    # Staged, as it is read twice under two filters, for each of which the planner would read all pages anew.
    tokens = stage.table(tokens.where("token = 0 or pages >= 2"), "tokens")
    hosts = tokens.where("token = 0").select("host", F.col("pages").alias("of"), F.col("chars").alias("all"))
    often = tokens.where("pages >= 2").join(hosts, "host").where((F.col("of") >= LEAST_PAGES) & (F.col("pages") >= SUPPORT * F.col("of")))
    vector = [F.pmod(F.col("low"), F.lit(1 << 32)), F.pmod(F.col("high") + F.expr("shiftrightunsigned(low, 32)"), F.lit(1 << 32)), F.col("pages")]
    member = F.struct("token", "kind", "most", "chars", "all")
    classes = often.groupBy("host", *[v.alias(f"v{k}") for k, v in enumerate(vector)]).agg(F.count("*").alias("size"), F.collect_list(member).alias("members"))
    members = classes.where("size >= 2").select("host", F.explode("members").alias("m")).select("host", "m.*")
    slot = (F.col("kind") < 2) & (F.col("most") == 1) & (F.col("chars") >= MAIN_SHARE * F.col("all")) & (F.col("token") != 0)
    # The deepest slot holds the fewest characters of those that hold enough.
    rank = F.struct(F.col("kind").alias("landmark"), (-F.col("chars")).alias("least"), "token")
    return members.groupBy("host").agg(
        F.max(F.when(slot, rank))["token"].alias("main"), F.collect_list(F.when(F.col("kind") == 2, F.col("token"))).alias("texts")
    )


def main_text(html: str | None, main: int | None, texts: frozenset[int]) -> str:
    """The blocks of the main slot that are neither template text nor marked up as something else, joined by spaces."""
    blocks, opened = read_page(html or "")
    landmarks = {id(e) for e in opened if e.main and not e.other}
    fits = main is not None and any(e.path == main for e in opened)
    inside = []
    for elements, text in blocks:
        if any(e.other for e in elements):
            continue
        if fits:
            chosen = any(e.path == main for e in elements)
        else:
            chosen = not landmarks or any(id(e) in landmarks for e in elements)
        if chosen and _text_token(elements[-1].path, text) not in texts:
            inside.append(text)
    return " ".join(inside)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, frozenset[int]] = {}
    for batch in batches:
        texts = []
        for host, html, main, template in zip(*(batch.column(k) for k in (2, 3, 4, 5)), strict=True):
            name = host.as_py()
            if name not in known:
                if len(known) > 1000:
                    known.clear()
                known[name] = frozenset(t & 0xFFFFFFFFFFFFFFFF for t in template.as_py() or ())
            slot = main.as_py()
            texts.append(main_text(html.as_py(), None if slot is None else slot & 0xFFFFFFFFFFFFFFFF, known[name]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row: the main text of the whole page.

    A null or empty page has an empty text; pages without a host share one template; a null id or url stays null;
    copies of a page on one host count once in its template; each row is read; an empty table gives no rows; other columns are not read.
    """
    stage = Staging(pages.sparkSession)
    read = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    keyed = read.select("*", host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url").alias("key"))
    templates = stage.table(page_templates(_distinct_pages(keyed, stage), stage), "templates")
    joined = keyed.join(templates, "host", "left").select("page_id", "url", "host", "html", "main", "texts")
    return joined.mapInArrow(_text_batches, "page_id bigint, url string, text string, n_chars bigint")
