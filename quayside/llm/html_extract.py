"""Main text of web pages: markup regions, and repeated passages of the host for what markup does not settle.

1. A page is scanned into text blocks.  Tags, roles and class names mark regions: menus, headers, footers, sidebars, notices,
   adverts, forms, comments (never text of the page), articles (always), and the rest, which markup leaves open.
2. Two kinds of passages are looked for in the token streams of a host's pages outside articles: stretches of ``RUN`` tokens
   or more anywhere, and whole blocks in a row that have ``BLOCK`` tokens or more together.  One that occurs on enough
   distinct pages of the host is boilerplate.
   A stretch of ``RUN`` tokens or more occurs on so many pages exactly where all its windows of ``RUN`` tokens do, so the
   maximal repeats of that length cover the same tokens as the repeated windows; these are counted, and no longest common
   prefixes are needed.  The same holds for whole blocks and the shortest rows of blocks from each block on and up to
   each block.  Suffixes of a batch, wherever it is read, are ranked as far as ``RUN`` tokens (prefix doubling), which
   names its windows; all batches' windows are counted over the host by a grouping, so a passage on pages of different
   batches is found and no host is gathered in one task.
3. On pages without an article, tokens covered by boilerplate are removed and the rest kept.

Text inside an article stays whole, also where other pages repeat it: pages that quote or copy each other keep their text.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import arrow_map, durable

RUN = 20             # tokens of a repeated stretch, at least; block ends count as tokens
BLOCK = 6            # tokens of repeated whole blocks in a row, at least, their ends counted
MIN_PAGES = 3        # distinct page streams of the host that hold a boilerplate passage, at least, however large the host
BATCH_TOKENS = 400_000  # tokens sorted at once

CHROME, OPEN, MAIN, ARTICLE, HEADER = 0, 1, 2, 3, 4  # HEADER: a header inside an article, of which headings count

RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "textarea", "title", "canvas", "audio", "video"}
CHROME_TAGS = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu",
                "menubar", "form", "note"}
CHROME_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion",
    "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "subscription", "signup", "sidebar", "widget", "widgets", "menu", "menus", "nav", "navbar",
    "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "toolbar", "share", "sharing", "social",
    "related", "recommended", "comment", "comments", "disqus", "respond", "replies", "pagination", "pager", "login", "search",
    "disclaimer", "skip"}
# Inside an article only whole class or id tokens count, and not the words that text sections are named by as well.
ARTICLE_CHROME = CHROME_NAMES - {
    "alert", "banner", "comment", "consent", "cookie", "cookies", "disclaimer", "gdpr", "login", "menu", "menus", "modal", "navigation",
    "notification", "overlay", "promotion", "recommended", "related", "replies", "respond", "search", "share", "sharing", "skip",
    "social", "subscription", "toolbar", "widget", "widgets"} | {
    f"{a}{j}{b}" for j in "-_" for a, b in (
        ("ad", "banner"), ("ad", "container"), ("ad", "slot"), ("ad", "unit"), ("ad", "wrapper"), ("alert", "banner"), ("breadcrumb", "nav"), ("comment", "form"),
        ("comment", "list"), ("comments", "area"), ("comments", "section"), ("consent", "banner"), ("cookie", "banner"),
        ("cookie", "bar"), ("cookie", "consent"), ("cookie", "notice"), ("gdpr", "banner"), ("login", "form"), ("nav", "bar"),
        ("nav", "links"), ("nav", "menu"), ("newsletter", "form"), ("newsletter", "signup"), ("popup", "overlay"), ("post", "navigation"), ("recommended", "posts"),
        ("related", "articles"), ("related", "links"), ("related", "posts"), ("search", "bar"), ("search", "box"), ("search", "form"),
        ("share", "bar"), ("share", "buttons"), ("share", "links"), ("side", "bar"), ("skip", "link"), ("social", "buttons"),
        ("social", "links"), ("social", "share"), ("subscribe", "form"), ("site", "footer"), ("site", "nav"), ("site", "navigation"))}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr"}
SECTIONS = {"html", "body", "main", "article", "section", "div", "header", "footer", "nav", "aside", "form", "table", "ul", "ol",
            "dl", "blockquote", "figure", "fieldset", "details"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"'])*+)>|<[!?/][^>]*(?:>|\Z)"""
                  r"""|<[a-zA-Z/!?][^>]*\Z|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAMES = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _kind(tag: str, attrs: str, above: int) -> int:
    """Region of an element from its tag, attributes and the region around it."""
    if above == CHROME or tag in CHROME_TAGS:
        return CHROME
    kind = above
    if above == HEADER and tag in HEADINGS:
        kind = ARTICLE
    elif tag == "header":
        kind = HEADER if above in (ARTICLE, HEADER) else CHROME
    elif tag == "article" and above != HEADER:
        kind = ARTICLE
    elif tag == "main" and above == OPEN:
        kind = MAIN
    if attrs and not attrs.isspace():
        found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTR.findall(attrs)}
        if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
            return CHROME
        role = found.get("role", "")
        if role in CHROME_ROLES:
            return CHROME
        if role == "article" or found.get("itemprop") == "articlebody":
            kind = ARTICLE
        elif role == "main" and above == OPEN:
            kind = MAIN
        if tag not in ("html", "body", "main") and tag not in HEADINGS:
            named = found.get("class", "") + " " + found.get("id", "")
            if above in (ARTICLE, HEADER):
                # "comment" marks code in lines of text, readers' words elsewhere
                names, chrome = set(named.split()), ARTICLE_CHROME if tag in INLINE else ARTICLE_CHROME | {"comment"}
            else:
                names, chrome = set(_NAMES.findall(named)), CHROME_NAMES
            if names & (chrome if tag != "article" else {"comment", "comments", "ad", "advert", "promo", "sponsored"}):
                return CHROME
    return kind


def blocks(source: str) -> list[tuple[int, str]]:
    """``(region, text)`` of the page's blocks in order: references decoded, white space one space, empty ones left out."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []
    kind = OPEN
    at = 0

    def flush() -> None:
        if text:
            joined = " ".join(html_lib.unescape("".join(text)).split())
            if joined:
                out.append((kind if kind != HEADER else CHROME, joined))
            text.clear()

    while True:
        m = _TAG.search(source, at)
        if m is None:
            text.append(source[at:])
            break
        if m.start() > at:
            text.append(source[at:m.start()])
        at = m.end()
        tag = m["name"] or m["name2"]
        if tag is None:
            continue  # a comment, a declaration, or a tag cut off by the end
        tag = tag.lower()
        if m["end"] or m["end2"]:
            if tag not in INLINE:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if (stack[k - 1][1] if k else OPEN) != kind:
                        flush()
                    del stack[k:]
                    break
                if stack[k][0] in SECTIONS and tag not in SECTIONS:
                    break  # a stray end tag does not close the section around it
            kind = stack[-1][1] if stack else OPEN
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            at = close.end() if close else len(source)
            if tag not in ("svg", "math"):
                flush()
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                flush()
            continue
        if (m["attrs"] or m["attrs2"] or "").endswith("/") and tag in INLINE:
            continue
        if tag not in INLINE:
            flush()
            if tag == "body":  # the head ends at the latest here
                stack = [s for s in stack if s[0] not in ("head",)]
            k = len(stack) - 1
            while k >= 0 and stack[k][0] in INLINE:
                k -= 1
            if k >= 0 and (stack[k][0] == "p" or stack[k][0] == tag == "li"):
                del stack[k:]  # a paragraph ends where a block begins, an item where the next does
            kind = stack[-1][1] if stack else OPEN
        own = _kind(tag, m["attrs"] or m["attrs2"] or "", kind)
        if own != kind:
            flush()
        stack.append((tag, own))
        kind = own
    flush()
    return out


class Page:
    """A scanned page: ``settled`` text where an article is marked, else the blocks left open, and the stream in which the
    host's repeats are looked for (blocks outside articles)."""

    def __init__(self, source: str):
        found = blocks(source)
        article = [t for k, t in found if k == ARTICLE]
        self.settled = " ".join(article) if article else None
        self.open: list[str] = []
        if not article:
            main = [t for k, t in found if k == MAIN]
            self.open = main or [t for k, t in found if k == OPEN]
            if not self.open:
                self.settled = ""
        # the open blocks come first: their token positions are those of ``open`` alone
        rest = [t for k, t in found if k != ARTICLE] if article else [t for k, t in found if k != (MAIN if main else OPEN)]
        self.stream = self.open + rest


def host_of(url: str | None) -> str:
    """Host of a URL, lower case; empty without one."""
    if not url or "://" not in url:
        return ""
    return re.split(r"[/?#]", url.split("://", 1)[1], maxsplit=1)[0].lower()


def run_classes(tokens: np.ndarray, run: int) -> np.ndarray:
    """Class of the first ``run`` tokens of every suffix: equal where suffixes agree that far.

    Prefix doubling: suffixes ranked by their first token, then by pairs of ranks 1, 2, 4, ... tokens apart, which is the order
    of the suffix array as far as ``run``; equal ranks are its intervals with a common prefix of ``run`` or more."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < run:
        step = min(have, run - have)
        second = np.zeros(n, np.int64)
        second[:n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + second, return_inverse=True)[1].astype(np.int64)
        have += step
    return rank


def block_rows(ends: list[int], least: int) -> set[tuple[int, int]]:
    """``(begin, end)`` of the shortest rows of whole blocks with ``least`` tokens, from each block on and up to each block.
    ``ends`` has where each block ends, the first beginning at 0; any row of ``least`` tokens is covered by such rows in it."""
    found = set()
    begins = [0, *ends]
    last = 0
    for first, begin in enumerate(begins[:-1]):
        last = max(last, first)
        while last < len(ends) and ends[last] - begin < least:
            last += 1
        if last == len(ends):
            break
        found.add((begin, ends[last]))
    first = 0
    for k, end in enumerate(ends):
        while first < k and end - begins[first + 1] >= least:
            first += 1
        if end - begins[first] >= least:
            found.add((begins[first], end))
    return found


def _host_runs(pages: list[tuple[str, str, Page]], run: int) -> Iterator[tuple[str, int, int, str | None, int, int]]:
    """``(host, passage hash, stream hash, key, position, tokens)`` of each distinct window and row of blocks of each page of a
    batch; ``key`` only for pages whose open blocks await the verdict (then every occurrence in them)."""
    numbers: dict = {}
    tokens: list[int] = []
    words: list[bytes] = []
    bounds = []
    for n, (host, _, page) in enumerate(pages):
        lo = len(tokens)
        ends = []
        for block in page.stream:
            for w in block.split(" "):
                tokens.append(numbers.setdefault((host, w), len(numbers)))
                words.append(w.encode())
            tokens.append(numbers.setdefault((host, None), len(numbers)))
            words.append(b"\n")
            ends.append(len(tokens) - lo)
        bounds.append((lo, len(tokens), sum(b.count(" ") + 2 for b in page.open), ends))
        tokens.append(-1 - n)  # ends the page: no run spans it
        words.append(b"")
    classes = run_classes(np.array(tokens, np.int64), run)
    hashes: dict[int, int] = {}
    for (host, key, page), (lo, hi, open_until, ends) in zip(pages, bounds):
        stream = xxhash.xxh64_intdigest(b" ".join(words[lo:hi])) - (1 << 63)
        seen = set()
        for begin, end in block_rows(ends, BLOCK):
            waits = key is not None and begin < open_until
            digest = xxhash.xxh64_intdigest(b"\n" + b" ".join(words[lo + begin:lo + end])) - (1 << 63)
            if digest in seen and not waits:
                continue
            seen.add(digest)
            yield host, digest, stream, key if waits else None, begin, end - begin
        last = max(lo, hi - run + 1)
        seen = set()
        for at, c in enumerate(classes[lo:last].tolist()):
            waits = key is not None and at < open_until
            if c in seen and not waits:
                continue
            seen.add(c)
            digest = hashes.get(c)
            if digest is None:
                digest = hashes[c] = xxhash.xxh64_intdigest(b" ".join(words[lo + at:lo + at + run])) - (1 << 63)
            yield host, digest, stream, key if waits else None, at, run


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str | None, str, str]]:
    for page_id, url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
        source = source.as_py() or ""
        yield page_id, url, source, host_of(url)


def _key(host: str, source: str) -> str:
    return xxhash.xxh3_128_hexdigest(f"{host}\n{source}".encode())


def boilerplate(pages: DataFrame, run: int = RUN, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(key, covered)``: for pages with open blocks, ``(at, n)`` of the passages of boilerplate that begin in them."""

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, held, size = [], [], 0
        for _, _, source, host in _rows(batch):
            page = Page(source)
            held.append((host, _key(host, source) if page.settled is None else None, page))
            size += sum(b.count(" ") + 2 for b in page.stream)
            if size > BATCH_TOKENS:
                found.extend(_host_runs(held, run))
                held, size = [], 0
        found.extend(_host_runs(held, run) if held else ())
        columns = list(zip(*found)) if found else [()] * 6
        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          names=["host", "run", "stream", "key", "at", "n"])

    runs = durable(arrow_map(pages, scan, "host string, run long, stream long, key string, at int, n int"))
    common = runs.select("host", "run", "stream").distinct().groupBy("host", "run").agg(F.count("*").alias("n")) \
        .where(F.col("n") >= min_pages).select("host", "run")
    return runs.where("key is not null").select("host", "run", "key", "at", "n").distinct().join(common, ["host", "run"]) \
        .groupBy("key").agg(F.collect_set(F.struct("at", "n")).alias("covered"))


def _without(blocks_: list[str], covered: list[dict]) -> tuple[str, int]:
    """Text of blocks without the tokens of the covered passages, and how many tokens went."""
    gone = set()
    for c in covered:
        gone.update(range(c["at"], c["at"] + c["n"]))
    kept, at = [], 0
    for block in blocks_:
        for w in block.split(" "):
            if at not in gone:
                kept.append(w)
            at += 1
        at += 1  # the block's end
    total = at - len(blocks_)
    if not kept:  # nothing unique: the page is a copy, not boilerplate
        return " ".join(blocks_), 0
    return " ".join(kept), total - len(kept)


def extract(pages: DataFrame, run: int = RUN) -> DataFrame:
    """``(page_id, url, text, n_chars, n_removed)`` per row of ``pages (page_id, url, html)``; ``n_removed`` counts tokens
    that the host's repeats showed to be boilerplate.

    Null html is empty text; a null or host-less URL belongs to the host without a name; null ids and repeated rows stay,
    one row out per row in; broken or cut-off markup is read as far as it goes.  Where all of a page's open text repeats, the
    page is a copy and keeps it.  Other columns are ignored; an empty table gives an empty result."""
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for page_id, url, source, host in _rows(batch):
            page = Page(source)
            waits = page.settled is None
            found.append((page_id, url, page.settled, _key(host, source) if waits else None, page.open if waits else None))
        types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)],
                                          names=["page_id", "url", "text", "key", "open"])

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [_without(b, c or []) for b, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([t for t, _ in texts], pa.string()),
                                           pa.array([n for _, n in texts], pa.int64())],
                                          names=["page_id", "url", "text", "n_removed"])

    scanned = arrow_map(rows, scan, "page_id long, url string, text string, key string, open array<string>")
    settled = scanned.where("key is null").select("page_id", "url", "text", F.lit(0).cast("long").alias("n_removed"))
    waiting = scanned.where("key is not null").join(boilerplate(rows, run), "key", "left").select("page_id", "url", "open", "covered")
    decided = arrow_map(waiting, finish, "page_id long, url string, text string, n_removed long")
    return settled.unionByName(decided).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_removed")
