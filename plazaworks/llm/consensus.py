"""Main text of web pages from container paths that the pages of a host agree on."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import rows_of, written

LARGE_HOSTS = 1000  # a host with this part of all pages is a large one
LEAST_SHARE = 0.05  # of a host's votes that a winning path has; so a host has at most 20 of them

TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
CONTAINER = frozenset("html body div main article section table tbody thead tfoot tr td th ul ol dl aside nav header footer form center details figure fieldset".split())
ASIDE_TAGS = frozenset("nav footer aside form menu dialog button select fieldset head".split())
CLOSES_P = CONTAINER | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre hr li dt dd address".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright"
    " disclaimer discussion disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices notification outbrain pager pagination"
    " popup promo promoted recommended related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe subscription"
    " taboola teaser toc toolbar topbar widget widgets".split()
)
HEAD_WORDS = frozenset("header masthead".split())
MOST, NEARLY_ALL = 0.5, 0.8  # of a page's text, links counted against it
SPARSE = 0.1  # share of the text beside a container below which the whole body is not taken


def _words(value: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w]


class Page:
    """Blocks of one page in page order, each with the generalised path of its container.

    A path is the tags of the containers around it, with their class words
    sorted and without digits. Blocks inside menus, forms, comments and the like
    are left out; a header counts as one unless it stands in an article. A class
    or id leaves nothing out if the element holds most of the page's text: more
    than half, or four fifths if a whole name is a listed word ('comments', not
    'with-comments'), and no article or main element with text stands beside it.
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[str, str, int]] = []  # path, text, characters inside links
        self.marked: list[tuple[int, ...]] = []  # of each block, the elements around it with a listed word
        self.plain: list[bool] = []  # of each such element, whether a whole name is a listed word
        self.stack: list[list] = []  # tag, path of the nearest container, left out, elements with a listed word
        self.text: list[str] = []
        self.linked = self.links = 0
        self.path, self.around = "", ()
        self.read(html)
        self.drop_marked()

    def drop_marked(self) -> None:
        weights = [prose(text, linked) for _, text, linked in self.blocks]
        held, total = [0] * len(self.plain), sum(weights)
        semantic = [lifted(path) != path or path.split(">")[-1].split(".")[0] in ("article", "main") for path, _, _ in self.blocks]
        inside, all_semantic = [0] * len(self.plain), sum(w for w, s in zip(weights, semantic, strict=True) if s)
        free = sum(w for w, s, around in zip(weights, semantic, self.marked, strict=True) if s and not around)
        for w, s, around in zip(weights, semantic, self.marked, strict=True):
            for i in around:
                held[i] += w
                inside[i] += w if s else 0
        for share in (NEARLY_ALL, MOST):
            kept = [n > (share if plain else MOST) * total and (own == all_semantic or not free) for n, plain, own in zip(held, self.plain, inside, strict=True)]
            blocks = [b for b, around in zip(self.blocks, self.marked, strict=True) if all(kept[i] for i in around)]
            if blocks:
                break
        self.blocks = blocks

    def read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            m = TAG.search(html, at)
            if not m:
                self.add(html[at:])
                break
            self.add(html[at : m.start()])
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if m[1]:
                    self.close(tag)
                elif tag in RAW:
                    stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
                    at = stop.end() if stop else end if tag in ("script", "style", "textarea", "title") else at
                else:
                    self.open(tag, m[3])
        self.flush()

    def add(self, raw: str) -> None:
        if not raw or self.stack and self.stack[-1][2]:
            return
        raw = unescape(raw)
        if not self.text:
            if raw.isspace():
                return
            self.path, self.around = (self.stack[-1][1], self.stack[-1][3]) if self.stack else ("", ())
        self.text.append(raw)
        if self.links:
            self.linked += len(raw)

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((self.path, text, min(len(text), self.linked)))
            self.marked.append(self.around)
        self.text, self.linked = [], 0

    def pop_to(self, depth: int) -> None:
        for tag, *_ in self.stack[depth:]:
            self.links -= tag == "a"
        del self.stack[depth:]

    def innermost(self, tags, within) -> int | None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                return i
            if self.stack[i][0] in within:
                return None
        return None

    def open(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self.flush()
        if tag in ("br", "hr"):
            self.add(" ")
        if tag in CLOSES_P and (i := self.innermost({"p"}, CONTAINER)) is not None:
            self.pop_to(i)
        if tag in ("li", "dt", "dd", "tr", "td", "th") and (i := self.innermost({"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}, {"ul", "ol", "dl", "table", "tr"} - {tag})) is not None:
            self.pop_to(i)
        if tag in VOID or attributes.endswith("/") and tag not in CONTAINER:
            return
        _, path, out, around = self.stack[-1] if self.stack else ("", "", False, ())
        found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes else {}
        names = _words(found.get("class", ""))
        inside = "article" in path or ">main" in path
        out = out or tag in ASIDE_TAGS or bool({*_words(found.get("role", ""))} & ASIDE_WORDS) and tag not in ("html", "body", "article", "main") or found.get("aria-hidden") == "true"
        out = out or not inside and (tag == "header" or tag not in ("html", "body") and bool({*_words(found.get("role", ""))} & HEAD_WORDS))
        listed = (ASIDE_WORDS if tag not in ("html", "body", "article", "main") else frozenset()) | (HEAD_WORDS if not inside and tag not in ("html", "body") else frozenset())
        if not out and listed & {*names, *_words(found.get("id", ""))}:
            around = (*around, len(self.plain))
            self.plain.append(bool(listed & {*found.get("class", "").lower().split(), found.get("id", "").strip().lower()}))
        if tag in CONTAINER:
            path = f"{path}>{tag}" + "".join(f".{w}" for w in sorted(set(names)))
        self.links += tag == "a"
        self.stack.append([tag, path, out, around])

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if (i := self.innermost({tag}, CONTAINER - {tag} if tag not in CONTAINER else ())) is not None:
            self.pop_to(i)


def lifted(path: str) -> str:
    """The path up to its outermost article, else its main element, else all of it: headings stand beside the body there."""
    parts = path.split(">")
    for tag in ("article", "main"):
        for i, part in enumerate(parts):
            if part.split(".")[0] == tag:
                return ">".join(parts[: i + 1])
    return path


def prose(text: str, linked: int) -> int:
    """Characters of a block, links counted against it."""
    return max(0, len(text) - 2 * linked)


def above(path: str) -> str:
    return path.rpartition(">")[0]


def best(page: Page) -> tuple[str, float] | None:
    """The lowest container that holds most of the page's text, and its prose.

    Text of all blocks below a container counts. From the lowest one with more
    than half it goes on upwards while what is added is not mostly links, so
    headings, introductions and lists beside the longest part stay in; not above
    an article or main element, and to the body only if much stands beside.
    """
    below: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])  # prose, characters, those inside links
    for path, text, linked in page.blocks:
        sums = below[lifted(path)]
        for i, n in enumerate((prose(text, linked), len(text), linked)):
            sums[i] += n
    if not below:
        return None
    own = {path: sums[1] for path, sums in below.items()}
    for path in own:
        while path and (up := above(path)) not in below:
            below[up] = [0, 0, 0]
            path = up
    for path in sorted(below, key=lambda p: -p.count(">")):
        if path:
            up = above(path)
            below[up] = [a + b for a, b in zip(below[up], below[path], strict=True)]
    total = below[""][0]
    if not total:  # nothing but links
        return min(own, key=lambda p: (-own[p], p)), 0.0
    path = max((p for p in below if below[p][0] > MOST * total), key=lambda p: p.count(">"))
    while path and path.rpartition(">")[2].split(".")[0] not in ("article", "main", "body", "html"):
        up = above(path)
        chars, linked = below[up][1] - below[path][1], below[up][2] - below[path][2]
        if 2 * linked > chars or up.rpartition(">")[2].split(".")[0] in ("", "body", "html") and below[up][0] - below[path][0] < SPARSE * total:
            break
        path = up
    return path, float(below[path][0])


def main_text(page: Page, winners: list[str]) -> str:
    """Blocks below the winning path that holds most of the page's text, else below the page's own best one.

    A path that wins the host's vote but holds less than half of what the page's
    own best one does is not where this page keeps its text. Of winners that
    hold as much, the one with more votes is taken.
    """

    def below(path: str) -> list[str]:
        return [t for p, t, _ in page.blocks if p == path or p.startswith(f"{path}>")]

    found = best(page)
    if found is None:
        return ""
    own = below(found[0])
    held = [(sum(map(len, texts)), -i) for i, path in enumerate(winners) if (texts := below(path))]
    if held and 2 * max(held)[0] >= sum(map(len, own)):
        return "\n\n".join(below(winners[-max(held)[1]]))
    return "\n\n".join(own)


def host_of(url: str | None) -> str:
    try:
        return urlsplit(url or "").netloc.lower()
    except ValueError:
        return ""


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        hosts, paths, points = [], [], []
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if (found := best(Page(html or ""))) is not None:
                hosts.append(host_of(url))
                paths.append(found[0])
                points.append(found[1])
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(points, pa.float64())], names=["host", "path", "score"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        texts = [main_text(Page(html or ""), winners or []) for html, winners in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def _hosts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for urls in batches:
        yield urls.map(host_of)


def winning_paths(pages: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, winners, pages): per host the paths with a share of its pages' votes, most votes first, and the pages that voted.

    Each page votes for its best path. Votes are counted per (host, path), so a
    host with most of the pages sends a few rows per task.
    """
    votes = pages.select("url", "html").mapInArrow(_votes, "host string, path string, score double")
    counted = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score"))
    counted = counted.withColumn("all", F.sum("votes").over(W.partitionBy("host"))).where(F.col("votes") >= least_share * F.col("all"))
    paths = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), F.round(-F.col("score"), 3).alias("s"), "path")))["path"]
    return counted.groupBy("host").agg(paths.alias("winners"), F.first("all").alias("pages"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Blocks of the winning path are joined by two line breaks. A page without
    any winning path of its host uses its own best container, one without text
    gives the empty text, and so does a null html. Pages without a host vote
    together. Repeated rows and null ids are pages like any other; a very long
    page is one row throughout.

    A host with a thousandth of all pages or more is one of a thousand at most,
    so the winners of these hosts go to all tasks and their pages are dealt by
    their own hash; the pages of other hosts meet their winners by host.
    """
    winners = written(winning_paths(pages), "winners")
    least = F.coalesce(winners.agg(F.sum("pages")).scalar(), F.lit(0)) / LARGE_HOSTS
    large = winners.where(F.col("pages") >= least).select("host", F.col("winners").alias("known"))
    rows = pages.select("page_id", "url", "html", F.pandas_udf(_hosts, "string")("url").alias("host"))
    rows = rows.join(F.broadcast(large), "host", "left")  # LARGE_HOSTS rows at most
    own = F.concat(F.lit("\0"), F.xxhash64("page_id", "url", "html").cast("string"))  # no host
    rows = rows.withColumn("dealt", F.when(F.col("known").isNull(), F.col("host")).otherwise(own))
    small = winners.where(F.col("pages") < least).select(F.col("host").alias("dealt"), "winners")
    joined = rows.join(small, "dealt", "left").select("page_id", "url", "html", F.coalesce("known", "winners").alias("winners"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
