"""Main text of web pages by consensus host paths.

Every page is parsed into blocks of text and the containers around them. A container's score is the text outside links
of the blocks it holds, in full for their nearest article or main, else the nearest section, div or layout cell, and by
half for the container around that; lists, tables and quotes hand their text on. Its path names tags and classes from the
root, digits generalised. Pages vote per host with the shares of their containers' scores; Spark sums the votes per host
and path, and each page's own paths, those that hold at least half of what its best container holds, are joined with
them. The page's text is what is in the containers of the path with most votes, and of several in their common container.
"""

from __future__ import annotations

import html as entities
import json
import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import slices
from comanda.session import broadcast_if_small, materialise

# Votes are whole numbers, so sums don't depend on the order; a page's votes for all its paths. No path has none.
VOTE = 1 << 30

TOKEN = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/)?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)|[!?/][^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
SPACE = re.compile(r"\s+")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp", "noscript", "template", "svg", "object", "select", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCK = HEADINGS | {
    "html", "head", "body", "main", "article", "section", "div", "p", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption",
    "blockquote", "pre", "figure", "figcaption", "header", "footer", "nav", "aside", "form", "fieldset", "address", "details", "summary", "center", "menu", "dialog", "hgroup", "search",
}
CONTAINER = {"html", "body", "main", "article", "section", "div", "center"}
# A start tag on the left ends an open element on the right, up to the nearest container.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
DROPPED = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "search"}
DROPPED_NAMES = {
    "menu", "nav", "navbar", "navigation", "sidebar", "footer", "masthead", "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notification", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "comment", "comments",
    "disqus", "reply", "replies", "respond", "share", "sharing", "social", "related", "recommended", "recommendations", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "alert",
}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar", "toolbar"}
CONTENT_NAMES = {"content", "article", "post", "entry", "story", "body", "main", "text"}
KEPT = {"html", "body", "main", "article"}
# A class such as has-sidebar, no-ads or comments-open tells the state of what it stands on, not what that is.
STATES = {"has", "have", "no", "not", "non", "with", "without", "is", "show", "hide", "open", "opened", "closed", "enabled", "disabled", "active", "inactive", "on", "off", "allow", "allowed"}


def names_no_text(value: str) -> bool:
    """Whether a class or id value names an element without main text.

    Whole names are judged: of the parts of a name one has to be such a word, none a state, and the last, which says
    what the element is, not a word for content. One name for content among them outweighs the others.
    """
    dropped = False
    for name in value.split():
        parts = [x.lower() for x in NAME_PART.findall(name)]
        if parts and parts[-1] in CONTENT_NAMES:
            return False
        dropped |= bool(DROPPED_NAMES.intersection(parts)) and not STATES.intersection(parts)
    return dropped


class Node:
    """An element. `article` is the nearest article or main from it up, `region` the nearest container, `below` the
    nearest container or cell for what it holds; `first` and `last` bound the blocks it holds."""

    __slots__ = ("tag", "path", "parent", "dropped", "weight", "score", "inline", "depth", "article", "region", "below", "in_header", "first", "last")

    def __init__(self, tag: str, step: str, parent: Node | None, dropped: bool, weight: float, inline: bool) -> None:
        self.tag, self.parent, self.dropped, self.weight, self.inline, self.score = tag, parent, dropped, weight, inline, 0.0
        self.path = f"{parent.path}>{step}" if parent else step
        self.depth = parent.depth + 1 if parent else 0
        self.article = self if tag in ("article", "main") else parent and parent.article
        self.region = self if tag in CONTAINER or not parent else parent.region
        self.below = self if tag in CONTAINER or tag == "td" or not parent else parent.below
        # what a header holds besides headings; a heading in it counts
        self.in_header = tag not in HEADINGS and (tag == "header" or bool(parent and parent.in_header))
        self.first, self.last = -1, -1

    def nearest(self, tag: str) -> Node | None:
        node: Node | None = self
        while node and node.tag != tag:
            node = node.parent
        return node


def describe(tag: str, attrs: str, parent: Node, by_name: bool = True) -> tuple[str, bool, float]:
    """The step of the path, whether the element holds no main text (by its names too, with `by_name`), and the weight of its score."""
    names: list[str] = []
    classes, hidden, role, named = "", False, "", False
    for name, a, b, c, bare in ATTRIBUTE.findall(attrs) if "=" in attrs or "hidden" in attrs else ():
        name, value = name.lower() or bare, a or b or c
        if name == "class":
            classes = ".".join(sorted({re.sub(r"\d+", "#", x) for x in value.lower().split()}))
            names += NAME_PART.findall(value)
            named |= names_no_text(value)
        elif name == "id":
            names += NAME_PART.findall(value)
            named |= names_no_text(value)
        elif name == "role":
            role = value.lower()
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    words = {n.lower() for n in names}
    # a header inside the article may hold its title; only headings count there (see `Page.text`)
    dropped = tag not in KEPT and (hidden or tag in DROPPED or role in DROPPED_ROLES or by_name and named or tag == "header" and not parent.article)
    weight = 1.25 if tag in ("article", "main") else 1.2 if words & CONTENT_NAMES and tag not in ("html", "body") else 1.0
    return f"{tag}.{classes}" if classes else tag, dropped, weight


class Page:
    """Blocks of text in page order, each with the element that holds it."""

    def __init__(self, source: str) -> None:
        for self._by_name in (True, False):  # a page whose names leave nothing is read without them
            self.root = Node("", "", None, False, 1.0, False)
            self.blocks: list[tuple[Node, str]] = []
            self._node, self._text, self._link, self._links = self.root, [], 0, 0
            self._parse(source)
            if self.blocks:
                break
        self._score()

    def _add(self, text: str) -> None:
        if text and not self._node.dropped:
            self._text.append(text)
            if self._link:
                self._links += len(text)

    def _end_block(self) -> None:
        if self._text:
            text = SPACE.sub(" ", entities.unescape("".join(self._text))).strip()
            if text:
                node = self._node
                while node.inline:
                    node = node.parent
                self.blocks.append((node, text))
                # the nearest article or main, else the nearest container; a cell that holds blocks is one, one of bare text is not
                holder = node.article or (node if node.tag in CONTAINER or not node.parent else node.parent.below)
                worth = max(0, len(text) - 2 * self._links)
                holder.score += worth
                if holder.parent:
                    holder.parent.region.score += worth / 2
        self._text, self._links = [], 0

    def _close(self, tag: str) -> None:
        node = self._node
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self._node = node.parent

    def _parse(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            m = TOKEN.search(source, at)
            if not m:
                self._add(source[at:])
                break
            self._add(source[at : m.start()])
            at, tag = m.end(), (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag in BLOCK:
                    self._end_block()
                    self._close(tag)
                    self._link = 0
                elif tag == "a":
                    self._link = 0
                elif self._node.inline and self._node.tag == tag:
                    self._node = self._node.parent
            elif tag in RAW:
                if not m[3].rstrip().endswith("/"):
                    end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?|\\Z", re.I).search(source, at)
                    at = end.end()
            elif tag in VOID:
                if tag == "hr":
                    self._end_block()
                else:
                    self._add(" " if tag == "br" else "")
            elif tag in BLOCK:
                self._start_block(tag, m[3])
            elif tag == "a":
                self._link = 1
            elif m[3] or tag == "button":
                step, dropped, _ = describe(tag, m[3], self._node, self._by_name)
                if dropped:
                    self._node = Node(tag, step, self._node, True, 1.0, True)
        self._end_block()

    def _start_block(self, tag: str, attrs: str) -> None:
        self._end_block()
        self._link = 0
        node = self._node
        while node.parent and (node.inline or node.tag in ("p", *HEADINGS)):  # a block ends open paragraphs and headings
            node = node.parent
            if node.tag in ("p", *HEADINGS):
                continue
        ends = ENDS.get(tag)
        if ends and node.tag in ends:
            node = node.parent
            if tag == "tr" and node.tag in ("tr",):
                node = node.parent
        if tag in ("html", "body") and node.nearest(tag):
            return
        if tag == "body" and node.tag == "head":
            node = node.parent
        step, dropped, weight = describe(tag, attrs, node, self._by_name)
        self._node = Node(tag, step, node, dropped or node.dropped, weight, False)

    def _score(self) -> None:
        """Best score per path; of equal ones the outer path comes first."""
        self.paths: dict[str, float] = {}
        self._nodes: dict[str, list[Node]] = {}
        seen: set[int] = set()
        for i, (node, _) in enumerate(self.blocks):
            while node and id(node) not in seen:
                seen.add(id(node))
                node.first = i
                if node.score > 0:
                    self.paths[node.path] = self.paths.get(node.path, 0.0) + node.score * node.weight
                    self._nodes.setdefault(node.path, []).append(node)
                node = node.parent
        # an element's blocks follow one another, so the last is the last of a block's element that it is above of
        seen.clear()
        for i in range(len(self.blocks) - 1, -1, -1):
            node = self.blocks[i][0]
            while node and id(node) not in seen:
                seen.add(id(node))
                node.last = i
                node = node.parent

    def votes(self) -> dict[str, int]:
        total = sum(self.paths.values())
        return {p: max(1, round(VOTE * s / total)) for p, s in self.paths.items()}

    def _holder(self, path: str) -> Node:
        """The path's container, or the common container of several."""
        nodes = self._nodes[path]
        common = nodes[0]
        for other in nodes[1:]:
            while common is not other:
                if common.depth >= other.depth:
                    common = common.parent
                else:
                    other = other.parent
        return common if len(nodes) == 1 else common.region

    def texts(self) -> list[tuple[str, bool]]:
        """The blocks' texts, and whether they stand beside the headings of a header."""
        return [(text, node.in_header) for node, text in self.blocks]

    def candidates(self) -> list[dict]:
        """path, score, depth and the first and last block of the paths that can hold the main text."""
        best = max(self.paths.values(), default=0.0)
        out = []
        for p, s in self.paths.items():
            if 2 * s >= best:
                holder = self._holder(p)
                out.append({"path": p, "score": s, "depth": p.count(">"), "first": holder.first, "last": holder.last})
        return out


def host(url: str = "url") -> Column:
    """Lower-case host of the address; empty if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def parsed(pages: DataFrame) -> DataFrame:
    """uid, page_id, url, host, blocks (compressed JSON), candidates and votes of every page, as a written table."""
    schema = "page_id long, url string, host string, blocks binary, candidates array<struct<path: string, score: double, depth: int, first: int, last: int>>, votes array<struct<path: string, n: long>>"
    candidates = pa.list_(pa.struct([("path", pa.string()), ("score", pa.float64()), ("depth", pa.int32()), ("first", pa.int32()), ("last", pa.int32())]))
    votes = pa.list_(pa.struct([("path", pa.string()), ("n", pa.int64())]))

    def read(batches):
        for batch in slices(batches):
            got = [Page(source or "") for source in batch.column("html").to_pylist()]
            arrays = {n: batch.column(n) for n in ("page_id", "url", "host")}
            arrays["blocks"] = pa.array([zstandard.compress(json.dumps(x.texts(), ensure_ascii=False).encode()) for x in got], pa.binary())
            arrays["candidates"] = pa.array([x.candidates() for x in got], candidates)
            arrays["votes"] = pa.array([[{"path": p, "n": n} for p, n in x.votes().items()] for x in got], votes)
            yield pa.RecordBatch.from_pydict(arrays)

    asked = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host().alias("host"), "html")
    return materialise(asked.mapInArrow(read, schema).withColumn("uid", F.monotonically_increasing_id()))


def host_paths(read: DataFrame) -> DataFrame:
    """host, path, n: all votes of a host for a path."""
    return materialise(read.select("host", F.explode("votes").alias("v")).groupBy("host", F.col("v.path").alias("path")).agg(F.sum("v.n").alias("n")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, path for every page; text is empty if the page has none, path null.

    A null html is empty, a null or odd url has the empty host. Repeated pages are extracted each; other columns are
    ignored. An empty table gives no rows.
    """
    read = parsed(pages)
    own = read.select("uid", "host", F.posexplode("candidates").alias("i", "c")).select("uid", "host", "i", "c.path", "c.score", "c.depth")
    # a page has few paths; beyond the bound of a broadcast, a hot host's rows are split as a skewed join
    own = own.join(broadcast_if_small(host_paths(read)), ["host", "path"])
    best = own.groupBy("uid").agg(F.min(F.struct((-F.col("n")).alias("n"), (-F.col("score")).alias("score"), "depth", "path", "i")).alias("best")).select("uid", "best.path", "best.i")
    chosen = read.drop("votes", "host").join(best, "uid", "left").select("page_id", "url", "blocks", F.expr("candidates[i].first").alias("first"), F.expr("candidates[i].last").alias("last"), "path")

    def put(batches):
        for batch in slices(batches):
            texts = []
            for packed, first, last in zip(*(batch.column(n).to_pylist() for n in ("blocks", "first", "last")), strict=True):
                blocks = json.loads(zstandard.decompress(packed))
                texts.append("\n\n".join(t for t, beside in blocks[first : last + 1] if not beside) if first is not None else "\n\n".join(t for t, _ in blocks))
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "path": batch.column("path")})

    return chosen.mapInArrow(put, "page_id long, url string, text string, path string")
