"""Main text of web pages by consensus of their host.

Every page proposes containers: elements that may hold an article, named by their
generalised tag-class path (tags from the root, classes with digits replaced). They are
scored by the text in their blocks, less link text. From the best one a page climbs to
the lowest container that holds what its siblings add to it (a heading, a lead, further
parts). In Spark the pages of a host vote: scores and pages are summed per path, and one
path wins. Each page is then read again, and its text is taken from the containers on
the winning path; a page where that gives less than ``ENOUGH`` of the unlinked text of
its own choice falls back on the latter.

Siblings within body itself, or beside an article or main, are the page's frame as often
as its text: they count with a first heading among them, and, beside no article or main,
also with a tenth of the text.

Blocks are what block-level tags and line breaks separate. Menus, headers, footers,
sidebars, notices, adverts, forms, comments of readers, scripts and styles are left
out wherever they stand, by tag, role or class. Unclosed and unopened tags, bare angle
brackets and cut-off pages are read as far as they go.

Defined results: null or empty html, and pages without text, give an empty text; pages
with a null or odd url form one host; ties go to the smaller path; repeated pages vote
each; an empty table gives none. Within a page paths are compared step by step. A heading
in a header element goes with it, in an article, too. Time grows with the length of a
page, not with its depth.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavecount.llm.common import slices
from wavecount.session import materialise

#: Winning paths are broadcast up to this many hosts; beyond, pages are joined with them in a shuffle.
BROADCAST_HOSTS = 200_000
#: Spread of a host's pages in that shuffle.
SALTS = 32
#: Least share of the unlinked text of a page's own choice that the winning path must give.
ENOUGH = 0.75

_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>])*?)(?:(/?)>|$)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "canvas", "object", "select"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that are kept on the stack; of the others only the block border is seen.
_NESTED = {"html", "body", "main", "article", "section", "div", "td", "table", "tr", "tbody", "ul", "ol", "dl", "nav", "header",
           "footer", "aside", "form", "dialog", "menu", "fieldset", "button", "figure", "blockquote", "details", "center"}
_BLOCKS = _NESTED | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "br", "hr", "th", "caption",
                     "figcaption", "address", "summary", "head"}
_CONTAINERS = {"main", "article", "section", "div", "td", "body"}
_DROPPED = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "fieldset", "button"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
          "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "newsletter",
          "subscribe", "signup", "login", "sidebar", "side", "aside", "widget", "menu", "nav", "navbar", "navigation", "breadcrumb",
          "breadcrumbs", "header", "masthead", "footer", "copyright", "comment", "comments", "reply", "replies", "respond", "disqus",
          "share", "sharing", "social", "related", "recommended", "pagination", "pager", "toolbar", "tags"}
_PREFER = {"article": 3.0, "main": 2.0}


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _unwanted(tag: str, own: dict[str, str]) -> bool:
    if tag in _DROPPED or own.get("role", "").lower() in _ROLES or "hidden" in own or own.get("aria-hidden") == "true":
        return True
    if tag in ("html", "body", "article", "main"):
        return False if tag != "article" else _named(own, {"comment", "comments", "reply", "ad", "ads", "related"})
    return bool(own) and _named(own, _WORDS)


def _named(own: dict[str, str], words: set[str]) -> bool:
    named = f"{own.get('class', '')} {own.get('id', '')}".lower()
    return any(w in words for w in re.split(r"[^a-z]+", named))


def _step(tag: str, own: dict[str, str]) -> str:
    classes = sorted({re.sub(r"\d+|>", "#", c.lower()) for c in own.get("class", "").split()})
    return ".".join([tag, *classes])


class _Page:
    """Blocks of wanted text, each at the node of its element.

    Nodes are tag-class paths, numbered from the root down, so a parent's number is
    smaller than its children's; elements with one path share a node. All sums over the
    blocks below a node are made in one pass, whatever the depth.
    """

    def __init__(self, source: str):
        self.parents: list[int] = []
        self.steps: list[str] = []
        self.tags: list[str] = []
        self.container: list[bool] = []  # some element with the path may hold the article
        self.depth: list[int] = []
        self.within: list[int] = []  # depth of the nearest article or main, itself included, or -1
        self.children: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int]] = []  # node or -1, text, characters of links
        self.stack: list[tuple[str, int, bool]] = []  # tag, node, dropped
        self.opened: Counter[str] = Counter()  # tags on the stack
        self.buffer: list[str] = []
        self.headings: set[int] = set()  # blocks that are first headings
        self.links = self.depth_a = 0
        self.heading = False
        self._read(source)
        self._sum_up()

    def _node(self, parent: int, tag: str, step: str) -> int:
        node = self.children.get((parent, step))
        if node is None:
            node = self.children[parent, step] = len(self.parents)
            depth = self.depth[parent] + 1 if parent >= 0 else 0
            self.parents.append(parent)
            self.steps.append(step)
            self.tags.append(tag)
            self.container.append(False)
            self.depth.append(depth)
            self.within.append(depth if tag in _PREFER else self.within[parent] if parent >= 0 else -1)
        return node

    def _flush(self) -> None:
        if self.buffer:
            text = " ".join(html.unescape("".join(self.buffer)).split())
            if text:
                if self.heading:
                    self.headings.add(len(self.blocks))
                self.blocks.append((self.stack[-1][1] if self.stack else -1, text, min(self.links, len(text))))
            self.buffer, self.links = [], 0

    def _text(self, part: str) -> None:
        if part and not (self.stack and self.stack[-1][2]):
            self.buffer.append(part)
            if self.depth_a:
                self.links += len(part)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            m = _MARKUP.search(source, at)
            if m is None:
                self._text(source[at:])
                break
            self._text(source[at : m.start()])
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    self._text(html.escape(m[0][9:].removesuffix("]]>")))
                continue
            if m[1]:
                self._close(tag)
            else:
                at = self._open(tag, m[3] or "", bool(m[4]), source, at)
        self._flush()

    def _open(self, tag: str, raw: str, closed: bool, source: str, at: int) -> int:
        if tag in _RAW:
            if not closed:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source)
            return at
        if tag in _BLOCKS:
            self._flush()
            self.depth_a = 0
            self.heading = tag == "h1" or self.heading and tag in ("br", "hr")
        elif tag == "a":
            self.depth_a = 1
        if tag in _NESTED and tag not in _VOID and not closed:
            own = _attributes(raw)
            _, parent, dropped = self.stack[-1] if self.stack else ("", -1, False)
            node, dropped = self._node(parent, tag, _step(tag, own)), dropped or _unwanted(tag, own)
            if tag in _CONTAINERS and not dropped:
                self.container[node] = True
            self.stack.append((tag, node, dropped))
            self.opened[tag] += 1
        return at

    def _close(self, tag: str) -> None:
        if tag in _BLOCKS:
            self._flush()
            self.heading = False
        elif tag == "a":
            self.depth_a = 0
        while self.opened[tag]:
            last = self.stack.pop()[0]
            self.opened[last] -= 1
            if last == tag:
                break

    def _sum_up(self) -> None:
        """Sums over the blocks at and below each node: worth, unlinked characters, first headings.

        A block counts in full for its innermost container and for half as much with
        each one further out, so a wrapper never beats what it wraps; text in links
        counts against.
        """
        n = len(self.parents)
        self.worth, self.unlinked, self.headed = [0.0] * n, [0] * n, [0] * n
        for k, (node, text, links) in enumerate(self.blocks):
            if node >= 0:
                self.worth[node] += len(text) - 2.0 * links
                self.unlinked[node] += max(0, len(text) - 2 * links)
                self.headed[node] += k in self.headings
        for node in range(n - 1, -1, -1):
            parent = self.parents[node]
            if parent >= 0:
                self.worth[parent] += self.worth[node] * (0.5 if self.container[node] else 1.0)
                self.unlinked[parent] += self.unlinked[node]
                self.headed[parent] += self.headed[node]

    def scores(self) -> dict[int, float]:
        """Score of each container's path by its node, where it is above zero."""
        scored = {n: self.worth[n] * _PREFER.get(self.tags[n], 1.0) for n, known in enumerate(self.container) if known}
        return {n: s for n, s in scored.items() if s > 0}

    def keys(self) -> list[bytes]:
        """A digest of every node's path, made from that of its parent."""
        out: list[bytes] = []
        for parent, step in zip(self.parents, self.steps, strict=True):
            out.append(blake2b((out[parent] if parent >= 0 else b"") + step.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        return out

    def path(self, node: int) -> str:
        steps = []
        while node >= 0:
            steps.append(self.steps[node])
            node = self.parents[node]
        return ">".join(reversed(steps))

    def at(self, path: str | None) -> int | None:
        """The container on the path, if the page has it."""
        node = -1
        for step in path.split(">") if path is not None else ():
            node = self.children.get((node, step), -2)
            if node < 0:
                return None
        return node if node >= 0 and self.container[node] else None

    def _first(self, wanted: set[int]) -> int:
        """The one with the smallest path, compared step by step."""
        below: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for (parent, step), node in self.children.items():
            below[parent].append((step, node))
        ahead = [-1]
        while ahead:
            node = ahead.pop()
            if node in wanted:
                return node
            ahead += [child for _, child in sorted(below[node], reverse=True)]
        raise KeyError("no such node")

    def choice(self, own: dict[int, float]) -> int | None:
        """The lowest container that holds the best one and what its siblings add to it."""
        if not own:
            return None
        best = max(own.values())
        tied = {n for n, s in own.items() if s == best}
        chosen = above = tied.pop() if len(tied) == 1 else self._first(tied)
        while (above := self.parents[above]) >= 0:
            if not self.container[above]:
                continue
            gain, heading = self.unlinked[above] - self.unlinked[chosen], self.headed[above] > self.headed[chosen]
            if self.depth[above] < self.within[chosen]:
                accepted = heading
            elif self.tags[above] == "body":
                accepted = heading or gain * 10 >= self.unlinked[chosen]
            else:
                accepted = True
            if gain and accepted:
                chosen = above
        return chosen

    def _below(self, top: int) -> str:
        """The blocks at and below a node, in page order."""
        inside = [False] * top + [True]
        for node in range(top + 1, len(self.parents)):
            parent = self.parents[node]
            inside.append(parent >= 0 and inside[parent])
        return " ".join(t for n, t, _ in self.blocks if n >= 0 and inside[n])

    def text(self, path: str | None) -> str:
        """Blocks in the containers on the path, in page order; where they are too little, in those of the page's own choice."""
        own, won = self.choice(self.scores()), self.at(path)
        if own is None and won is None:
            return " ".join(t for _, t, _ in self.blocks)
        if own is not None and (won is None or self.unlinked[won] < ENOUGH * self.unlinked[own]):
            return self._below(own)
        return self._below(won)


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _rows(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.col("url").alias("url"), _host(F.col("url")).alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))


def votes(pages: DataFrame) -> DataFrame:
    """Per host and path: pages for which the path is best, and the sum of scores; summed before the shuffle.

    Paths go by a digest; only those that are best of a page are written out.
    """
    def proposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sums: dict[tuple[str, bytes], list] = defaultdict(lambda: [0, 0.0, None])
            for host, source in zip(part["host"].to_pylist(), part["html"].to_pylist(), strict=True):
                page = _Page(source)
                own = page.scores()
                if not own:
                    continue
                keys, best = page.keys(), page.choice(own)
                for node, score in own.items():
                    sums[host, keys[node]][1] += score
                vote = sums[host, keys[best]]
                vote[0], vote[2] = vote[0] + 1, vote[2] or page.path(best)
            yield pa.RecordBatch.from_arrays([
                pa.array([h for h, _ in sums], pa.string()), pa.array([k for _, k in sums], pa.binary()),
                pa.array([p for *_, p in sums.values()], pa.string()), pa.array([n for n, *_ in sums.values()], pa.int64()),
                pa.array([round(s) for _, s, _ in sums.values()], pa.int64()),
            ], names=["host", "key", "path", "best_of", "score"])

    rows = _rows(pages).select("host", "html").mapInArrow(
        proposed, "host string, key binary, path string, best_of long, score long")
    return rows.groupBy("host", "key").agg(
        F.max("path").alias("path"), F.sum("best_of").alias("best_of"), F.sum("score").alias("score")).where("best_of > 0")


def winners(voted: DataFrame) -> DataFrame:
    """One path per host: best of most pages, then the larger score, then the smaller path."""
    order = Window.partitionBy("host").orderBy(F.desc("best_of"), F.desc("score"), "path")
    return voted.withColumn("place", F.row_number().over(order)).where("place = 1").select("host", "path")


def extract(pages: DataFrame, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """page_id, url and text of every page, by the paths that its host has chosen."""
    won = materialise(winners(votes(pages)), "host-paths")
    rows = _rows(pages)
    if won.count() <= broadcast_hosts:
        joined = rows.join(F.broadcast(won), "host", "left")
    else:  # a large host is dealt to many tasks
        salts = F.explode(F.array(*map(F.lit, range(SALTS))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(
            won.withColumn("salt", salts), ["host", "salt"], "left")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = [_Page(h).text(p) for h, p in zip(part["html"].to_pylist(), part["path"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(values, pa.string()),
                                              pa.array(map(len, values), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "path").mapInArrow(
        extracted, "page_id long, url string, text string, n_chars long")
