"""Main text of web pages by the consensus of their host.

Each page scores its containers; scores of generalised tag-class paths are added
up per host in Spark, and every page is extracted again with the path that won
its host.  A page where that path is absent, or holds much less prose than the
page's own best container, falls back on the latter; the whole page is a
container where text stands outside all others.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import column, ship, stored, table

ROOT = ":root"  # path of the whole page, where text stands outside all containers
MOST = 0.5  # share of a page's prose from which parts of a class don't drop an element
MOST_WHOLE = 0.9  # the same of a whole class, as 'ad' or 'comments', where no article or main has text
LEAST_PART = 0.25  # of the own best container's prose that the host's path must hold
VOTES = 3  # containers a page votes for; a page's own text never depends on its votes
CLASSES_IN_PATH = 3  # in order; what is the same up to them counts as one path

# Fixed lists of tags and of words in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe svg textarea title".split())
DROPPED = frozenset(
    "nav header footer aside form button select dialog menu canvas audio video head".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = frozenset("article main section div td body center".split())
CLOSES_P = BLOCKS - {"br", "option"}
WORDS_DROPPED = frozenset(
    "nav navbar navigation menu sidebar footer header masthead ad ads advert adverts advertisement "
    "advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice alert "
    "newsletter subscribe subscription signup social share sharing related recommended comment "
    "comments commentlist disqus reply replies breadcrumb breadcrumbs popup modal overlay widget "
    "login pagination pager toolbar skip hidden complementary contentinfo search paywall".split())
# beside listed words these tell nothing else: 'share-buttons' is dropped inside an article, 'search-methods' is not
WORDS_NEUTRAL = frozenset(
    "area bar block body bottom box button buttons container desktop fixed form global group icon icons "
    "inner item items left link links list mobile outer page panel primary right secondary section side "
    "site slot sticky text title top unit wrap wrapper".split())
# with one of these a class tells what a layout has, not what the element is
MODIFIERS = frozenset("has no not with without open closed enabled disabled is".split())
WORDS_MAIN = frozenset("article content post entry story".split())
BONUS = {"article": 1.6, "main": 1.4}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(
    r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""",
    re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")


_MODULUS = 0xC5A9_37D1_8E4B_60F2_9B1D_73E6_2AF8_54C3  # odd; of the numbers that stand for paths


def _longer(number: int, text: str) -> int:
    """The number of a path with ``text`` added: that of the whole string, whatever its parts."""
    data = text.encode("utf-8", "surrogatepass")
    return ((number << 8 * len(data)) + int.from_bytes(data, "big")) % _MODULUS


@dataclass(slots=True)
class Node:
    tag: str
    step: str
    number: int  # stands for the path, which would take memory with the square of the depth
    depth: int
    dropped: bool
    parent: Node | None
    within: bool = False  # is or stands in an article or main
    hard: bool = False  # dropped for its tag or its state, not for words in its class
    words: frozenset[str] = frozenset()  # the words in its class that drop it
    whole: bool = False  # one of them is all of a class, id or role
    order: int = 0
    prose: int = 0  # characters outside links, of all text that is not dropped hard
    chars: int = 0  # of text that is not dropped, with everything below
    links: int = 0
    bonus: float = 1.0

    def path(self) -> str:
        steps: list[str] = []
        node: Node | None = self
        while node is not None and node.parent is not None:
            steps.append(node.step)
            node = node.parent
        return ">".join(reversed(steps)) or ROOT


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(text)}


def _is_hidden(found: dict[str, str]) -> bool:
    return ("hidden" in found or found.get("aria-hidden") == "true"
            or "display:none" in found.get("style", "").replace(" ", "").lower())


class Page:
    """One pass over the markup: containers with their scores, and blocks below wanted paths."""

    def __init__(self, source: str, wanted: str | None = None, spared: frozenset[int] = frozenset()):
        self.nodes: list[Node] = []
        self.text: list[str] = []  # blocks below the wanted path, in page order
        self.matched = False
        self._wanted = None if wanted is None else _longer(0, wanted)
        self._inside = 0  # open elements of the wanted path
        self._block: list[str] = []
        self._spared = spared  # elements, by order, that words in their class don't drop
        self._order = 0
        self.by_words: list[Node] = []
        root = self.root = Node("", "", 0, -1, False, None)
        self._open_at: dict[str, list[int]] = {}  # places on the stack of open elements, by tag
        self._blocks_at: list[int] = []
        if wanted == ROOT:
            self.matched, self._inside = True, 1
        self._stack = [root]
        self._links = 0
        at = 0
        for m in TAG.finditer(source):
            if m.start() < at:
                continue  # inside a raw element
            if m.start() > at:
                self._add(source[at:m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._close(name)
            else:
                rest = m[3] if m[2] else m[6]
                self._open(name, rest or "")
                if name in RAW and not (rest or "").endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(
                        source, at)
                    at = end.end() if end else len(source)
        if at < len(source):
            self._add(source[at:])
        while len(self._stack) > 1:
            self._pop()
        self._flush()

    def _flush(self) -> None:
        if self._block:
            joined = " ".join("".join(self._block).split())
            if joined:
                self.text.append(joined)
            self._block = []

    def _add(self, raw: str) -> None:
        top = self._stack[-1]
        if top.hard:
            return
        words = html.unescape(raw) if "&" in raw else raw
        if not self._links and not words.isspace():
            top.prose += len(words)
        if top.dropped:
            return
        if self._inside:
            self._block.append(words)
        if self._wanted is None:
            n = len(words) if not words.isspace() else 0
            top.chars += n
            if self._links:
                top.links += n

    def _open(self, name: str, attributes: str) -> None:
        if name in RAW:
            return
        if name in BLOCKS:
            if name in CLOSES_P:
                self._end_paragraph()
            if name in ("li", "tr", "td", "th", "dt", "dd", "option"):
                self._end_sibling(name)
            if self._inside:
                self._flush()
        if name in VOID:
            return
        parent = self._stack[-1]
        found = _attributes(attributes) if attributes.strip() else {}
        label = " ".join((found.get("class", ""), found.get("id", ""), found.get("role", "")))
        tokens = [set(WORD.findall(token)) for token in label.lower().split()]
        words = set().union(*tokens)
        within = parent.within or name in BONUS
        self._order += 1
        hard = parent.hard or name in DROPPED or _is_hidden(found)
        telling: frozenset[str] = frozenset()
        if name in ("html", "body"):
            hard = False
        elif name not in ("article", "main") and self._order not in self._spared:
            # inside an article only classes that say nothing else
            telling = WORDS_DROPPED & set().union(*[
                t for t in tokens if not t & MODIFIERS
                and (not within or t <= WORDS_DROPPED | WORDS_NEUTRAL)])
        dropped = hard or bool(telling) or parent.dropped and name not in ("html", "body")
        classes = sorted(DIGITS.sub("#", c) for c in found.get("class", "").lower().split())
        step = ".".join([name, *classes[:CLASSES_IN_PATH]])
        node = Node(name, step, _longer(parent.number, f">{step}" if parent.parent else step), parent.depth + 1,
                    dropped, parent, within, hard, telling,
                    not telling.isdisjoint(label.lower().split()), self._order)
        node.bonus = BONUS.get(name, 1.3 if words & WORDS_MAIN else 1.0)
        self._open_at.setdefault(name, []).append(len(self._stack))
        if name in BLOCKS:
            self._blocks_at.append(len(self._stack))
        self._stack.append(node)
        if name == "a":
            self._links += 1
        if self._wanted is not None and not dropped and node.number == self._wanted:
            self.matched = True
            self._inside += 1
        if name in CONTAINERS and not dropped:
            self.nodes.append(node)

    def _pop(self) -> None:
        node = self._stack.pop()
        self._open_at[node.tag].pop()
        if node.tag in BLOCKS:
            self._blocks_at.pop()
            if self._inside:
                self._flush()
        if node.tag == "a":
            self._links -= 1
        if self._wanted is not None and not node.dropped and node.number == self._wanted:
            self._inside -= 1
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.links += node.links
            node.parent.prose += node.prose
        if node.words and not node.hard:
            self.by_words.append(node)

    def _last(self, *tags: str) -> int:
        """The highest place on the stack of an element with one of these tags; 0 for none."""
        return max((at[-1] for tag in tags if (at := self._open_at.get(tag))), default=0)

    def _pop_to(self, place: int) -> None:
        while len(self._stack) > place:
            self._pop()

    def _end_paragraph(self) -> None:
        """A block ends an open paragraph, and inline tags left open in it."""
        if self._blocks_at and self._stack[self._blocks_at[-1]].tag == "p":
            self._pop_to(self._blocks_at[-1])

    def _end_sibling(self, name: str) -> None:
        same = {"td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(
            name, (name,))
        place = self._last(*same)
        if place and place >= self._last(
                "ul", "ol", "table", "tbody", "thead", "tr", "dl", "select", "body", "div"):
            self._pop_to(place)

    def _close(self, name: str) -> None:
        if name in VOID or name in RAW:
            if name == "br" and self._inside:
                self._flush()
            return
        place = self._last(name)
        if place:
            # an inline end tag does not close a block it was not opened in
            if name in BLOCKS or not self._blocks_at or self._blocks_at[-1] < place:
                self._pop_to(place)
        elif name in BLOCKS and self._inside:
            self._flush()

    def scores(self) -> list[tuple[str, float]]:
        """The best containers' paths: text kept, less links, in favour of the tightest."""
        best: dict[int, float] = {}
        first: dict[int, Node] = {}
        whole = self.root.chars
        if not whole:
            return []
        nodes = self.nodes
        if max((n.chars for n in nodes), default=0) < whole:
            nodes = [*nodes, self.root]
        for n in nodes:
            if n.chars > 0:
                # of containers that hold the same text the deeper is better
                prose = n.chars * max((1 - n.links / n.chars) ** 2, 0.001)
                best[n.number] = best.get(n.number, 0.0) + prose / whole * n.bonus * (1 + 0.01 * max(n.depth, 0))
                first.setdefault(n.number, n)
        if not best:
            return []
        # only what can be among the first is spelt out
        least = sorted(best.values(), reverse=True)[:VOTES][-1]
        named = [(first[k].path(), score) for k, score in best.items() if score >= least]
        return sorted(named, key=lambda x: (-x[1], x[0]))[:VOTES]

    def prose_of(self, path: str) -> int:
        """Characters of kept text outside links below a path."""
        number = _longer(0, path)
        nodes = [self.root] if path == ROOT else [n for n in self.nodes if n.number == number]
        return sum(n.chars - n.links for n in nodes)


def parsed(source: str) -> tuple[Page, frozenset[int]]:
    """The page with its scores, and the elements spared because they hold most of its prose."""
    page = Page(source)
    spared: frozenset[int] = frozenset()
    sure = any(n.tag in BONUS and n.chars for n in page.nodes)
    while more := {n.order for n in page.by_words if not (n.whole and sure) and n.prose > (
            page.root.prose * (MOST_WHOLE if n.whole else MOST))} - spared:
        spared |= more
        page = Page(source, None, spared)
    return page, spared


def main_text(source: str | None, path: str | None) -> tuple[str, str | None]:
    """The text below the host's path, or below the page's own best container, and the path used.

    The page's own container is taken where the host's path holds much less prose.
    """
    if not source:
        return "", None
    page, spared = parsed(source)
    own = page.scores()
    if not own:
        return "", None
    best = own[0][0]
    if path is not None and page.prose_of(path) >= LEAST_PART * page.prose_of(best):
        wanted = Page(source, path, spared)
        if wanted.matched and wanted.text:
            return "\n".join(wanted.text), path
    return "\n".join(Page(source, best, spared).text), best


def host_of(pages: DataFrame):
    url = F.coalesce(column(pages, "url", "string"), F.lit(""))
    return F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the container path that most of a host's pages speak for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores = [], [], []
            for host, source in zip(batch.column(0), batch.column(1)):
                for path, score in parsed(source.as_py() or "")[0].scores():
                    hosts.append(host.as_py())
                    paths.append(path)
                    scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                 pa.array(scores, pa.float64())], ["host", "path", "score"])

    votes = pages.select(host_of(pages).alias("host"), column(pages, "html", "string")
                         .alias("html")).mapInArrow(run, "host string, path string, score double")
    # hundredths as whole numbers, so that the sum does not depend on the order of adding
    sums = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("score") * 100).cast("long"))
                                             .alias("score"))
    return sums.groupBy("host").agg(
        F.max(F.struct("score", F.col("path"))).alias("best")).select("host", F.col("best.path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, path of every row of ``pages``.

    A NULL or empty page, or one without text that is kept, gives an empty text.  A NULL
    url counts as one nameless host.  Repeated rows give a row each; other columns are
    ignored; an empty table gives no row.  Time and memory of a page are in proportion to
    its length, however deep its elements and however many end tags match none.
    """
    ship(pages.sparkSession)
    known = stored(host_paths(pages))
    rows = pages.select(
        column(pages, "page_id", "long").alias("page_id"), column(pages, "url", "string").alias("url"),
        column(pages, "html", "string").alias("html"), host_of(pages).alias("host"),
    ).join(known, "host", "left").select("page_id", "url", "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, paths = [], []
            for source, path in zip(batch.column(2), batch.column(3)):
                text, used = main_text(source.as_py(), path.as_py())
                texts.append(text)
                paths.append(used)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(paths, pa.string())], ["page_id", "url", "text", "path"])

    return rows.mapInArrow(run, "page_id long, url string, text string, path string")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of ``pages``."""
    return extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")
