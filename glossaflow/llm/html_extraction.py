"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of styles: a node is a place in the page, named by its chain of tags
with their classes, and counts on how many pages it stands, in which layouts (sequences of children), and with
which contents. Layouts and contents give the node an importance by entropy: contents that come back on many pages
of the host inform little (for a text that c of m pages have at this place: 1 - log c / log m, averaged over the
place's texts), and so do layouts that never vary (entropy to the base m). A node of low importance in both is
template, and its branch is left out of every page of the host. Copies of a page (equal markup on a host) count as one
page, each with its share of it. Places seen on fewer than ``LEAST_PAGES`` different pages say nothing and stay.

What the markup itself declares is decided first: navigation, footers, page headers, asides, forms, scripts,
styles, and elements whose class, id or role names an advert, a notice, a menu, a sidebar or comments are no main
text; if a page has an ``article`` or ``main`` element, text outside of it is none either. Where the tree would take
more than ``MOST_OF_MAIN`` of the characters that a page declares as main text, as it does among near copies of an
article, the page keeps what it declares. Names count as whole words (``sidebar``, ``ad``) or as known compounds of them
(``main-menu``, ``share-buttons``), never on ``html``, ``body``, ``main`` or ``article``, and not at all on a page of
which they would leave nothing. The name of a wrapper does not reach into a ``main`` it holds, nor into an ``article`` if
the page declares no other main text and the article is longer than what stands outside; comments stay comments.

Two passes parse the pages, after one that counts digests of them; between them only counts per host, place and content
are moved, combined per task. The tables of repeated digests and of places to leave out are joined by host (sent to all
executors if measured to be small).

Results: null and empty pages give an empty text. White space within a block becomes one blank, blocks are joined
in page order by a newline. Unclosed and misnested tags are closed as their neighbours demand, a tag cut off by the end of
the page is markup; time and memory grow with the length of a page, however deep it nests. Hosts are taken from
the url, pages without one form a host of their own. Repeated rows are extracted each.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaflow.llm.common import broadcast_if_small, map_batches, quoted
from glossaflow.scratch import scratch_folder, stage

LEAST_PAGES = 8
LEAST_IMPORTANCE = 0.25
MOST_OF_MAIN = 0.5

# Elements of HTML by what they do to the text around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset("""
html body main article section header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody
tfoot tr td th caption blockquote pre figure figcaption form fieldset address details summary hgroup hr dialog menu
""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
KEEPS_APART = frozenset("ul ol dl table article section div main body html blockquote td th".split())
NO_TEXT = frozenset("""
head script style noscript template nav footer aside form button select option textarea label dialog menu iframe
svg canvas object video audio map
""".split())
# Names of what is no main text: a whole class or id word, or one between a place it stands at and a kind of box.
_NAME = (
    r"(?:ads?|advert(?:s|isements?|ising)?|sponsor(?:ed|s)?|promos?|promotions?|banners?|cookies?|consent|gdpr|"
    r"notices?|alerts?|popups?|modal|newsletter|subscri(?:be|ption)|menus?|nav|navbar|navigation|breadcrumbs?|"
    r"side-?bars?|footers?|share|sharing|social|related|recommend(?:ed|ations)|comments?|comment-?list|respond|"
    r"replies|widgets?|log-?in|sign-?up|search|pagination|pager|tags|skip)"
)
_AT = r"(?:site|page|main|global|top|bottom|left|right|primary|secondary|mobile|sticky|google|entry|post|article)"
_BOX = (
    r"(?:box|bar|bars|wrap|wrapper|container|panel|widgets?|links?|buttons?|icons?|form|list|slot|unit|banner|notice|"
    r"popup|overlay|menu|nav|posts|articles|left|right|top|bottom)"
)
NO_TEXT_NAMES = re.compile(rf"^(?:{_AT}[-_]+)?{_NAME}(?:[-_]+{_BOX})?$", re.I)
# Elements that hold the page or its main text whatever their names say.
NEVER_BY_NAME = frozenset("html body main article".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
# What is left of a tag that never ends, or whose quotes do not match.
_CUT_OFF = re.compile(r"<(?:/?[a-zA-Z]|[!?])[^>]*>?")
_COMMENTS = re.compile(r"comment|respond|replies", re.I)
_DIGITS = re.compile(r"\d+")
_SPACE = re.compile(r"\s+")


# Ranks of text: undeclared, in an article below a named wrapper, in an article or main element.
PLAIN, WRAPPED, DECLARED = range(3)


@dataclass(slots=True)
class Node:
    """An open element. ``place`` and ``parent`` are codes of its place and of the one around it; ``silent``: text in it is
    none by its elements; ``named``: by the names of a wrapper (2: of comments); ``inside``: an article or main is around."""

    tag: str
    place: int
    parent: int
    silent: bool = False
    named: int = 0
    inside: bool = False
    rank: int = PLAIN
    block: Node | None = None
    children: list[str] | None = None


@dataclass
class Page:
    """Blocks of text ``(place, parent, text, rank)`` in page order, and layouts ``(place, children)`` as codes."""

    blocks: list[tuple[int, int, str, int]] = field(default_factory=list)
    layouts: list[tuple[int, int]] = field(default_factory=list)

    def main_rank(self) -> int:
        sizes = [0, 0, 0]
        for _, _, text, rank in self.blocks:
            sizes[rank] += len(text)
        return DECLARED if sizes[DECLARED] else WRAPPED if sizes[WRAPPED] > sizes[PLAIN] else PLAIN

    def declared(self) -> list[tuple[int, int, str]]:
        """``(place, parent, text)`` of what the page itself declares as its main text."""
        wanted = self.main_rank()
        return [(place, parent, text) for place, parent, text, rank in self.blocks if rank == wanted]

    def texts(self, dropped: frozenset[int] = frozenset()) -> list[str]:
        declared = self.declared()
        if dropped:
            left = [text for place, _, text in declared if place not in dropped]
            if self.main_rank() == PLAIN or sum(map(len, left)) >= (1 - MOST_OF_MAIN) * sum(len(t) for *_, t in declared):
                return left
        return [text for *_, text in declared]


def code(value: str) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(value)).astype(np.int64))


def _open(tag: str, attributes: str, parent: Node, by_name: bool) -> Node:
    """An element below ``parent``; ``by_name``: whether its class and id may declare it to be no text."""
    by_name = by_name and tag not in NEVER_BY_NAME
    names, silent = "", parent.silent or tag in NO_TEXT or (tag == "header" and not parent.inside)
    named, kind = parent.named, tag if tag in ("article", "main") else ""
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = next((v for v in values if v), "")
            name = name.lower()
            if name in ("class", "id"):
                words = value.split()
                if by_name:
                    found = [w for w in words if NO_TEXT_NAMES.search(w)]
                    named = max(named, 2 if any(map(_COMMENTS.search, found)) else 1 if found else 0)
                names += "".join(f".{w}" for w in sorted(_DIGITS.sub("", w) for w in words))
            elif name == "role":
                silent = silent or value.lower() in NO_TEXT_ROLES
                kind = kind or (value.lower() if value.lower() in ("main", "article") else "")
            elif name == "style":
                silent = silent or "display:none" in value.replace(" ", "").lower()
            else:
                silent = silent or name == "hidden" or value.lower() == "true"
    rank = parent.rank
    if kind and not parent.inside:
        # the first article or main on the way down: names of wrappers around it end here
        rank = WRAPPED if named and kind == "article" else DECLARED
        named = 0 if kind == "main" or named < 2 else named
    node = Node(tag, code(f"{parent.place}/{tag}{names}"), parent.place, silent, named, parent.inside or bool(kind), rank)
    node.block = node if tag in BLOCK else parent.block
    return node


def parse(source: str | None) -> Page:
    """The blocks and layouts of a page; names of elements are not asked if they would leave nothing of it."""
    page = _parse(source, True)
    return page if page.blocks or not source else _parse(source, False)


def _parse(source: str | None, by_name: bool) -> Page:
    page, root = Page(), Node("", 0, 0)
    if not source:
        return page
    root.block = root
    stack, words, at, owner = [root], [], 0, root
    places: dict[str, list[int]] = {}  # where in the stack elements of a tag are open

    def flush() -> None:
        nonlocal words
        text = _SPACE.sub(" ", html.unescape("".join(words))).strip()
        words = []
        if text:
            page.blocks.append((owner.place, owner.parent, text, owner.rank))

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            places[node.tag].pop()
            page.layouts.append((node.place, code(",".join(node.children or ()))))

    def innermost(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    while True:
        found = _TOKEN.search(source, at)
        if not (stack[-1].silent or stack[-1].named) and (text := source[at : found.start() if found else len(source)]):
            words.append(_CUT_OFF.sub("", text) if "<" in text else text)
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in BLOCK:
                flush()
            if depth := innermost((tag,)):
                close(depth)
            owner = stack[-1].block
            continue
        if tag == "br":
            words.append(" ")
            continue
        if tag in BLOCK or tag in CLOSES:
            flush()
            depth = innermost(CLOSES.get(tag, set()) | ({"p"} if tag in BLOCK else set()))
            if depth and depth >= innermost(KEEPS_APART):
                close(depth)
        if stack[-1].children is None:
            stack[-1].children = []
        stack[-1].children.append(tag)
        if tag in VOID:
            owner = stack[-1].block
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if found[3].endswith("/") and tag not in BLOCK:
            continue
        places.setdefault(tag, []).append(len(stack))
        stack.append(_open(tag, found[3], stack[-1], by_name))
        owner = stack[-1].block
    flush()
    close(1)
    return page


def _host() -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]*)", 1), F.lit("")))


def _weighted(pages: DataFrame) -> DataFrame:
    """``(host, html, weight)``: the copies of a page on a host share the weight 1. Pages without markup are left out."""
    rows = pages.where("html is not null").select("host", "html", F.md5("html").alias("digest"))
    repeated = stage(
        rows.groupBy("host", "digest").agg(F.count("*").alias("copies")).where("copies > 1"), "repeated",
        scratch_folder(pages.sparkSession),
    )
    return rows.join(broadcast_if_small(repeated, 128), ["host", "digest"], "left").select(
        "host", "html", (1 / F.coalesce("copies", F.lit(1))).alias("weight")
    )


def style_counts(pages: DataFrame) -> DataFrame:
    """``(host, kind, place, value, n)``: different pages by place and content (kind 0) or layout of its parent (kind 1)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        counts: dict[tuple[str, int, int, int], float] = {}
        for host, source, weight in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "weight"))):
            page = parse(source)
            declared = page.declared()
            parents = {parent for _, parent, _ in declared}
            seen = {(host, 0, place, code(text)) for place, _, text in declared}
            seen |= {(host, 1, place, children) for place, children in page.layouts if place in parents}
            seen |= {(host, 2, place, parent) for place, parent, _ in declared}
            for key in seen:
                counts[key] = counts.get(key, 0.0) + weight
        if not counts:
            return None
        hosts, kinds, places, values = zip(*counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(kinds, pa.int32()), pa.array(places, pa.int64()),
             pa.array(values, pa.int64()), pa.array(counts.values(), pa.float64())],
            ["host", "kind", "place", "value", "n"],
        )

    found = map_batches(_weighted(pages), run, "host string, kind int, place long, value long, n double", "html")
    # The shares of copies add up to whole pages.
    counts = found.groupBy("host", "kind", "place", "value").agg(F.round(F.sum("n")).cast("long").alias("n"))
    return stage(counts, "counts", scratch_folder(pages.sparkSession))


def importance(counts: DataFrame) -> DataFrame:
    """``(host, place, pages, importance)`` of the places of text.

    Place 2 rows give the number of pages with the place, and its parent.
    """
    # Entropies from sums of n and n log n, combined before the shuffle: no join meets the rows of one place.
    n, n_log_n = F.col("n"), F.col("n") * F.log("n")
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    sums = counts.groupBy("host", "place").agg(
        of(0, n).alias("texts"), of(0, n_log_n).alias("texts_log"), of(1, n).alias("total"),
        of(1, n_log_n).alias("total_log"), F.max(F.when(F.col("kind") == 2, F.struct("n", "value"))).alias("standing"),
    )
    sums = stage(sums, "sums", scratch_folder(counts.sparkSession))
    at_least_two = lambda c: F.log(F.greatest(F.col(c), F.lit(2)).cast("double"))
    contents = sums.where("standing is not null").select(
        "host", "place", F.col("standing.value").alias("parent"), F.col("standing.n").alias("pages"),
        (1 - F.col("texts_log") / (F.col("texts") * at_least_two("standing.n"))).alias("content"),
    )
    entropy = sums.where("total is not null").select(
        "host", F.col("place").alias("parent"),
        ((F.log("total") - F.col("total_log") / F.col("total")) / at_least_two("total")).alias("layout"),
    )
    both = contents.join(entropy, ["host", "parent"], "left")
    layout = F.coalesce("layout", F.lit(0.0))
    return both.select("host", "place", "pages", (F.col("content") + (1 - F.col("content")) * layout).alias("importance"))


def extract(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    rows = pages.select(quoted(page_id).alias("page_id"), "url", "html").withColumn("host", _host())
    places = importance(style_counts(rows)).where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LEAST_IMPORTANCE))
    dropped = stage(
        places.groupBy("host").agg(F.collect_set("place").alias("dropped")), "dropped", scratch_folder(pages.sparkSession)
    )
    marked = rows.join(broadcast_if_small(dropped, 1024), "host", "left").drop("host")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sources, dropped = batch.column("html").to_pylist(), batch.column("dropped").to_pylist()
        texts = ["\n".join(parse(s).texts(frozenset(d or ()))) for s, d in zip(sources, dropped)]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )

    kind = rows.schema["page_id"].dataType.simpleString()
    return map_batches(marked, run, f"page_id {kind}, url string, text string, n_chars long", "html")
