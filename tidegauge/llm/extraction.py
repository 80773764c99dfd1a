"""Main text of web pages, without the site's template.

A page is parsed into a flat list of elements. Main text is what the outermost
``article`` and ``main`` elements hold, or the whole body where there is none, less

* elements that are never text (scripts, styles, forms, controls) or whose tag or role
  says what they are (menus, headers, footers, sidebars);
* elements whose class or id begins with a word for such parts, for adverts, notices
  or reader comments;
* the site's template: element subtrees are hashed, and those found on ``LEAST_PAGES``
  pages of their host are deleted; single paragraphs, headings and lists, which authors
  repeat too, only from ``LEAST_SMALL`` pages on, and inside an article never. Pages of
  equal main text count once. What becomes of a subtree depends on the number of pages
  that have it, not on how large its host is.

Subtree counts are a Spark aggregation by host and subtree. While the recurring ones are
at most ``BROADCAST_ROWS``, by count, every task gets them all. Beyond that the pages'
subtrees are joined with them, by host and subtree, in narrow rows; a page then gets its
own list by a hash of its content, so no host is gathered in one place.

Character references are decoded, white space inside a block becomes one space, and
blocks are joined by an empty line in page order. Null and empty pages have an empty
text. A null url is a host of its own. Repeated rows give one row each; an empty
table gives none. Unclosed and stray tags, comments and tags cut off by the end of
the page are tolerated.
"""

from __future__ import annotations

import html as html_module
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegauge.llm.common import fresh_name, stored
from tidegauge.llm.urls import host_of

LEAST_PAGES, LEAST_SMALL = 5, 20
#: Up to this many recurring subtrees of all hosts (a host name and a number each) are broadcast.
BROADCAST_ROWS = 500_000

# HTML's elements by what they mean here.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")
_NO_TEXT = frozenset(
    "script style noscript template textarea title iframe svg head nav header footer aside form button select option "
    "menu dialog object canvas audio video label input".split()
)
_BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr "
    "caption figure figcaption address hr details summary fieldset center nav header footer aside form".split()
)
_SPACING = frozenset("br td th".split())
_CONTAINERS = frozenset("div section table figure fieldset details center".split())
_HASHED = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre address".split())
_MAIN = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
_NOT_MAIN = re.compile(
    r"(?:^|\s)(?:ads?|adverts?|advertisements?|adsbygoogle|advertorial|sponsor(?:ed|s)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr|"
    r"notices?|alerts?|popups?|modals?|overlay|newsletter|subscri(?:be|ption)|paywall|sidebars?|side-bar|menus?|nav|navbar|navigation|"
    r"breadcrumbs?|pagination|pager|footer|header|masthead|topbar|comments?|commentlist|disqus|respond|replies|reader-comments|"
    r"user-comments|share|sharing|social|related|recommended|widgets?|toolbar|login|signup|skip-link|site-header|site-footer|"
    r"page-header|page-footer|main-nav|site-nav)(?=$|\s|[-_0-9])",
    re.IGNORECASE,
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*(?:>|\Z)|<[/a-zA-Z][^<>]*\Z", re.DOTALL
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE) for t in _RAW}
#: A start tag on the left ends the open elements on the right.
_ENDS = {
    **dict.fromkeys(_BLOCKS - {"html", "body"}, ("p",)),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
_WALLS = _MAIN | frozenset("table ul ol section div body html aside nav".split())


@dataclass
class Element:
    tag: str
    parent: int
    start: int
    body: int  # where the start tag ends
    stop: int = -1
    out: bool = False  # no main text, by tag, role, class or id
    main: int = -1  # the outermost article or main around, itself included


@dataclass
class Page:
    source: str
    elements: list[Element] = field(default_factory=list)
    pieces: list[tuple[int, str | None]] = field(default_factory=list)  # (element, text, or None at a block's edge)


_SPACE = " "


def parse(source: str) -> Page:
    """Elements and texts of a page, in order."""
    page = Page(source)
    elements, pieces = page.elements, page.pieces
    elements.append(Element("", -1, 0, 0, len(source)))
    stack, at = [0], 0
    opened: Counter[str] = Counter()

    def close(depth: int, where: int) -> None:
        for e in stack[depth:]:
            elements[e].stop = where
            opened[elements[e].tag] -= 1
        del stack[depth:]

    position = 0
    while True:
        m = _TOKEN.search(source, position)
        end = m.start() if m else len(source)
        if end > at:
            pieces.append((stack[-1], source[at:end]))
        if not m:
            break
        at = position = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BLOCKS:
            pieces.append((stack[-1], None))
        elif tag in _SPACING:
            pieces.append((stack[-1], _SPACE))
        if m.group(1):
            if not opened[tag]:
                continue
            inner = tag not in _BLOCKS or tag in ("p", "li")
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[depth]].tag
                if open_tag == tag:
                    close(depth, m.end())
                    break
                if inner and open_tag in _WALLS:
                    break
            continue
        ends = _ENDS.get(tag)
        if ends and any(opened[t] for t in ends):
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[depth]].tag
                if open_tag in ends:
                    close(depth, m.start())
                    break
                if open_tag in _WALLS:
                    break
        if tag in _VOID:
            continue
        parent = stack[-1]
        e = Element(tag, parent, m.start(), m.end())
        e.out = elements[parent].out or tag in _NO_TEXT
        named = m.group(3)
        if named and not e.out:
            for a in _ATTRIBUTE.finditer(named):
                value = a.group(2) or a.group(3) or a.group(4) or ""
                if a.group(1).lower() == "role":
                    e.out |= value.lower() in _ROLES
                elif tag not in ("html", "body"):
                    e.out |= bool(_NOT_MAIN.search(value))
        e.main = elements[parent].main
        if e.main < 0 and tag in _MAIN and not e.out:
            e.main = len(elements)
        elements.append(e)
        if tag in _RAW:
            found = _RAW_END[tag].search(source, m.end())
            at = position = found.end() if found else len(source)
            e.stop = at
            continue
        if named.endswith("/") and tag not in _BLOCKS:
            e.stop = m.end()
            continue
        stack.append(len(elements) - 1)
        opened[tag] += 1
    close(1, len(source))
    return page


def subtree_hashes(page: Page) -> list[int]:
    """Signed 64-bit hash of each element: of its start tag, its own text and its children's hashes.

    White space is made even, and comments do not count. Linear in the page.
    """
    own: list[list[str]] = [[page.source[e.start : e.body]] for e in page.elements]
    for i, text in page.pieces:
        own[i].append(text or _SPACE)
    below: list[list[bytes]] = [[] for _ in page.elements]
    hashes = [0] * len(page.elements)
    for i in range(len(page.elements) - 1, -1, -1):  # children come after their parents
        e = page.elements[i]
        text = page.source[e.start : e.stop] if e.tag in _RAW else " ".join(own[i])
        digest = xxhash.xxh64_digest(b"\0".join([" ".join(text.split()).encode(), *reversed(below[i])]))
        hashes[i] = int.from_bytes(digest, "big", signed=True)
        if e.parent >= 0:
            below[e.parent].append(digest)
    return hashes


def candidates(page: Page) -> list[int]:
    """Elements that may be a site's template and are not left out anyway."""
    inside = any(e.main >= 0 for e in page.elements)
    return [
        i
        for i, e in enumerate(page.elements)
        if not e.out and (e.main >= 0 and e.main != i and e.tag in _CONTAINERS if inside else e.tag in _HASHED)
    ]


def main_text(page: Page, recurring: frozenset[int] | set[int] = frozenset()) -> str:
    """The page's main text without the subtrees whose hash is in ``recurring``."""
    elements = page.elements
    inside = any(e.main >= 0 for e in elements)
    out = [e.out for e in elements]
    if recurring:
        hashes = subtree_hashes(page)
        for i in candidates(page):
            out[i] = hashes[i] in recurring
        for i, e in enumerate(elements):  # parents come first
            out[i] = out[i] or (e.parent >= 0 and out[e.parent])
    blocks, block = [], []
    for i, text in page.pieces:
        if text is None:
            blocks.append("".join(block))
            block = []
        elif not out[i] and (not inside or elements[i].main >= 0):
            block.append(html_module.unescape(text) if "&" in text else text)
    blocks.append("".join(block))
    return "\n\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


def _page_key(host: Column, source: Column) -> Column:
    """What pages of equal host and content share."""
    return F.sha2(F.concat_ws("\0", host, F.coalesce(source, F.lit(""))), 256)


def _subtrees(pages: DataFrame) -> DataFrame:
    """The subtrees of every page that may be a template: ``host``, ``key``, ``subtree``, ``small``, ``page``.

    ``pages`` has ``host``, ``key`` and ``html``; ``page`` is a hash of the main text.
    """

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for host, key, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                page = parse(source.as_py() or "")
                chosen = candidates(page)
                if not chosen:
                    continue
                whole, every = xxhash.xxh64_intdigest(main_text(page)) >> 1, subtree_hashes(page)
                found = {every[i]: page.elements[i].tag not in _CONTAINERS for i in chosen}
                out += [(host, key, subtree, small, whole) for subtree, small in found.items()]
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    names = ["host", "key", "subtree", "small", "page"]
    return pages.select("host", "key", "html").mapInArrow(run, "host string, key string, subtree long, small boolean, page long")


def _recurring(rows: DataFrame, least_pages: int, least_small: int) -> DataFrame:
    counts = rows.groupBy("host", "subtree", "small").agg(F.count_distinct("page").alias("n"))
    least = F.when(F.col("small"), least_small).otherwise(least_pages)
    return counts.filter(F.col("n") >= least).select("host", "subtree").distinct()


def recurring_subtrees(pages: DataFrame, least_pages: int = LEAST_PAGES, least_small: int = LEAST_SMALL) -> DataFrame:
    """``host`` and ``subtree`` of the element subtrees that a host's pages have in common.

    ``pages`` has ``host`` and ``html``.
    """
    return _recurring(_subtrees(pages.select("host", F.lit("").alias("key"), "html")), least_pages, least_small)


def extract_text(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    out_col: str = "text",
    least_pages: int = LEAST_PAGES,
    least_small: int = LEAST_SMALL,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``pages`` with ``out_col``, the main text, in place of ``html_col``."""
    host, key, known = (fresh_name(pages, n) for n in ("page_host", "page_key", "site_template"))
    hosted = pages.withColumn(host, host_of(F.col(url_col)))
    content = _page_key(F.col(host), F.col(html_col))
    keyed = hosted.select(F.col(host).alias("host"), content.alias("key"), F.col(html_col).alias("html"))
    # Counting needs no keys, so they are made only for the join.
    found = stored(recurring_subtrees(keyed, least_pages, least_small), "site-templates")
    kept = [c for c in [*pages.columns, out_col] if c != html_col or c == out_col]
    kept = list(dict.fromkeys(kept))
    few = found.limit(broadcast_rows + 1).collect()

    def text_of(templates: Callable[[pa.Array], Iterator]) -> Callable:
        @F.arrow_udf(T.StringType())
        def text(sources: pa.Array, of: pa.Array) -> pa.Array:
            out = []
            for source, template in zip(sources, templates(of)):
                source = source.as_py()
                out.append(main_text(parse(source), template) if source else "")
            return pa.array(out, pa.string())

        return text

    if len(few) <= broadcast_rows:
        by_host: dict[str, set[int]] = {}
        for r in few:
            by_host.setdefault(r["host"], set()).add(r["subtree"])
        sites = pages.sparkSession.sparkContext.broadcast(by_host)
        text = text_of(lambda hosts: (sites.value.get(h, frozenset()) for h in hosts.to_pylist()))
        # The pages stay where they are read.
        return hosted.withColumn(out_col, text(F.col(html_col), F.col(host))).select(*kept)
    of_page = _subtrees(keyed).select("host", "subtree", "key").distinct()
    lists = of_page.join(found.hint("merge"), ["host", "subtree"]).groupBy("key").agg(F.collect_list("subtree").alias(known))
    lists = lists.withColumnRenamed("key", f"{key}_of")
    joined = hosted.withColumn(key, content).join(lists.hint("merge"), F.col(key) == F.col(f"{key}_of"), "left")
    text = text_of(lambda found: (frozenset(t.as_py() or ()) for t in found))
    return joined.withColumn(out_col, text(F.col(html_col), F.col(known))).select(*kept)
