"""HTML extraction with a site style tree.

The pages of a host are merged by the path of styles (tag and class) that leads to an element. For every merged node two
entropies are measured over the host's pages: of the layout of its children, and of its content. They are collision
entropies, and importance is ``1 - exp(-entropy)`` of the more varied of the two: the chance that two pages differ there. It
is 0 for what looks and reads the same on page after page, near 1 for what differs, and does not depend on how many pages
a host has. Pages of equal content count as one, so copies
of a page do not make its body look like boilerplate. Where a node is of low importance, its branch is cut from every page on
which it holds what the host's pages repeat there; what a page alone holds is never cut. Inside an article only branches with
a style of their own can be cut. If cutting would leave nothing, only the stated roles are cut.

Roles that the markup itself states (menus, footers, forms, notices, comments and so on) have importance 0, the article
has 1: where a page has one, the main text comes from it.

The pages are read twice. The first pass counts per task before anything is shuffled, so a host with a third of all
pages costs each task one row per distinct node and page. What the second pass needs of a host is the list of what its
unimportant nodes repeat, ten contents of a node at most. Parsing takes time in proportion to the page's length.

Inside a block white space becomes one space; blocks are joined by a line feed. NULL or empty pages give an empty text;
a NULL url is a host of its own. Rows are kept as they are, repeated ones too; extra columns are not read. Broken markup
never fails: open elements end with their parents, and what no tag closes runs to the end.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small, stored
from tidemark.llm.urls import split_url

#: Below this importance a node's repeated content is cut: one content holds more than about five sixths of its pages.
UNIMPORTANT = 0.3
#: A content is repeated if so many different pages of the host have it, and this share of those that have the node.
REPEATED, SHARE = 3, 0.1

#: Fixed values of HTML: elements that hold no text of the page, have no end tag, are inside a line, or end each other.
RAW = {"script", "style", "template", "noscript", "iframe", "textarea", "title", "svg", "math", "object", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"},
}
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SCOPE = {"ul", "ol", "dl", "table", "td", "th", "select"}  # an implied end does not reach beyond these

#: Roles of importance 0, by tag, by ARIA role, and by words in class or id.
NOISE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "noscript", "head"}
NOISE_ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
NOISE_WORDS = set("""
ad ads adbox adslot adsense adunit nav menu topbar navbar navigation breadcrumb breadcrumbs sidebar side aside cookie
cookies consent gdpr notice notices alert popup modal overlay banner promo promos promotion promoted sponsor sponsored
sponsors newsletter subscribe subscription signup login share sharing social related recommended recommendations footer
foot comment comments commentlist reply replies respond responses disqus pagination pager search widget widgets toolbar
masthead copyright legal form forms advert adverts advertisement advertising
""".split())
NOISE_STARTS = ("advert", "comment", "cookie", "sponsor", "breadcrumb", "sidebar")
ARTICLE_TAGS, ARTICLE_ROLES = {"article", "main"}, {"main", "article"}

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+|[^>]*)>|[!?/][^>]*(?:>|\Z))""", re.S)
_CUT_OFF = re.compile(r"<(?:/?[a-zA-Z]|[!?])")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Element:
    tag: str
    path: int  # hash of the styles from the root
    noise: bool  # itself or something around it has importance 0
    article: bool
    parent: Element | None
    may_go: bool  # whether it can be cut for its importance
    children: list[str] = field(default_factory=list)
    text: list[int] = field(default_factory=list)  # hashes of its blocks and of its children's contents, in order
    content: int = 0
    gone: bool = False


@dataclass
class Block:
    text: str
    noise: bool
    article: bool
    linked: float
    element: Element


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(text)} if text.strip() else {}


def _is_noise(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """``inside`` an article a header is the article's own."""
    if tag in NOISE_TAGS or attrs.get("role", "").lower() in NOISE_ROLES or "hidden" in attrs:
        return True
    if tag == "header" and not inside or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    if not names.strip() or tag in ("html", "body", *ARTICLE_TAGS):
        return False
    words = _WORD.findall(_CAMEL.sub(" ", names).lower())
    return any(w in NOISE_WORDS or w.startswith(NOISE_STARTS) or w == "header" and not inside for w in words)


class Page:
    """The blocks of a page, and what its elements add to the host's tree."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.seen: list[tuple[int, int, int]] = []  # node, layout of its children, its content
        self.elements: list[Element] = []  # parents first
        root = Element("", 0, False, False, None, False)
        self.stack, self.open = [root], Counter()  # open elements, and how many of each tag
        self.parts, self.linked, self.size, self.links = [], 0, 0, 0
        at, last = 0, source.rfind(">")
        while at < len(source):
            # Behind the last > there is no whole tag: the page's end cuts one off, or there is none.
            tag = _TAG.search(source, at) if at <= last else None
            cut = _CUT_OFF.search(source, at) if tag is None else None
            end = tag.start() if tag else cut.start() if cut else len(source)
            if end > at:
                self._text(source[at:end])
            if tag is None:
                break
            at = tag.end()
            if not tag[2]:
                continue
            name = tag[2].lower()
            if tag[1]:
                self._end(name)
            elif name in RAW:
                if not tag[3].endswith("/"):
                    close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                    at = close.end() if close else len(source)
            else:
                self._start(name, tag[3])
        self._block()
        while len(self.stack) > 1:
            self._pop()
        #: All that the page's stated roles leave, for telling copies of a page.
        self.whole = xxhash.xxh3_64_intdigest(repr(root.text)) >> 1

    def _text(self, text: str) -> None:
        self.parts.append(text)
        if text.strip():
            self.size += len(text)
            if self.links:
                self.linked += len(text)

    def _block(self) -> None:
        if not self.parts:
            return
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            top = self.stack[-1]
            top.text.append(xxhash.xxh3_64_intdigest(text))
            self.blocks.append(Block(text, top.noise, top.article, self.linked / max(self.size, 1), top))
        self.parts, self.linked, self.size = [], 0, 0

    def _start(self, name: str, rest: str) -> None:
        if name == "br":
            self.parts.append(" ")
            return
        if name in INLINE:
            attrs = _attributes(rest)
            if not (attrs and _is_noise(name, attrs, self.stack[-1].article)):
                self.links += name == "a"
                return
        self._block()
        if name in ENDS_P:
            self._imply({"p"})
        if name in CLOSES:
            self._imply(CLOSES[name])
        parent = self.stack[-1]
        attrs = _attributes(rest)
        style = " ".join([name, *sorted(set(attrs.get("class", "").split()))])
        parent.children.append(style)
        if name in VOID:
            return
        nested = name == "article" and self.open["article"] > 0  # a reader's comment
        noise = parent.noise or nested or _is_noise(name, attrs, parent.article)
        article = parent.article or name in ARTICLE_TAGS or attrs.get("role", "").lower() in ARTICLE_ROLES
        styled = bool(attrs.get("class") or attrs.get("id"))
        path = xxhash.xxh3_64_intdigest(f"{parent.path} {style}") >> 1
        may_go = (styled if article else name not in ("html", "body")) and name not in ARTICLE_TAGS
        self.stack.append(Element(name, path, noise, article, parent, may_go))
        self.elements.append(self.stack[-1])
        self.open[name] += 1

    def _end(self, name: str) -> None:
        if name in INLINE and not self.open[name]:
            self.links = max(0, self.links - (name == "a"))
            return
        self._block()
        if self.open[name]:
            while self._pop() != name:
                pass

    def _imply(self, names: set[str]) -> None:
        if not any(self.open[n] for n in names):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in names:
                while len(self.stack) > k:
                    self._pop()
                if not any(self.open[n] for n in names):
                    break
            elif self.stack[k].tag in SCOPE or self.stack[k].tag in ARTICLE_TAGS:
                break

    def _pop(self) -> str:
        e = self.stack.pop()
        self.open[e.tag] -= 1
        if e.text:
            e.content = xxhash.xxh3_64_intdigest(repr(e.text)) >> 1
            if not e.noise:
                self.seen.append((e.path, xxhash.xxh3_64_intdigest("\n".join(e.children)) >> 1, e.content))
                e.parent.text.append(e.content)
        return e.tag

    def main(self, repeated: set[int]) -> list[str]:
        """The blocks of the main text, without what unimportant nodes repeat."""
        told = [b for b in self.blocks if not b.noise]
        if any(b.article for b in told):
            told = [b for b in told if b.article]
        else:
            told = [b for b in told if b.linked < 0.8] or told
        if not repeated:
            return [b.text for b in told]
        for e in self.elements:
            e.gone = e.parent.gone or (e.may_go and held(e.path, e.content) in repeated)
        return [b.text for b in told if not b.element.gone] or [b.text for b in told]


def held(node: int, content: int) -> int:
    """One number for a node with a content."""
    return xxhash.xxh3_64_intdigest(f"{node} {content}") >> 1


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, html -> host, node, layout, content, held, whole: distinct in a part of a batch"""
    kinds = [pa.string(), *[pa.int64()] * 5]
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.slice(at, 500)
            rows = set()
            for host, source in zip(part.column(0).to_pylist(), part.column(1)):
                page = Page(source.as_py())
                rows.update((host, node, layout, content, held(node, content), page.whole) for node, layout, content in page.seen)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["host", "node", "layout", "content", "held", "whole"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page_id, url, html, repeated -> page_id, url, text"""
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.slice(at, 500)
            texts = ["\n".join(Page(s.as_py()).main(set(n or ()))) for s, n in zip(part.column(2), part.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """The merged tree: on how many different pages a ``node`` of a ``host`` has a content (``held``, ``n``), and for each node
    its ``elements`` and ``importance``. Both are stored."""
    host, _ = split_url(pages[url_col])
    given = pages.select(host.alias("host"), F.coalesce(pages[html_col], F.lit("")).alias("html"))
    measured = given.mapInArrow(_measure, "host string, node bigint, layout bigint, content bigint, held bigint, whole bigint")
    once = measured.distinct()  # pages of equal content are one page
    each = once.select("host", "node", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("layout").alias("value"), F.lit(None).cast("bigint").alias("held")),
        F.struct(F.lit(1).alias("kind"), F.col("content").alias("value"), F.col("held").alias("held")))).alias("v")).select("host", "node", "v.*")
    counts = each.groupBy("host", "node", "kind", "value", "held").agg(F.count("*").alias("n"))
    square = F.sum(F.col("n") * F.col("n").cast("double"))
    per = counts.groupBy("host", "node", "kind").agg(F.sum("n").alias("m"), square.alias("square"))
    importance = F.max(1 - F.col("square") / (F.col("m").cast("double") * F.col("m")))
    return stored(counts.where("kind = 1"), "style-counts"), stored(
        per.groupBy("host", "node").agg(F.max("m").alias("elements"), importance.alias("importance")), "style-nodes")


def repeated(counts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``host`` and ``repeated``, what its unimportant nodes hold on many pages: at most ``1 / SHARE`` contents of a node."""
    low = nodes.where(F.col("importance") < UNIMPORTANT).select("host", "node", "elements")
    many = counts.where(F.col("n") >= REPEATED).join(small(low), ["host", "node"])
    return many.where(F.col("n") >= SHARE * F.col("elements")).groupBy("host").agg(F.collect_list("held").alias("repeated"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, ``text``, ``n_chars``."""
    cut = stored(repeated(*style_tree(pages, url_col, html_col)), "style-cut")
    contents = cut.agg(F.coalesce(F.sum(F.size("repeated") + 8), F.lit(0))).first()[0]  # what a broadcast would hold
    host, _ = split_url(pages[url_col])
    given = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].alias("url"), F.coalesce(pages[html_col], F.lit("")).alias("html"), host.alias("host"))
    kind = pages.schema[id_col].dataType.simpleString()
    rows = given.join(small(cut, contents), "host", "left").select("page_id", "url", "html", "repeated")
    texts = rows.mapInArrow(_extract, f"page_id {kind}, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
