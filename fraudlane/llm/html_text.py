"""Main text of HTML pages by tree scoring.

A page is read into a tree of block elements. Elements that hold menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles or reader comments are left out with all they contain. Each remaining block of text has points
for its length and its commas and passes them to its element's parent, half of them to the next ancestor and less to
each one further up; an ancestor's sum is discounted by the share of its text that is in links. The element with the
largest sum is the main container. If it stands in an ``article`` or ``main`` element, that is the article; otherwise
its siblings stay, too, if they score a fifth of it or are plain text blocks with few links.

Character references are decoded, white space in a block becomes one space, and blocks are joined in page order by an
empty line. Nothing else is dropped or capped. Pages are independent, so this is one pass without a shuffle.

Defined results: a null or empty page, and one that is all left out, gives an empty text of 0 characters. A page cut
off in the middle of a tag ends before that tag. Repeated rows are answered once each; ties between containers go to
the first in page order; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlane.llm import text_arrays as ta

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>)?",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

#: Contents are not markup; the element ends at its own end tag.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_LEFT_OUT = _RAW | {
    "head", "nav", "footer", "aside", "form", "button", "select", "option", "fieldset", "label", "dialog", "menu",
    "template", "svg", "canvas", "object", "audio", "video", "applet", "map",
}
_BLOCKS = {
    "html", "body", "address", "article", "blockquote", "center", "dd", "details", "dir", "div", "dl", "dt",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main", "ol", "p",
    "pre", "search", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "caption", "ul",
} | _LEFT_OUT
#: Cells of a row are parts of one block.
_CELLS = {"td", "th"}
_TEXT_BLOCKS = {"p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "figure", "li"}
_WHOLE = {"html", "body", "article", "main"}
#: An end of a paragraph, item or cell is implied by the start of one of these.
_CLOSED_BY = {
    "p": _BLOCKS - {"tr", "caption", "button"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option"}, "head": {"body"},
}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
#: Parts of a class, id or role that name what is not the article.
_NAMED_OUT = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription paywall nav navbar navigation "
    "menu menus breadcrumb breadcrumbs sidebar sidebars rail footer masthead comment comments disqus respond replies "
    "share sharing social related recommended recommendations widget widgets toolbar pagination pager login signup "
    "complementary contentinfo search".split()
)
_SITE_HEADER = frozenset(("header", "topbar", "banner"))


class _Node:
    __slots__ = ("tag", "parent", "order", "points", "chars", "linked", "inside")

    def __init__(self, tag: str, parent: _Node | None, order: int):
        self.tag, self.parent, self.order = tag, parent, order
        self.points, self.chars, self.linked = 0.0, 0, 0
        # The outermost article or main element this stands in.
        self.inside = parent.inside if parent and parent.inside else self if tag in ("article", "main") else None


def left_out(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is not part of an article, by its tag or by what its class, id or role says."""
    if tag in _LEFT_OUT:
        return True
    if tag == "header":
        return not in_article
    if not attributes or tag in ("html", "body", "main"):
        return False
    parts: set[str] = set()
    for a, b, c in _NAMES.findall(attributes):
        parts.update(x.lower() for x in _PARTS.findall(a or b or c))
    if tag == "article":
        return bool(parts & {"comment", "comments", "ad", "advert", "promo"})
    return bool(parts & _NAMED_OUT) or not in_article and bool(parts & _SITE_HEADER)


def parse(page: str) -> list[tuple[str, int, _Node]]:
    """(text, characters in links, element) of every block of text that is not left out, in page order."""
    root = _Node("html", None, 0)
    stack: list[tuple[str, _Node]] = []  # open tags, and for each the block element around its contents
    node, n_nodes = root, 1
    blocks: list[tuple[str, int, _Node]] = []
    pieces: list[str] = []
    linked = in_link = skipped = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            blocks.append((text, min(linked, len(text)), node))
        pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not skipped:
            text = references.unescape(raw)
            pieces.append(text)
            if in_link:
                linked += len(text.strip())

    def pop() -> str:
        """Closes the innermost open tag."""
        nonlocal node, in_link, skipped
        tag, around = stack.pop()
        if tag in _BLOCKS and not skipped:
            flush()
        if skipped:
            skipped -= 1
        if tag == "a":
            in_link = max(0, in_link - 1)
        node = around
        return tag

    while at < end:
        found = _TAG.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        name = found[2]
        if name is None:
            continue
        if not found[4]:
            # An open quote or the end of the page in a tag.
            at = page.find(">", at) + 1
            if not at:
                break
        tag = name.lower()
        if found[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                while len(stack) > depth:
                    pop()
            elif tag == "p":
                flush()
            if tag in _CELLS:
                pieces.append(" ")
            continue
        for open_tag, closers in _CLOSED_BY.items():
            if tag in closers:
                scope = _SCOPES.get(open_tag, ("table",) if open_tag == "p" else ())
                depth = None
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == open_tag:
                        depth = i
                        break
                    if stack[i][0] in scope or open_tag == "p" and stack[i][0] in _BLOCKS | _CELLS:
                        break
                if depth is not None:
                    while len(stack) > depth:
                        pop()
        if tag == "br" or tag == "wbr":
            if tag == "br":
                pieces.append(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        out = bool(skipped) or left_out(tag, found[3], node.inside is not None)
        if tag in _BLOCKS and not skipped:
            flush()
        stack.append((tag, node))
        if out:
            skipped += 1
            continue
        if tag in _BLOCKS and tag != "html":
            node = _Node(tag, node, n_nodes)
            n_nodes += 1
        elif tag in _CELLS:
            pieces.append(" ")
        if tag == "a":
            in_link += 1
    flush()
    return blocks


def main_blocks(blocks: list[tuple[str, int, _Node]]) -> list[str]:
    """The texts of the blocks of the best container and of its siblings that stay."""
    nodes: dict[int, _Node] = {}
    for text, linked, node in blocks:
        points = text.count(",") + min(len(text) / 100, 3) + (len(text) >= 25)
        # A text block passes its points on; a container with text of its own keeps them.
        up = node.parent if node.tag in _TEXT_BLOCKS and node.parent else node
        share = 1.0
        level = 0
        while up is not None:
            nodes[up.order] = up
            up.points += points * share
            level += 1
            share = 1 / (2 * level)
            up = up.parent
        up = node
        while up is not None:
            up.chars += len(text)
            up.linked += linked
            up = up.parent
    if not nodes:
        return []
    for one in nodes.values():
        one.points = one.points * (1 - one.linked / one.chars) + (5 if one.tag in ("article", "main") else 0)
    best = max(nodes.values(), key=lambda x: (x.points, -x.order))
    top = best.inside or best
    kept = {top.order}
    if not best.inside:
        for _, _, node in blocks:
            while node is not None and node.parent is not None and node.parent is not best.parent:
                node = node.parent
            if node is not None and node.parent is not None and node.parent is best.parent:
                few_links = node.linked <= node.chars / 3
                if node.points >= best.points / 5 and few_links or node.tag in _TEXT_BLOCKS and few_links:
                    kept.add(node.order)
    texts = []
    for text, _, node in blocks:
        while node is not None and node.order not in kept:
            node = node.parent
        if node is not None:
            texts.append(text)
    return texts


def main_text(page: str | None) -> str:
    return "\n\n".join(main_blocks(parse(page))) if page else ""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in ta.slices(batch, "html"):
            texts = [main_text(page.as_py()) for page in part.column(2)]
            columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return pages.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
