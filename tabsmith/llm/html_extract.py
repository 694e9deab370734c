"""Main text of web pages by tree scoring.

A page is parsed into a tree of elements. Blocks that are boilerplate by
their element, role or name (menus, notices, adverts, forms, comments
and the like) are cut first. A class or id is such a name if it is made of
boilerplate words and of words without a topic; where the word may be a topic
itself, a part of an article that holds paragraphs stays. Every paragraph then gets points for its length
and its commas and passes them to its ancestors, in full to its parent, half
to the next and less further up. An element's points are discounted by its
link density; the best one is the main container. Where it lies inside an
article or main element, all of that element is kept. Elsewhere siblings of it
are kept that score near it or hold paragraphs in their own right, with the
headings above them, everything between them but menus, and the paragraphs and
headings that close them. The text is that of the kept elements, one line per
block.

Spark reads, splits and writes the rows; a task parses one page at a time, so
memory is bounded by a batch of pages and one page's tree. Whole pages are parsed.

Cases: null or empty html gives an empty text and 0 characters; markup that is
cut off or wrongly nested is repaired as browsers do (an open paragraph ends
where a block starts; stray end tags are ignored; a tag without its ``>`` at
the end of the page is dropped); without any scoring paragraph the whole body
less its boilerplate is the text. Repeated rows give repeated results. Extra
input columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# FIXED VALUES: element names and class words.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "xmp", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li",
         "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
         "tr", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
DROPPED = {"nav", "footer", "aside", "form", "button", "select", "option", "input", "label", "fieldset", "menu", "dialog", "search", "head",
           "canvas", "audio", "video"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar",
                 "toolbar", "form", "status"}
#: Names of boilerplate wherever they stand.
DROPPED_WORDS = {"ad", "ads", "adbox", "adblock", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsored",
                 "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "newsletter",
                 "subscribe", "subscription", "signup", "login", "paywall", "sidebar", "menu", "menus", "nav", "navbar", "navigation",
                 "breadcrumb", "breadcrumbs", "pager", "pagination", "masthead", "topbar", "footer", "copyright", "related",
                 "recommended", "recommendations", "widget", "widgets", "toolbar", "disclaimer"}
#: Names of boilerplate that are topics, too: a part of an article that holds paragraphs stays.
DOUBTFUL_WORDS = {"alert", "aside", "form", "header", "hidden", "notice", "notices", "notification", "search", "share", "sharing", "side",
                  "skip", "social", "sponsor", "status", "tagcloud", "tags", "toc"}
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus", "replies", "reply", "respond"}
#: Words that say nothing of an element's topic; a name made of these and of boilerplate is boilerplate.
PLAIN_WORDS = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "col", "column", "container", "desktop", "fixed", "full",
               "global", "group", "holder", "inner", "item", "items", "js", "layout", "left", "link", "links", "list", "mobile", "module", "outer",
               "page", "panel", "primary", "right", "row", "secondary", "section", "site", "slot", "sticky", "title", "top", "unit", "wide",
               "wrap", "wrapper", "thread"}
KEPT_WORDS = {"article", "content", "main", "post", "entry", "story", "text"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
CLASS_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
WIDE_SPACE = re.compile(r"\s+")
RIGHTS = re.compile(r"\s*(?:©|\(c\)|copyright\b|all rights reserved)", re.I)

MAX_DEPTH = 200          # deeper elements become siblings, as browsers do at 512
PARAGRAPH_MIN = 25       # characters below which a paragraph passes on no points
POINT_LENGTH = 100       # one point for so many characters, up to LENGTH_POINTS
LENGTH_POINTS = 3.0
ANCESTOR_SHARE = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)
SIBLING_SHARE = 0.2      # of the best score, for a sibling to be kept
SIBLING_MIN = 10.0
SIBLING_LENGTH = 80      # a sibling paragraph of this length and few links is kept
SIBLING_LINKS = 0.25
LIST_LINKS = 0.5         # a list or table of this link density and short items is a menu, except in an article


class Element:
    """A node: ``parts`` holds text strings and child elements in page order."""

    __slots__ = ("tag", "attributes", "parent", "depth", "parts", "score", "length", "linked")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.depth = 0 if parent is None else parent.depth + 1
        self.parts: list = []
        self.score, self.length, self.linked = 0.0, 0, 0


def parse(page: str) -> Element:
    """Tree of a page, repaired where elements are not closed or wrongly nested."""
    root = at = Element("html", "", None)
    place = 0
    while (m := TAG.search(page, place)) is not None:
        if m.start() > place:
            at.parts.append(page[place:m.start()])
        place = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            node = at
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                at = node.parent
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, place)
                place = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                at.parts.append(Element(tag, "", at))
            elif tag == "br":
                at.parts.append(" ")
            continue
        at = _implied_end(at, tag)
        while at.depth >= MAX_DEPTH:
            at = at.parent
        node = Element(tag, m[3], at)
        at.parts.append(node)
        if not (m[3].endswith("/") and tag not in BLOCK):
            at = node
    if place < len(page):
        at.parts.append(page[place:])
    return root


def _implied_end(at: Element, tag: str) -> Element:
    """Where an element of this tag goes: an open paragraph or list item ends first."""
    if tag in BLOCK:
        node = at
        while node.parent is not None and (node.tag == "p" or node.tag not in BLOCK):
            if node.tag == "p":
                at = node.parent
                break
            node = node.parent
    if tag in CLOSED_BY:
        node = at
        while node.parent is not None and node.tag not in SCOPE[tag]:
            if node.tag in CLOSED_BY[tag]:
                at = node.parent
            node = node.parent
    return at


def is_boilerplate(node: Element, in_article: bool, page_length: int) -> bool:
    if node.tag in DROPPED or (node.tag == "header" and not in_article):
        return True
    if not node.attributes or node.tag in ("html", "body", "article", "main"):
        return False
    for name, *values in ATTRIBUTE.findall(node.attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True
        if name in ("class", "id") and any(names_boilerplate(token, node, in_article, page_length) for token in value.split()):
            return True
    return False


def names_boilerplate(token: str, node: Element, in_article: bool, page_length: int) -> bool:
    """Whether a class or id names boilerplate: it has such a word and no word of a topic of its own.

    Comments go in any case. A name with a word for content does not speak
    against an element that holds a title or most of the page; one that may
    be a topic not against a part of an article with paragraphs.
    """
    words = {w.lower() for w in CLASS_WORD.findall(token)}
    known = DROPPED_WORDS | DOUBTFUL_WORDS | COMMENT_WORDS
    if not words & known or any(len(w) > 1 for w in words - known - PLAIN_WORDS - KEPT_WORDS):
        return False
    if words & COMMENT_WORDS:
        return True
    if words & KEPT_WORDS and (2 * node.length > page_length or holds(node, ("h1", "article", "main"))):
        return False
    if words & DROPPED_WORDS:
        return True
    return not (in_article and (holds_paragraph(node) or ("header" in words and holds(node, HEADINGS))))


def holds(node: Element, tags) -> bool:
    return any(not isinstance(p, str) and (p.tag in tags or holds(p, tags)) for p in node.parts)


def prune(node: Element, page_length: int, in_article: bool = False) -> None:
    """Cut boilerplate elements and decode character references; elements are measured beforehand."""
    kept = []
    for part in node.parts:
        if isinstance(part, str):
            kept.append(html.unescape(part) if "&" in part else part)
        elif not is_boilerplate(part, in_article, page_length):
            prune(part, page_length, in_article or part.tag in ("article", "main"))
            kept.append(part)
    node.parts = kept


def measure(node: Element, linked: bool = False) -> None:
    """Text length and linked text length of every element, white space not counted."""
    linked = linked or node.tag == "a"
    node.length = node.linked = 0
    for part in node.parts:
        if isinstance(part, str):
            size = len(part) if not part.isspace() else 0
            node.length += size
            node.linked += size * linked
        else:
            measure(part, linked)
            node.length += part.length
            node.linked += part.linked


def link_density(node: Element) -> float:
    return node.linked / node.length if node.length else 0.0


def own_text(node: Element) -> str:
    """Text of a block outside the blocks that it holds."""
    return "".join(p if isinstance(p, str) else own_text(p) if p.tag not in BLOCK else " " for p in node.parts)


def pass_points(node: Element) -> None:
    """Give every block's own text its points and hand them to its ancestors."""
    for part in node.parts:
        if not isinstance(part, str):
            pass_points(part)
    if node.tag not in BLOCK or node.tag in HEADINGS:
        return
    text = WIDE_SPACE.sub(" ", own_text(node)).strip()
    if len(text) < PARAGRAPH_MIN:
        return
    points = 1.0 + text.count(",") + min(len(text) / POINT_LENGTH, LENGTH_POINTS)
    above = node.parent if node.tag in ("p", "pre", "li", "td", "th", "dd", "dt", "blockquote") else node
    for share in ANCESTOR_SHARE:
        if above is None:
            break
        above.score += points * share
        above = above.parent


def best_container(root: Element) -> Element | None:
    best, top = None, 0.0
    queue = [root]
    while queue:
        node = queue.pop()
        score = node.score * (1.0 - link_density(node))
        if score > top:
            best, top = node, score
        queue += [p for p in node.parts if not isinstance(p, str)]
    return best


def lifted(best: Element) -> Element:
    """The outermost article that holds the best container, else the main element, else the container itself with bare wrappers."""
    article = main = None
    node = best
    while node is not None:
        if node.tag == "article":
            article = node
        elif node.tag == "main":
            main = node
        node = node.parent
    if article is not None or main is not None:
        return article if article is not None else main
    while best.parent is not None and best.parent.parent is not None and best.parent.length == best.length:
        best = best.parent
    return best


def holds_paragraph(node: Element) -> bool:
    """Whether the element is or holds a paragraph of some length and few links."""
    if node.tag in ("p", "pre", "blockquote") and node.length >= SIBLING_LENGTH and link_density(node) < SIBLING_LINKS:
        return True
    return any(not isinstance(p, str) and holds_paragraph(p) for p in node.parts)


def items(node: Element) -> int:
    return sum((p.tag in ("li", "td", "th", "dt", "dd")) + items(p) for p in node.parts if not isinstance(p, str))


def is_menu(node: Element) -> bool:
    """Whether a block is mostly links and its items are short; references are longer."""
    return link_density(node) > LIST_LINKS and node.length < PARAGRAPH_MIN * max(1, items(node))


def kept_elements(best: Element) -> list:
    """The main container and what belongs to it among its siblings, text included, in page order."""
    best = lifted(best)
    if best.parent is None:
        return [best]
    parts = best.parent.parts
    least = max(SIBLING_MIN, SIBLING_SHARE * best.score * (1.0 - link_density(best)))
    chosen = []
    for k, part in enumerate(parts):
        if part is best:
            chosen.append(k)
        elif not isinstance(part, str) and part.tag in BLOCK:
            paragraph = holds_paragraph(part) and link_density(part) < SIBLING_LINKS
            title = part.tag == "h1" or (part.tag in ("header", "hgroup") and best.parent.tag in ("article", "main"))
            more = part.tag == "article" and link_density(part) < SIBLING_LINKS
            if paragraph or title or more or part.score * (1.0 - link_density(part)) >= least:
                chosen.append(k)
    first, last = chosen[0], chosen[-1]
    while first and (isinstance(parts[first - 1], str) and parts[first - 1].isspace()
                     or not isinstance(parts[first - 1], str) and parts[first - 1].tag in HEADINGS):
        first -= 1
    while last + 1 < len(parts) and (isinstance(parts[last + 1], str) or closes(parts[last + 1])):
        last += 1
    return [p for k, p in enumerate(parts[first:last + 1], first) if k in chosen or isinstance(p, str) or p.tag not in BLOCK or not is_menu(p)]


def closes(part: Element) -> bool:
    """Whether an element behind the main container still belongs to it: text or a heading, no links and no rights."""
    if part.tag not in HEADINGS | {"p", "pre", "blockquote", "ul", "ol", "dl", "table", "figure"} and part.tag in BLOCK:
        return False
    return link_density(part) < SIBLING_LINKS and not RIGHTS.match(own_text(part))


def in_article(node: Element | None) -> bool:
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node is not None


def blocks(node: Element, out: list[str], line: list[str], article: bool = False) -> None:
    """Append finished lines to ``out``; ``line`` holds the open one. Lists of links go but in an article."""
    block = node.tag in BLOCK
    if block:
        _finish(out, line)
    article = article or node.tag in ("article", "main")
    for part in node.parts:
        if isinstance(part, str):
            line.append(part)
        elif article or not (part.tag in ("ul", "ol", "table", "dl") and is_menu(part)):
            blocks(part, out, line, article)
    if block:
        _finish(out, line)


def _finish(out: list[str], line: list[str]) -> None:
    text = WIDE_SPACE.sub(" ", "".join(line)).strip()
    line.clear()
    if text:
        out.append(text)


def main_text(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    root = parse(page)
    measure(root)
    prune(root, root.length)
    measure(root)
    pass_points(root)
    best = best_container(root)
    out: list[str] = []
    line: list[str] = []
    for node in [root] if best is None else kept_elements(best):
        if isinstance(node, str):
            line.append(node)
        else:
            blocks(node, out, line, in_article(node))
    _finish(out, line)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text)."""
    rows = pages.select("page_id", "url", "html")

    def pages_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page) for page in batch["html"]]
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    id_type = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInPandas(pages_of, f"page_id {id_type}, url string, text string, n_chars long")
