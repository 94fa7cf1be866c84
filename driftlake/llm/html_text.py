"""Main text of web pages by scoring the tree of their elements."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.scratch import ship

#: Element names of HTML by their part in a page, and words that name its furniture.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg"}
FURNITURE = {"nav", "aside", "footer", "form", "button", "select", "menu", "dialog", "head", "object", "canvas", "fieldset", "option", "audio", "video"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "dfn", "em", "font", "i", "ins", "del", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
ALONE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "p": {"article", "body", "div", "section", "td", "li", "blockquote", "main"}}
#: Words of a class or id that name furniture wherever they stand; those that do where only AROUND stands beside them; and
#: those beside which a word says what an element has or lacks, not what it is. Articles are only looked at for REMARKS.
FIRM = set("adsbygoogle adsense advert adverts advertisement advertisements breadcrumb breadcrumbs comment comments cookie cookies consent disqus doubleclick footer gdpr googleads masthead navbar navigation newsletter pagination popup sidebar sponsored toolbar".split())
LOOSE = set("ad ads alert banner copyright login menu modal nav notice promo recommended related replies reply respond share sharing signup skip social sponsor subscribe widget".split())
AROUND = set("area article articles bar block bottom box button buttons container content fixed form global google group header icons iframe inner item items left link links list main message news outer page panel post posts primary reader right secondary section site slot stories sub thread to top unit user wrap wrapper".split())
HAVING = set("closed disabled enabled has hide no open show with without".split())
REMARKS = set("ad ads advert advertisement comment comments disqus promo replies reply sponsored".split())
#: A tag's end is looked for outside quotes (TOKEN); where that would pass the page's end, quotes mean nothing any more
#: (PLAIN). No character is read twice by one attempt, and only one attempt per page can fail.
MARKUP = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
TOKEN = re.compile(MARKUP + r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?>[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>|[^<]++|<""", re.S)
PLAIN = re.compile(MARKUP + r"|</?[a-zA-Z][^>]*+\Z|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|[^<]++|<", re.S)
TAG = re.compile(r"<(?=/?[a-zA-Z])")
PART = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
NAMES = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu", "menubar"}


#: Ancestors that a block gives points to.
REACH = 64


class Element:
    __slots__ = ("tag", "up", "parts", "gone", "score", "length", "linked", "commas")

    def __init__(self, tag: str, up: Element | None, gone: bool):
        self.tag, self.up, self.gone = tag, up, gone
        self.parts: list = []
        self.score, self.length, self.linked, self.commas = 0.0, 0, 0, 0


def _named(value: str, tag: str) -> bool:
    """Whether a class or id says that the element isn't the page's own text."""
    for name in value.split():
        parts = {p.lower() for p in PART.split(name)} - {""}
        if parts & HAVING:
            continue
        if tag in ("article", "main"):
            if parts & REMARKS and not parts - REMARKS - AROUND - FIRM - LOOSE:
                return True
        elif parts & FIRM or parts & LOOSE and all(p in LOOSE or p in AROUND or p.isdigit() for p in parts):
            return True
    return False


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE or tag == "header" and not in_article:
        return True
    for name, *values in NAMES.findall(attributes) if attributes else ():
        value, name = "".join(values), name.lower()
        if name in ("class", "id") and tag not in ("body", "html") and _named(value, tag):
            return True
        if name == "style" and HIDDEN.search(value):
            return True
        if name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
    return False


def _tokens(page: str) -> Iterator[re.Match]:
    """The page's pieces in order; what stands in raw elements is passed over."""
    at, pattern = 0, TOKEN
    while at < len(page):
        m = pattern.match(page, at)
        if pattern is TOKEN and m[0] == "<" and TAG.match(page, at):
            pattern = PLAIN
            continue
        yield m
        at = m.end()
        if m[2] and not m[1] and m[2].lower() in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{m[2]}(?![a-zA-Z0-9:-])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)


class _Open:
    """The open elements, and where those of each tag stand among them, so that none is looked for step by step."""

    def __init__(self, root: Element):
        self.stack, self.places = [root], {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.stack))
        self.stack.append(element)

    def last(self, tags) -> int:
        """The place of the innermost element of these tags, 0 without one."""
        return max((own[-1] for t in tags if (own := self.places.get(t))), default=0)

    def close(self, at: int) -> None:
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()


def parse(page: str) -> Element:
    """A forgiving tree: paragraphs and items close by themselves, stray ends are ignored, the rest closes at the end."""
    root = Element("html", None, False)
    open_ = _Open(root)
    stack = open_.stack
    for m in _tokens(page):
        end, tag, attributes = m.groups()
        if not tag:
            text = m[0]
            if text[0] != "<" or text == "<":
                stack[-1].parts.append(text)
            elif text.startswith("<![CDATA["):
                stack[-1].parts.append(html.escape(text[9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if end:
            if at := open_.last((tag,)):
                open_.close(at)
            continue
        if tag in RAW or tag in VOID:
            stack[-1].parts.append(" ")
            continue
        closed = ALONE.get(tag) or ({"p"} if tag in CLOSES_P else set())
        held = HOLDS["p"] if tag in CLOSES_P else HOLDS.get(tag, set())
        if closed and (at := open_.last(closed)) and at > open_.last(held - closed):
            open_.close(at)
        if tag in ("html", "body"):
            continue
        element = Element(tag, stack[-1], stack[-1].gone or _is_furniture(tag, attributes, bool(open_.last(("article", "main")))))
        stack[-1].parts.append(element)
        if not attributes.endswith("/"):
            open_.push(element)
    return root


def _elements(root: Element) -> list[Element]:
    out, todo = [], [root]
    while todo:
        e = todo.pop()
        out.append(e)
        todo += [x for x in reversed(e.parts) if isinstance(x, Element) and not x.gone]
    return out


def best(root: Element) -> Element:
    """The container with most points: each block with text gives its ancestors, REACH of them, points for its length and commas."""
    elements = _elements(root)
    for e in reversed(elements):
        for x in e.parts:
            if isinstance(x, str):
                e.length += len(x.strip())
                e.commas += x.count(",")
            elif not x.gone:
                e.length += x.length
                e.linked += x.length if x.tag == "a" else x.linked
                if x.tag in INLINE:
                    e.commas += x.commas
    for e in elements:
        if e.tag in INLINE or not any(isinstance(x, str) and x.strip() or isinstance(x, Element) and x.tag in INLINE and x.length for x in e.parts):
            continue
        points = (1 + e.commas + min(e.length // 100, 3)) * (1 - e.linked / max(1, e.length))
        up, level = e.up or e, 1
        while up is not None and level <= REACH:
            up.score += points / level
            up, level = up.up, level + 1
    for e in elements:
        e.score *= 1 - e.linked / max(1, e.length)
    top = max((e for e in elements if e.tag not in INLINE), key=lambda e: e.score)
    outer = top
    while outer.up is not None:
        outer = outer.up
        if outer.tag in ("article", "main"):
            top = outer
    return top


def _blocks(element: Element) -> Iterator[str]:
    """Texts of the element's blocks in page order, without furniture."""
    text: list[str] = []
    todo: list = [iter(element.parts)]
    ends = [False]
    while todo:
        x = next(todo[-1], None)
        if x is None:
            todo.pop()
            if ends.pop():
                yield "".join(text)
                text = []
        elif isinstance(x, str):
            text.append(x)
        elif not x.gone:
            block = x.tag not in INLINE
            if block:
                yield "".join(text)
                text = []
            todo.append(iter(x.parts))
            ends.append(block)
    yield "".join(text)


def main_text(page: str | None) -> str:
    """The article's text: the best container with those of its siblings that read like it."""
    if not page:
        return ""
    root = parse(page)
    top = best(root)
    keep = [top]
    if top.up is not None and top.tag not in ("article", "main"):
        least = max(10.0, 0.2 * top.score)
        keep = [x for x in top.up.parts if isinstance(x, Element) and not x.gone and (x is top or x.score >= least or x.tag in ("p", "h1", "h2") and x.length > 0 and x.linked < 0.25 * x.length)]
    clean = (" ".join(html.unescape(t).split()) for e in keep for t in _blocks(e))
    return " ".join(t for t in clean if t)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep` and text, the main text of each page's whole HTML; empty where there is none or html is null.

    Every block of text gives points for its length and commas, less its share of link text, to its ancestors, in
    full to the nearest and ever less above (to 64 of them); a container's sum is discounted by its own link density. The best, or
    the article around it, is kept with siblings of a fifth of its points. Scripts, styles, forms, navigation, adverts,
    notices, comments and the like are cut out by element, role or name first. Character references are decoded,
    white space in a block becomes one space, and blocks are joined by one space. Repeated rows are read each, an empty table
    gives no rows, and a page of any length is read once, in time that grows with it. A kept column named text is renamed text_.
    """
    ship(pages.sparkSession)

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in column], pa.string())

    kept = [F.col(c).alias(c + "_" if c == "text" else c) for c in keep]
    return pages.select(*kept, texts(F.col(html_col).cast("string")).alias("text"))
