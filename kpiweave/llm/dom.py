"""Text blocks of an HTML page, by a tolerant scan with a stack of open block elements."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

BLOCKS = frozenset(
    "html body head p div section article main header footer nav aside h1 h2 h3 h4 h5 h6 ul ol li dl"
    " dt dd table caption thead tbody tfoot tr blockquote pre figure figcaption form fieldset address"
    " details summary hr br noscript menu dialog center hgroup search".split()
)
CELLS = frozenset(("td", "th"))
VOID = frozenset(("hr", "br"))
#: their content is no markup
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: elements that never hold the article
FOREIGN = frozenset(
    "head nav aside footer form menu dialog noscript template svg math canvas object select button"
    " label option datalist search audio video".split()
)
ARTICLE = frozenset(("article", "main"))
#: parts of class names and ids that name what is no article
FOREIGN_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav"
    " navbar navigation menu breadcrumb breadcrumbs sidebar aside cookie cookies consent gdpr notice"
    " notices popup modal overlay newsletter subscribe subscription signup login share sharing social"
    " related recommended recommendations comment comments reply replies respond discussion disqus"
    " widget toolbar pagination pager copyright disclaimer masthead topbar alert".split()
)
#: parts that say nothing against a foreign name beside them ("comment-list", "ad-300x250")
NEUTRAL_NAMES = frozenset(
    "list lists box block wrapper wrap container area section bar item items inner outer top bottom"
    " left right site page panel group row column col slot unit zone link links button buttons icon"
    " icons text title form header footer global primary secondary mobile desktop".split()
)
#: "no-sidebar", "has-header": what the page has or lacks, not what the element is
STATES = frozenset("no not has have with without hide is".split())
EDGE_NAMES = frozenset(("header", "footer"))
ARTICLE_NAMES = frozenset("article post entry story content main".split())
FOREIGN_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu form".split()
)
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"},
    "thead": {"thead", "tbody", "tr"}, "tbody": {"thead", "tbody", "tr"}, "tfoot": {"tbody", "tr"},
}
_BARRIER = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
_NAMES = re.compile(r"[^a-z0-9]+")
_SIZE = re.compile(r"\d+(?:x\d+)?")
_ATTRIBUTE = re.compile(
    r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?",
    re.IGNORECASE,
)
DEEPEST = 40  # levels of a path that are told apart


class Block(NamedTuple):
    path: tuple[str, ...]  # styles (tag and class) of the open elements
    text: str
    foreign: bool  # inside an element that never holds the article
    article: int  # levels down to the nearest article or main element, 0 outside of them


class _Open(NamedTuple):
    tag: str
    style: str
    foreign: bool
    article: int


def _foreign_name(name: str) -> bool:
    """Whether a whole class name or id is that of a foreign element: "ad", "comment-list",
    "post-comments", but not "share-price", "has-sidebar" or "content-sidebar-wrap"."""
    parts = [p for p in _NAMES.split(name) if p]
    rest = {p for p in parts if p not in FOREIGN_NAMES and not _SIZE.fullmatch(p)}
    if FOREIGN_NAMES.isdisjoint(parts):
        return False
    qualified = NEUTRAL_NAMES | ARTICLE_NAMES if parts[-1] in FOREIGN_NAMES else NEUTRAL_NAMES
    return rest <= qualified


def _read(tag: str, attributes: str, inside: bool) -> tuple[str, bool]:
    """The style of an element, and whether it is foreign to the article."""
    foreign = tag in FOREIGN or (tag == "header" and not inside)
    names: list[str] = []
    style = tag
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id"):
                names += value.split()
                if name == "class":
                    style = f"{tag}.{' '.join(sorted(value.split()))}"
            elif name == "role":
                foreign |= value in FOREIGN_ROLES
            elif name == "hidden":
                foreign |= value != "until-found"
            elif name == "aria-hidden":
                foreign |= value == "true"
            else:
                plain = value.replace(" ", "")
                foreign |= "display:none" in plain or "visibility:hidden" in plain
    if names and tag not in ("html", "body") and tag not in ARTICLE and ARTICLE_NAMES.isdisjoint(names):
        foreign |= any(map(_foreign_name, names))
        if not inside:
            parts = [[p for p in _NAMES.split(n) if p] for n in names]
            own = {p for of in parts if of and of[0] not in STATES for p in of}
            foreign |= not EDGE_NAMES.isdisjoint(own) and ARTICLE_NAMES.isdisjoint(own)
    return style, foreign


def blocks(html: str) -> tuple[list[Block], list[tuple[tuple[str, ...], str]]]:
    """The text blocks in page order, and (path, style) of every block element. Time is in
    proportion to the page, however its tags are nested. Elements more than ``DEEPEST`` levels down
    share the path of the level above; their texts are kept like all others."""
    out: list[Block] = []
    depth: Counter[str] = Counter()  # how many elements of each tag are open
    elements: list[tuple[tuple[str, ...], str]] = []
    stack: list[_Open] = []
    pieces: list[str] = []
    at, n = 0, len(html)

    def path() -> tuple[str, ...]:
        return tuple(o.style for o in stack[:DEEPEST])

    def close(first: int) -> None:
        for element in stack[first:]:
            depth[element.tag] -= 1
        del stack[first:]

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                top = stack[-1] if stack else None
                out.append(Block(path(), text, bool(top and top.foreign), top.article if top else 0))

    while at < n:
        low = html.find("<", at)
        if low < 0:
            pieces.append(html[at:])
            break
        if low > at:
            pieces.append(html[at:low])
        next_ = html[low + 1 : low + 2]
        if next_ == "!" or next_ == "?":
            if html.startswith("<!--", low):
                end = html.find("-->", low + 4)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", low)
                at = n if end < 0 else end + 1
            continue
        found = _TAG.match(html, low) if next_.isalpha() or next_ == "/" else None
        if found is None:
            if next_.isalpha() or next_ == "/" and html[low + 2 : low + 3].isalpha():
                end = html.find(">", low)  # an open quote: the tag ends at the next >
                at = n if end < 0 else end + 1
            else:
                pieces.append("<")
                at = low + 1
            continue
        tag, at = found[1].lower(), found.end()
        if next_ == "/":
            if tag in CELLS:
                pieces.append(" ")
            elif tag in BLOCKS or tag in FOREIGN:
                flush()
                if depth[tag]:
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
            at = n if end is None else end.start()
            continue
        if tag in CELLS:
            pieces.append(" ")
            continue
        if tag not in BLOCKS and tag not in FOREIGN:
            continue
        flush()
        if tag in VOID:
            continue
        if stack and stack[-1].tag == "p" and tag not in ("button", "label"):
            close(len(stack) - 1)
        closes = _CLOSED_BY.get(tag, ())
        if any(depth[c] for c in closes):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in closes:
                    close(i)
                    break
                if stack[i].tag in _BARRIER.get(tag, ("table",)):
                    break
        if tag == "body":
            while stack and stack[-1].tag == "head":
                close(len(stack) - 1)
        above = stack[-1] if stack else None
        inside = above.article if above else 0
        style, foreign = _read(tag, found[2], inside > 0)
        if len(stack) < DEEPEST:
            elements.append((path(), style))
        foreign |= bool(above and above.foreign)
        if found[2].endswith("/") and tag in FOREIGN:
            continue
        article = len(stack) + 1 if tag in ARTICLE else inside
        stack.append(_Open(tag, style, foreign, article))
        depth[tag] += 1
    flush()
    return out, elements
