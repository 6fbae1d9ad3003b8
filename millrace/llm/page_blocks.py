"""A page as its blocks of text, each with the path of the elements it stands in."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash

# Element names, and words in class, id and role that tell what an element holds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q s samp small span strike strong "
    "sub sup time tt u var wbr ruby rb rt rp img".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote body center details dialog dir div dl dd dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CONTAINERS = frozenset("body div section article main".split())
LEFT_OUT = frozenset(
    "head nav footer aside form button select option label menu dialog object video audio canvas map applet "
    "frameset search script style textarea title noscript template iframe xmp noembed noframes svg math".split()
)
LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split()
)
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promotion promoted "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidebars widget widgets footer masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe "
    "subscription signup signin login share sharing social related recommended recommendations "
    "comment comments commentlist reply replies respond disqus discussion pagination pager skip copyright disclaimer".split()
)
KEPT_WHATEVER_CLASS = frozenset(("html", "body", "main"))

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>|<[!?/][^>]*>", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
UNFINISHED = re.compile(r"<[a-zA-Z/!?]")


@dataclass(slots=True)
class Block:
    """A block's text in one line; the slot it stands in, and all containers around it."""

    text: str
    slot: int
    semantic: bool
    containers: tuple[int, ...]
    linked: int  # characters in links

    def token(self) -> int:
        return xxhash.xxh3_64_intdigest(f"{self.slot} {self.text}")


@dataclass(slots=True)
class _Element:
    name: str
    kept: bool
    path: int
    slot: int
    semantic: bool
    containers: tuple[int, ...]
    links: int


@dataclass
class Page:
    """Blocks in page order, and how often each path of block elements occurs."""

    blocks: list[Block] = field(default_factory=list)
    paths: dict[int, int] = field(default_factory=dict)


def _path(parent: int, label: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{parent} {label}")


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, one, two, three in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(one or two or three))
    return found


def _label(name: str, attributes: dict[str, str]) -> str:
    """Name, classes and id, without digits of ids and long numbers of classes, which often count pages."""
    classes = re.sub(r"\d{3,}", "", attributes.get("class", "")).split()
    return " ".join([name, *sorted(classes), "#" + re.sub(r"\d+", "", attributes.get("id", ""))])


def _is_left_out(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in LEFT_OUT or (name == "header" and not in_article):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if name in KEPT_WHATEVER_CLASS:
        return False
    if not LEFT_OUT_ROLES.isdisjoint(attributes.get("role", "").lower().split()):
        return True
    told = attributes.get("class", "") + " " + attributes.get("id", "")
    return any(word.lower() in LEFT_OUT_WORDS for word in WORD.findall(told))


def read_page(source: str | None) -> Page:
    """The blocks of a page. Markup that is not closed, cut off or wrongly nested does no harm.

    What menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments hold
    is left out where elements or their classes, ids and roles say so. Character references are decoded and
    white space in a block is one space.
    """
    page = Page()
    if not source:
        return page
    top = _Element("", True, 0, 0, False, (), 0)
    stack = [top]
    pieces: list[str] = []
    linked = 0
    position, size = 0, len(source)

    def say(text: str) -> None:
        nonlocal linked
        here = stack[-1]
        if here.kept and text:
            if "&" in text:
                text = html.unescape(text)
            pieces.append(text)
            if here.links:
                linked += len(text.strip())

    def end_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                here = stack[-1]
                page.blocks.append(Block(text, here.slot, here.semantic, here.containers, min(linked, len(text))))
            pieces.clear()
            linked = 0

    def close(at: int) -> None:
        if any(e.name not in INLINE for e in stack[at:]):
            end_block()
        del stack[at:]

    def close_open(names: set[str], borders) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].name in names:
                close(at)
                return
            if stack[at].name in borders:
                return

    while position < size:
        found = TOKEN.search(source, position)
        if found is None:
            rest = UNFINISHED.search(source, position)
            say(source[position:rest.start() if rest else size])
            break
        say(source[position:found.start()])
        position = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            if name == "p" and not any(e.name == "p" for e in stack):
                end_block()
            for at in range(len(stack) - 1, 0, -1):
                if stack[at].name == name:
                    close(at)
                    break
                if name in INLINE and stack[at].name in CLOSES_PARAGRAPH:
                    break
            continue
        if name in VOID:
            if name in ("br", "hr"):
                say(" ")
            if name == "hr":
                end_block()
            continue
        if name in RAW:
            if name in ("svg", "math", "template") and found[3].rstrip().endswith("/"):
                continue
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(source, position)
            position = end.end() if end else size
            if name in ("textarea", "iframe"):
                say(" ")
            continue
        if name in CLOSES_PARAGRAPH:
            close_open({"p"}, ("td", "th", "table", "button", "object"))
        if name in CLOSES:
            close_open(*CLOSES[name])
        outer = stack[-1]
        attributes = _attributes(found[3]) if found[3].strip(" /\n\t\r") else {}
        in_article = outer.semantic
        kept = outer.kept and not _is_left_out(name, attributes, in_article)
        if name in INLINE:
            links = outer.links + (name == "a")
            stack.append(_Element(name, kept, outer.path, outer.slot, outer.semantic, outer.containers, links))
            continue
        end_block()
        path, slot, semantic, containers = _path(outer.path, _label(name, attributes)), outer.slot, outer.semantic, outer.containers
        if kept:
            page.paths[path] = page.paths.get(path, 0) + 1
            if name in CONTAINERS:
                containers = (*containers, path)
                if name in ("article", "main"):
                    slot, semantic = (slot if semantic else path), True
                elif not semantic:
                    slot = path
        stack.append(_Element(name, kept, path, slot, semantic, containers, outer.links))
    end_block()
    return page
