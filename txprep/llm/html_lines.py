"""The text lines of an HTML page, with what its markup says of each.

A forgiving reader for pages as they are: unclosed and stray tags, raw text
elements, comments and character references. Work is linear in the page.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache
from typing import NamedTuple

#: What the markup says of a line: outside any main element, in ``main``, in an article.
PLAIN, MAIN, ARTICLE = 0, 1, 2

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>""")
_ATTR = re.compile(r"""([^\s"'<>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_CAMEL = re.compile(r"([a-z0-9])([A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre
    section select summary table tbody td tfoot th thead title tr ul script style noscript template iframe""".split())
#: Elements that hold no part of an article's text.
JUNK_TAGS = frozenset("""aside audio button canvas datalist dialog embed footer form head iframe input map menu nav noembed
    noframes noscript object optgroup option script select style svg template textarea title video""".split())
#: Words of class names and ids that mark menus, notices, adverts, forms, sidebars and comments.
JUNK_WORDS = frozenset("""ad adbox ads adsense adslot adunit advert adverts advertisement advertising banner breadcrumb breadcrumbs
    comment commentlist comments consent cookie cookiebanner cookiebar cookieconsent cookienotice cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination
    popup promo promotion recommended related replies reply respond share sharing sidebar signup sponsor sponsored
    sponsors subscribe subscription toolbar widget widgets""".split())
#: In a class name with one of these, a word of ``JUNK_WORDS`` tells of the layout, not of the element.
LAYOUT_WORDS = frozenset("disabled enabled has layout main no not open page with without".split())
JUNK_ROLES = frozenset("alert alertdialog complementary contentinfo dialog form menu menubar navigation search".split())
#: Elements that end an open one of the same kind: (ends, not beyond).
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])), "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}


class Line(NamedTuple):
    text: str
    #: PLAIN, MAIN or ARTICLE
    level: int
    #: its element, or one around it inside the main element, has a class or an id
    named: bool
    #: all of its text is in links
    linked: bool


class _Element(NamedTuple):
    name: str
    junk: bool
    level: int
    #: a page header, if outside any main element
    header: bool
    named: bool


@lru_cache(maxsize=1 << 16)
def _element(name: str, attributes: str) -> _Element:
    found = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attributes)} if attributes else {}
    role = found.get("role", "").strip().lower()
    words: set[str] = set()
    for one in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = set(re.split(r"[^a-z0-9]+", _CAMEL.sub(r"\1 \2", html.unescape(one)).lower()))
        if not parts & LAYOUT_WORDS:
            words |= parts
    level = ARTICLE if name == "article" or role == "article" or found.get("itemprop", "").lower() == "articlebody" else \
        MAIN if name == "main" or role == "main" else PLAIN
    junk = (name in JUNK_TAGS or role in JUNK_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
            or re.search(r"display\s*:\s*none", found.get("style", ""), re.I) is not None
            or (bool(words & JUNK_WORDS) and name not in ("html", "body", "main")))
    header = name == "header" or "header" in words or role == "banner"
    return _Element(name, junk, level, header, "class" in found or "id" in found)


def read_lines(page: str) -> list[Line]:
    """The lines of text outside ``JUNK_TAGS`` and the like, in page order, each
    with white space as single blanks; empty lines are left out."""
    lines: list[Line] = []
    buffer: list[str] = []
    state = {"linked": True, "named": False}
    # per open element: name, junk, level before, named before
    stack: list[tuple[str, bool, int, bool]] = []
    open_names: dict[str, int] = {}
    junk = links = 0
    level, named, line_level = PLAIN, False, PLAIN

    def flush():
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                lines.append(Line(text, line_level, state["named"], state["linked"]))
            buffer.clear()
        state["linked"], state["named"] = True, False

    def close(to: int):
        nonlocal junk, links, level, named
        while len(stack) > to:
            name, was_junk, level, named = stack.pop()
            junk -= was_junk
            links -= name == "a"
            open_names[name] -= 1

    def add(raw: str):
        nonlocal line_level
        if junk or not raw:
            return
        if buffer and line_level != level:
            flush()
        line_level = level
        buffer.append(html.unescape(raw) if "&" in raw else raw)
        state["named"] |= named
        if not links and state["linked"] and not raw.isspace():
            state["linked"] = False

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        following = page[lt + 1:lt + 2]
        if following in ("!", "?"):
            add(page[at:lt])
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2)
                at = end + 3 if end >= 0 else size
            else:
                end = page.find(">", lt)
                at = end + 1 if end >= 0 else size
            continue
        if not (following.isascii() and (following.isalpha() or following == "/")):
            add(page[at:lt + 1])
            at = lt + 1
            continue
        tag = _TAG.match(page, lt)
        if tag is None:
            add(page[at:lt])
            if following == "/" and not page[lt + 2:lt + 3].isalpha():
                end = page.find(">", lt)             # </ and no name: a comment to the next >
                at = end + 1 if end >= 0 else size
                continue
            break                                    # a tag that never ends takes the rest
        add(page[at:lt])
        at = tag.end()
        name = tag[2].lower()
        if tag[1]:
            if not open_names.get(name):
                if name in BLOCK:
                    flush()
                continue
            to = len(stack) - 1
            inline = name not in BLOCK
            while stack[to][0] != name and not (inline and stack[to][0] in BLOCK):
                to -= 1
            if stack[to][0] == name:
                if not inline:
                    flush()
                close(to)
            continue
        element = _element(name, tag[3].rstrip("/").strip())
        if name in BLOCK:
            flush()
            if open_names.get("p"):                  # a block ends an open paragraph
                to = len(stack) - 1
                while stack[to][0] not in BLOCK:
                    to -= 1
                if stack[to][0] == "p":
                    close(to)
            if name in _ENDS and stack:
                ends, bound = _ENDS[name]
                to = len(stack) - 1
                while to >= 0 and stack[to][0] not in ends and stack[to][0] not in bound:
                    to -= 1
                if to >= 0 and stack[to][0] in ends:
                    close(to)
        if name in VOID:
            continue
        is_junk = element.junk or (element.header and level == PLAIN and element.level == PLAIN)
        stack.append((name, is_junk, level, named))
        open_names[name] = open_names.get(name, 0) + 1
        junk += is_junk
        links += name == "a"
        named = False if element.level > level else named or element.named
        level = max(level, element.level)
        if name in RAW:
            end = _raw_end(page, name, at)
            if not is_junk:
                add(page[at:end])
            at = end
    flush()
    return lines


def _raw_end(page: str, name: str, at: int) -> int:
    """Where the end tag of a raw text element begins, or the page's end."""
    found = _raw_pattern(name).search(page, at)
    return found.start() if found else len(page)


@lru_cache(maxsize=32)
def _raw_pattern(name: str):
    return re.compile(rf"</{name}(?=[\s/>])", re.I)


def decided(lines: list[Line]) -> list[bool]:
    """Which lines the markup takes for the article: those in articles; without
    any, those in ``main``; without any, all that aren't mere links."""
    level = max((line.level for line in lines), default=PLAIN)
    return [line.level == level and (level > PLAIN or not line.linked) for line in lines]
