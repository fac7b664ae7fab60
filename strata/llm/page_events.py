"""A page as a sequence of markup tokens and blocks of text, read in one pass.

A token carries where it stands: its hash runs over the names (element, classes, id, role)
of the elements around it, so that the same tag in a menu and in an article are two tokens.
Markup errors cost nothing: end tags without a start are skipped, missing ones are implied
by the next block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import xxhash

# How HTML groups its elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
LEFT_OUT = frozenset(
    "head title script style noscript template nav menu footer aside form search button select option optgroup datalist textarea label "
    "iframe noembed noframes object svg math canvas video audio dialog fieldset legend".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist".split())
# Words in a class or id that name what is not the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promoted promotion "
    "banner banners cookie cookies consent gdpr notice notices alert alerts newsletter subscribe subscription signup login popup popups "
    "modal overlay nav navbar navigation navi menu menus breadcrumb breadcrumbs pagination pager header masthead topbar footer sidebar "
    "sidebars aside widget widgets related recommended recommendations share sharing social comment comments commentlist disqus reply "
    "replies respond discussion toolbar search form skip hidden".split())
# Elements that end one of their own kind which was left open.
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",), "tbody": ("td", "th", "tr", "thead", "tbody"), "tfoot": ("td", "th", "tr", "thead", "tbody")}

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_ADDRESS = re.compile(r"(?<=href)\s*=\s*\"[^\"]*")  # of a link: each has another
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}

OWN, NAMED, ARTICLE, MAIN = 1, 2, 4, 8  # flags: left out by element, by name; within an article, within main
BODY = 0  # token hash that every page has once
SHORT = 300  # characters of a tag that is remembered


class Event(NamedTuple):
    """``text`` is None for markup. ``linked``: code points of the text inside links. Text
    that an element or a name leaves out makes no event."""

    token: int
    text: str | None = None
    flags: int = 0
    linked: int = 0


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape("".join(values)))
    return out


def _words(value: str) -> list[str]:
    """Lower-case words of classes and ids; one behind "with", "has" or "no" names nothing."""
    out: list[str] = []
    for part in value.split():
        found = [w.lower() for w in _WORD.findall(part)]
        out += [w for i, w in enumerate(found) if not (i and found[i - 1] in ("with", "has", "no", "without"))]
    return out


def _digest(name: str, parent: int) -> int:
    return xxhash.xxh64_intdigest(name.encode(), seed=parent) or 1


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


@lru_cache(1 << 14)
def _step(name: str, parent: int) -> tuple[int, Event]:
    """Hash of a path that goes on with ``name``, and the event for it."""
    token = _digest(name, parent)
    return token, Event(_signed(token))


class _Tag(NamedTuple):
    shown: str  # name, classes, id and role, digits as #
    block: bool
    kept: bool  # on the stack until it ends
    own: bool  # left out by element, role or style
    names: frozenset[str]  # words that say it is not the article
    link: bool


@lru_cache(1 << 13)
def _tag(name: str, raw: str) -> _Tag:
    attributes = _attributes(raw) if raw and not raw.isspace() else {}
    role, named = attributes.get("role", "").lower(), f"{attributes.get('class', '')} {attributes.get('id', '')}"
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    block, left_out = name in BLOCKS, name in LEFT_OUT
    return _Tag(
        re.sub(r"\d+", "#", " ".join([name, *sorted(named.split()), role])), block,
        name not in VOID and (block or left_out or hidden or role in ROLES),
        left_out or hidden or role in ROLES, NAMES.intersection(_words(named)), name == "a" and "href" in attributes)


class _Reader:
    def __init__(self):
        self.events: list[Event] = []
        self.stack: list[tuple[str, int, int]] = []  # element, hash of the path, flags
        self.open: Counter[str] = Counter()
        self.held: list[str] = []
        self.where = (1, 0)  # path and flags of the block that is held
        self.linked: list[str] = []
        self.in_link = False

    @property
    def path(self) -> int:
        return self.stack[-1][1] if self.stack else 1

    @property
    def flags(self) -> int:
        return self.stack[-1][2] if self.stack else 0

    def text(self, raw: str) -> None:
        if raw and not self.flags & (OWN | NAMED):
            shown = html.unescape(raw) if "&" in raw else raw
            if not self.held:
                self.where = self.path, self.flags
            self.held.append(shown)
            if self.in_link:
                self.linked.append(shown)

    def end_block(self) -> None:
        if self.held:
            shown = " ".join("".join(self.held).split())
            if shown:
                linked = len(" ".join("".join(self.linked).split())) if self.linked else 0
                self.events.append(Event(_signed(_digest("#" + shown, self.where[0])), shown, self.where[1], linked))
            self.held, self.linked = [], []

    def pop(self) -> None:
        name = self.stack.pop()[0]
        self.open[name] -= 1

    def start(self, name: str, raw: str) -> None:
        raw = _ADDRESS.sub('="', raw, count=1) if name == "a" else raw
        # Long ones are not remembered.
        tag = _tag(name, raw) if len(raw) <= SHORT else _tag.__wrapped__(name, raw)
        if tag.block:
            self.end_block()
            self.in_link = self.in_link and name not in ("p", "li")
            if self.stack and self.stack[-1][0] == "p":
                self.pop()
            while self.stack and self.stack[-1][0] in _SIBLINGS.get(name, ()):
                self.pop()
        elif name == "br":
            self.text(" ")
        elif name == "a":
            self.in_link = tag.link
        token, event = _step(tag.shown, self.path) if len(tag.shown) <= SHORT else _step.__wrapped__(tag.shown, self.path)
        self.events.append(event)
        if not tag.kept:
            return
        flags, within = self.flags, self.flags & (ARTICLE | MAIN)
        if tag.own or name == "header" and not within:
            flags |= OWN
        names = tag.names - {"header"} if within else tag.names
        if name in ("article", "main"):
            flags = flags & ~NAMED | (NAMED if names else ARTICLE if name == "article" else MAIN)
        elif names and name not in ("html", "body"):
            flags |= NAMED
        self.stack.append((name, token, flags))
        self.open[name] += 1

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.end_block()
        if name == "a":
            self.in_link = False
        if self.open[name] > 0:
            while self.stack[-1][0] != name:
                self.pop()
            self.pop()
        step = _step if len(name) <= SHORT else _step.__wrapped__
        self.events.append(step("/" + name, self.path)[1])


def events(source: str) -> list[Event]:
    """Tokens in page order; first of all the one that stands for the page."""
    reader, at = _Reader(), 0
    reader.events.append(Event(BODY))
    last = source.rfind(">") + 1
    while True:
        found = _MARKUP.search(source, at, last)
        if found is None:
            break
        reader.text(source[at:found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            if found[0].startswith("<!--") and not found[0].endswith(("-->", "--!>")):
                at = len(source)  # a comment that never ends
            continue
        if found[1] or found[4]:
            reader.end(name)
            continue
        reader.start(name, found[3] or found[6] or "")
        if name in RAW:
            close = _END[name].search(source, at)
            at = close.start() if close else len(source)
            last = max(last, at)
    # Behind the last ">" nothing is markup; what begins like some was cut off.
    tail = source[at:]
    cut = re.search(r"<[A-Za-z/!?]", tail)
    reader.text(tail[:cut.start()] if cut else tail)
    reader.end_block()
    return reader.events
