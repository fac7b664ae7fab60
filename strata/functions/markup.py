"""A small forgiving element tree for one page, used inside Arrow batches.

Elements without an end tag stay open until an enclosing one ends. Pages of plain tags are
cut at their ``<``, and a start tag that was met before is not parsed again; any other page
goes through the standard parser as a whole, which also reads each new start tag.
"""

from __future__ import annotations

import re
from functools import cache, lru_cache
from html import unescape
from html.parser import HTMLParser

# Elements that never have an end tag.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


# A start or end tag that means the same wherever it stands, without its ``<`` and ``>``.
_START = re.compile(r'[a-zA-Z][a-zA-Z0-9]*(?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9:_-]*(?:="[^"]*")?)*[ \t\n\r\f]*/?')
_END = re.compile(r"/[a-zA-Z][a-zA-Z0-9]*")
# Where text is taken as it is, up to the end tag of its element.
_RAW = {tag: re.compile(rf"</\s*{tag}\b", re.I) for tag in ("script", "style")}
# Elements whose text other versions of the standard parser take in another way.
_OTHER = frozenset((*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext")) - set(_RAW)


@cache
def _parts(selector: str) -> tuple[str, frozenset[str], str]:
    """(tag, classes, what follows) of ``tag.class.class rest``."""
    first, _, rest = selector.partition(" ")
    tag, *classes = first.split(".")
    return tag, frozenset(classes), rest


class Node:
    """One element: tag, attributes, and children that are nodes or text.

    ``page`` lists all elements in document order; those from ``start`` to ``end`` are
    the descendants.
    """

    __slots__ = ("tag", "attrs", "classes", "children", "page", "start", "end")

    def __init__(self, tag: str, attrs: dict[str, str | None], page: list["Node"], classes: frozenset[str] | None = None):
        self.tag, self.attrs, self.children, self.page = tag, attrs, [], page
        self.classes = frozenset((attrs.get("class") or "").split()) if classes is None else classes
        self.start, self.end = len(page) + 1, None
        page.append(self)

    def all(self, selector: str) -> list["Node"]:
        """Descendants that match ``tag.class.class``, any part of which may be missing;
        ``outer inner`` looks below the first outer match."""
        tag, classes, rest = _parts(selector)
        found = [
            n for n in self.page[self.start:self.end]
            if (not tag or n.tag == tag) and classes <= n.classes
        ]
        if not rest:
            return found
        return found[0].all(rest) if found else []

    def first(self, selector: str) -> "Node | None":
        return next(iter(self.all(selector)), None)

    def pieces(self) -> list[str]:
        """Text of all descendants in document order, scripts and styles left out."""
        if len(self.children) == 1 and isinstance(self.children[0], str):
            return self.children
        found, stack = [], list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                found.append(item)
            elif item.tag not in ("script", "style"):
                stack.extend(reversed(item.children))
        return found

    def text(self) -> str:
        """Pieces stripped one by one and joined."""
        return "".join(p.strip() for p in self.pieces())

    def whole_text(self) -> str:
        """Pieces joined as they are, stripped at both ends."""
        return "".join(self.pieces()).strip()

    def forget(self) -> None:
        """Let go of the list that all elements share, when a page has been read: without
        it they refer to each other in no circle, and nobody has to search for them."""
        self.page.clear()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page: list[Node] = []
        self.open = [Node("", {}, self.page)]

    def _close(self, depth: int) -> None:
        for node in self.open[depth:]:
            node.end = len(self.page)
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        parent = self.open[-1]
        node = Node(tag, dict(attrs), self.page)
        parent.children.append(node)
        self.open.append(node)
        if tag in VOID:
            self._close(-1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(-1)

    def handle_endtag(self, tag):
        # An end tag closes up to its own start; one without a start is ignored.
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                return self._close(depth)

    def handle_data(self, data):
        self.open[-1].children.append(data)


class _OneTag(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: tuple | None = None

    def handle_starttag(self, tag, attrs):
        self.found = tag, dict(attrs), False

    def handle_startendtag(self, tag, attrs):
        self.found = tag, dict(attrs), True


@lru_cache(1 << 12)
def _start(text: str) -> tuple[str, dict[str, str | None], frozenset[str], bool, bool] | None:
    """(tag, attributes, classes, closed at once, raw text follows) of a plain start tag."""
    if not _START.fullmatch(text):
        return None
    one = _OneTag()
    one.feed(f"<{text}>")
    if one.found is None or one.found[0] in _OTHER:
        return None
    tag, attrs, closed = one.found
    return tag, attrs, frozenset((attrs.get("class") or "").split()), closed or tag in VOID, tag in _RAW and not closed


@lru_cache(1 << 12)
def _end(text: str) -> str | None:
    return text[1:].lower() if _END.fullmatch(text) else None


def _plain_tree(html: str) -> Node | None:
    """The tree of a page that has nothing but text and plain tags, else None."""
    page: list[Node] = []
    root = node = Node("", {}, page)
    opened = [root]
    pieces = html.split("<")
    if pieces[0]:
        root.children.append(unescape(pieces[0]))
    i, n = 1, len(pieces)
    while i < n:
        mark, closing, text = pieces[i].partition(">")
        i += 1
        if not closing:
            return None
        if mark[:1] == "/":
            tag = _end(mark)
            if tag is None:
                return None
            for depth in range(len(opened) - 1, 0, -1):
                if opened[depth].tag == tag:
                    for done in opened[depth:]:
                        done.end = len(page)
                    del opened[depth:]
                    node = opened[-1]
                    break
        else:
            found = _start(mark)
            if found is None:
                return None
            tag, attrs, classes, closed, raw = found
            new = Node(tag, attrs, page, classes)
            node.children.append(new)
            if closed:
                new.end = len(page)
            else:
                opened.append(new)
                node = new
            if raw:
                # All up to the end tag is one text; that tag is the next piece.
                rest = [text]
                while i < n and not _RAW[tag].match("<" + pieces[i]):
                    rest.append(pieces[i])
                    i += 1
                if i == n or not pieces[i].startswith(f"/{tag}>") or any(p.startswith("!--") for p in rest):
                    return None
                text = "<".join(rest)
                if text:
                    node.children.append(text)
                continue
        if text:
            node.children.append(unescape(text) if "&" in text else text)
    for done in opened:
        done.end = len(page)
    return root


def tree(html: str) -> Node:
    plain = _plain_tree(html)
    if plain is not None:
        return plain
    builder = _Builder()
    builder.feed(html)
    builder.close()
    root = builder.open[0]
    builder._close(0)
    return root
