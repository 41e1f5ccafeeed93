"""Leaf blocks of HTML pages with their ancestors; a small tolerant reader.

Time and memory are linear in the page, also for markup that never ends: a tag that has no end
is text, and what the search for its end has passed over is not searched again. What a block
knows of its ancestors is kept up to date as tags open and close, not copied from the stack.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre"
    " section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SKIPPED = frozenset("script style noscript template textarea iframe svg math object canvas title select".split())
#: An opening tag that ends an open element of the same kind.
ENDS_SAME = frozenset("p li dt dd tr td th option".split())
#: Opening tags that end an open paragraph.
ENDS_PARAGRAPH = BLOCK_TAGS - {"br", "button", "label"}

#: Markup that is no tag, to its end or that of the page.
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>", re.DOTALL)
_TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: What of a tag stands before its end, a further angle bracket or a quote without an end.
_INSIDE = re.compile(r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+""")
_ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Attribute by which labelled pages mark what belongs to the main text, or does not.
KEEP, DROP = "data-keep", "data-drop"


@dataclass
class Block:
    text: str
    tags: frozenset[str]
    inner: str
    names: frozenset[str]
    near: frozenset[str]
    linked: int
    label: int


def _names(attributes: str) -> tuple[frozenset[str], int]:
    """Word parts of class, id and role, and a label mark (1, -1, or 0)."""
    found, mark = set(), 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        if name.lower() in ("class", "id", "role"):
            found.update(part.lower() for part in _PART.findall(value))
        elif name == KEEP:
            mark = 1
        elif name == DROP:
            mark = -1
    return frozenset(found), mark


class _Marks:
    """Tags and other markup of a page, in order."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = page.rfind(">")
        self.hopeless: set[int] = set()

    def _tag_end(self, start: int, at: int) -> int | None:
        """Place of the bracket that ends a tag, else None.

        A search that fails has passed brackets outside quotes, from which it would fail
        alike; it stops at one that an earlier search has passed.
        """
        passed = [start]
        while True:
            at = _INSIDE.match(self.page, at).end()
            mark = self.page[at : at + 1]
            if mark == ">":
                return at
            if mark != "<" or at in self.hopeless:
                self.hopeless.update(passed)
                return None
            passed.append(at)
            at += 1

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start and end of the next mark, whether it is an end tag (``/``), its tag ("" for
        other markup) and its attributes."""
        while True:
            start = self.page.find("<", at)
            if start < 0:
                return None
            if other := _OTHER.match(self.page, start) if start < self.last or self.page.startswith(("<!--", "<![CDATA["), start) else None:
                return start, other.end(), "", "", ""
            name = _TAG_NAME.match(self.page, start) if start < self.last and start not in self.hopeless else None
            end = self._tag_end(start, name.end()) if name else None
            if end is not None:
                return start, end + 1, name.group(1), name.group(2).lower(), self.page[name.end() : end]
            at = start + 1


_NONE: frozenset[str] = frozenset()


class _Open:
    """Open elements, with what a block below them knows."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, frozenset[str], int, frozenset[str]]] = []
        self.tags: dict[str, int] = {}
        self.names: dict[str, int] = {}
        self.tag_set: frozenset[str] | None = _NONE
        self.name_set: frozenset[str] | None = _NONE

    def push(self, tag: str, names: frozenset[str], label: int) -> None:
        _, _, above, near = self.stack[-1] if self.stack else ("", _NONE, 0, _NONE)
        self.stack.append((tag, names, label or above, names or near))
        if tag not in self.tags:
            self.tag_set = None
        self.tags[tag] = self.tags.get(tag, 0) + 1
        for name in names:
            if name not in self.names:
                self.name_set = None
            self.names[name] = self.names.get(name, 0) + 1

    def pop_to(self, tag: str) -> None:
        """Close the nearest element of a kind and all in it; nothing where none is open."""
        while tag in self.tags:
            inner, names, _, _ = self.stack.pop()
            if self.tags[inner] == 1:
                del self.tags[inner]
                self.tag_set = None
            else:
                self.tags[inner] -= 1
            for name in names:
                if self.names[name] == 1:
                    del self.names[name]
                    self.name_set = None
                else:
                    self.names[name] -= 1
            if inner == tag:
                return

    def block(self, text: str, linked: int) -> Block:
        inner, _, label, near = self.stack[-1] if self.stack else ("", _NONE, 0, _NONE)
        if self.tag_set is None:
            self.tag_set = frozenset(self.tags)
        if self.name_set is None:
            self.name_set = frozenset(self.names)
        return Block(text, self.tag_set, inner, self.name_set, near, linked, int(label > 0))


def blocks(page: str | None) -> list[Block]:
    """Blocks with text, in page order; character references decoded, white space joined.

    Unclosed and misplaced tags are tolerated: an end tag closes the nearest element of its
    kind, one without such an element is ignored.
    """
    page = page or ""
    out: list[Block] = []
    elements = _Open()
    parts: list[str] = []
    linked = 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            parts.append(raw)
            if "a" in elements.tags:
                linked += len(raw)

    def close_block() -> None:
        nonlocal linked
        if parts:
            joined = " ".join(html.unescape("".join(parts)).split())
            if joined:
                out.append(elements.block(joined, linked))
            parts.clear()
        linked = 0

    marks, at = _Marks(page), 0
    while True:
        mark = marks.after(at)
        if mark is None:
            text(page[at:])
            break
        start, end, closes, tag, attributes = mark
        text(page[at:start])
        at = end
        if page.startswith("<![CDATA[", start):
            text(page[start + 9 : end - 3])
        if not tag:
            continue
        if closes:
            if tag in BLOCK_TAGS:
                close_block()
            elements.pop_to(tag)
            continue
        if tag in SKIPPED and not attributes.endswith("/"):
            if tag in BLOCK_TAGS:
                close_block()
            closing = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if tag in BLOCK_TAGS:
            close_block()
            if tag in ENDS_PARAGRAPH:
                elements.pop_to("p")
            if tag in ENDS_SAME and any(t == tag for t, *_ in elements.stack[-3:]):
                elements.pop_to(tag)
        if tag not in VOID_TAGS and not attributes.endswith("/"):
            names, label = _names(attributes) if attributes else (frozenset(), 0)
            elements.push(tag, names, label)
    close_block()
    return out
