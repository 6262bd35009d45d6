"""Text blocks of a web page in reading order, with what is known about their place."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")

#: Elements whose text is no text of the page.
SILENT = frozenset("script style template noscript title head svg math iframe object textarea select option datalist".split())
#: Of these, the ones that only their own end tag closes.
RAW = frozenset("script style textarea title iframe".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Mark that only rendered training pages carry.
TRUTH = "data-truth"


class Place:
    """Where a block stands: the names of one element, and the place that element stands at."""

    __slots__ = ("around", "name", "names", "depth", "size", "truth")

    def __init__(self, around: Place | None, name: str, names: tuple[str, ...], truth: bool | None):
        self.around, self.name, self.names = around, name, names
        self.depth = around.depth + 1 if around else 1
        self.size = (around.size if around else 0) + len(names)
        self.truth = truth if truth is not None or around is None else around.truth

    def outwards(self) -> Iterator[Place]:
        at: Place | None = self
        while at is not None:
            yield at
            at = at.around


@dataclass
class Block:
    text: str
    #: Innermost element around it, None for text outside of all.
    place: Place | None
    link_chars: int = 0
    truth: bool | None = None

    @property
    def path(self) -> tuple[str, ...]:
        """Element names and the words of class, id and role, outermost first."""
        around = list(self.place.outwards()) if self.place else []
        return tuple(t for p in reversed(around) for t in p.names)


def _tokens(name: str, attributes: str) -> tuple[str, ...]:
    out = [name]
    if attributes:
        for m in _NAMES.finditer(attributes):
            value = m.group(2) or m.group(3) or m.group(4) or ""
            out += [f".{w}" for w in _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())]
    return tuple(out)


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page; character references decoded, white space made one space. Markup may be broken."""
    out: list[Block] = []
    stack: list[Place] = []
    # Names of the open elements, so that an end tag without its element costs nothing on a deep page.
    open_: Counter[str] = Counter()
    parts: list[str] = []
    links, silent, at = 0, 0, 0
    page = page or ""

    def close_block() -> None:
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                place = stack[-1] if stack else None
                out.append(Block(text, place, min(links, len(text)), place.truth if place else None))
            parts.clear()
        links = 0

    def end() -> str:
        """Closes the innermost element."""
        nonlocal silent
        name = stack.pop().name
        open_[name] -= 1
        silent -= name in SILENT
        return name

    anchors = 0
    while at < len(page):
        m = _TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text and not silent:
            parts.append(text)
            if anchors:
                links += len(text)
        if not m:
            break
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        closing = bool(m.group(1) or m.group(4))
        attributes = m.group(3) or m.group(6) or ""
        if name in INLINE:
            if name == "a":
                anchors = 0 if closing else 1
            elif name == "br":
                parts.append(" ")
            continue
        close_block()
        if closing:
            if open_[name]:
                while end() != name:
                    pass
                anchors = 0
            continue
        if name in EMPTY or attributes.endswith("/"):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th") and stack and stack[-1].name == name:
            end()
        elif stack and stack[-1].name == "p":
            end()
        if name == "body":
            while open_["head"]:
                end()
        truth = None
        if TRUTH in attributes:
            truth = f'{TRUTH}="1"' in attributes
        stack.append(Place(stack[-1] if stack else None, name, _tokens(name, attributes), truth))
        open_[name] += 1
        silent += name in SILENT
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            end()
    close_block()
    return out
