"""A page as a tree of its block elements, with numbers that describe each of them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

_OPENING = re.compile(r"<(?:!--|[!?]|/?(?=[a-zA-Z]))")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SPECIAL = re.compile(r"[\"'>]")
#: Decimal references of so many digits are beyond all characters.
_LONG_REFERENCE = re.compile(r"&#([0-9]{9,})")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")

# Fixed values of the HTML standard: elements without content, elements whose content is
# not markup, and elements that run on with the text around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# An opening tag of the first kind ends an open one of the others.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = frozenset("ul ol dl table select article section div body html main aside nav".split())
_raw_end = {name: re.compile(rf"</{name}\b", re.IGNORECASE) for name in RAW}


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: tuple[str, ...] = ()
    #: Characters below it, those in links, punctuation, and elements of any kind.
    chars: int = 0
    linked: int = 0
    marks: int = 0
    elements: int = 0
    blocks: int = 0
    children: list[int] = field(default_factory=list)


@dataclass
class Page:
    nodes: list[Node]
    #: Node and text of each block in page order.
    blocks: list[tuple[int, str]]


def tokens_of(rest: str) -> tuple[str, ...]:
    """Words of the class, id and role attributes, in lower case."""
    found: list[str] = []
    for _, *values in _ATTRIBUTE.findall(rest):
        for part in "".join(values).replace("_", " ").replace("-", " ").split():
            found += [w.lower() for w in _WORD.findall(part)]
    return tuple(dict.fromkeys(found))


class Tags:
    """Tags of a page one after the other, in linear time for any text.

    A name runs to white space, ``/`` or ``>``; a tag ends at the first ``>`` outside quoted values; where a quote in it is never closed,
    at the first ``>`` at all.  Without any ``>`` left there are no more tags, and comments
    that are not closed run to the end.
    """

    def __init__(self, source: str):
        self.source = source
        self._special = self._close = -1
        #: Quotes from which no tag's end is reached.
        self._dead: set[int] = set()

    def _next_special(self, at: int) -> int:
        if self._special < at:
            found = _SPECIAL.search(self.source, at)
            self._special = found.start() if found else len(self.source)
        return self._special

    def _quoted_end(self, at: int) -> int:
        """Where a tag ends whose attributes begin at ``at``; -1 if a quote in it stays open."""
        source, passed = self.source, []
        while True:
            at = self._next_special(at)
            if at < len(source) and source[at] == ">":
                return at + 1
            close = -1
            if at < len(source) and at not in self._dead:
                passed.append(at)
                close = source.find(source[at], at + 1)
            if close < 0:
                self._dead.update(passed)
                self._special = -1
                return -1
            at = close + 1

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, name (empty for comments and declarations), whether it ends an element, attributes."""
        source = self.source
        while found := _OPENING.search(source, at):
            start, inner = found.span()
            if found[0] == "<!--":
                end = source.find("-->", inner)
                return start, end + 3 if end >= 0 else len(source), "", False, ""
            if self._close < inner:
                self._close = source.find(">", inner)
                if self._close < 0:
                    self._close = len(source)
            if self._close == len(source):  # only a comment can follow
                start = source.find("<!--", start)
                if start < 0:
                    return None
                at = start
                continue
            if found[0] in ("<!", "<?"):
                return start, self._close + 1, "", False, ""
            name = _NAME.match(source, inner)
            end = self._quoted_end(name.end())
            rest = source[name.end() : end - 1] if end >= 0 else ""
            return start, end if end >= 0 else self._close + 1, name[0].lower(), found[0] == "</", rest
        return None


def _plain(text: str) -> str:
    """Character references decoded."""
    if "&" not in text:
        return text
    return html.unescape(_LONG_REFERENCE.sub(lambda m: "&#" + (m[1].lstrip("0")[:9] or "0"), text))


def parse(source: str | None) -> Page:
    """Lenient: tags that are not closed end with what they are in; stray ends count for nothing.

    Text outside all elements is in the body, as in browsers; where there is none, one begins with it.
    """
    nodes = [Node("#page", -1, 0)]
    blocks: list[tuple[int, str]] = []
    stack = [0]
    places: dict[str, list[int]] = {}  # of open elements in the stack, by tag
    scopes: list[int] = []
    body = 0
    pieces: list[str] = []
    links = linked = inline = 0

    def enter(node: Node) -> None:
        nonlocal body
        nodes.append(node)
        nodes[node.parent].children.append(len(nodes) - 1)
        places.setdefault(node.tag, []).append(len(stack))
        if node.tag in SCOPES:
            scopes.append(len(stack))
        if node.tag == "body" and not body:
            body = len(nodes) - 1
        stack.append(len(nodes) - 1)

    def flush() -> None:
        nonlocal pieces, linked, inline
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                own = stack[-1]
                if not own:
                    if not body:
                        enter(Node("body", 0, 1))
                    own = body
                node = nodes[own]
                node.chars += len(text)
                node.linked += min(linked, len(text))
                node.marks += sum(map(text.count, ".,;:!?"))
                node.blocks += 1
                blocks.append((own, text))
            pieces = []
        nodes[stack[-1]].elements += inline
        linked = inline = 0

    def close(upto: int) -> None:
        flush()
        while len(stack) > upto:
            tag = nodes[stack.pop()].tag
            places[tag].pop()
            if tag in SCOPES:
                scopes.pop()

    source = (source or "").removeprefix("\ufeff")
    tags = Tags(source)
    at = 0
    while at < len(source):
        found = tags.next(at)
        text = source[at : found[0] if found else len(source)]
        if text:
            text = _plain(text)
            pieces.append(text)
            if links:
                linked += len(text)
        if not found:
            break
        _, at, name, ends, rest = found
        if not name:
            continue
        if name in INLINE:
            inline += 1
            if name == "a":
                links = 0 if ends else 1
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if ends:
            links = 0
            if places.get(name):
                close(places[name][-1])
            else:
                flush()
            continue
        if name in RAW:
            end = _raw_end[name].search(source, at)
            at = source.find(">", end.end()) + 1 if end else 0
            at = at or len(source)
            nodes[stack[-1]].elements += 1
            continue
        flush()
        if name in VOID:
            nodes[stack[-1]].elements += 1
            continue
        links = 0
        closed = max((places[tag][-1] for tag in ("p", *CLOSES.get(name, ())) if places.get(tag)), default=0)
        if closed > (scopes[-1] if scopes else 0):
            close(closed)
        parent = stack[-1]
        enter(Node(name, parent, nodes[parent].depth + 1, tokens_of(rest)))
    flush()
    for place in range(len(nodes) - 1, 0, -1):  # parents come before their children
        own, above = nodes[place], nodes[nodes[place].parent]
        above.chars += own.chars
        above.linked += own.linked
        above.marks += own.marks
        above.elements += own.elements + 1
        above.blocks += own.blocks
    return Page(nodes, blocks)


FEATURES = (
    "tag", "tokens_low", "tokens_high", "above_low", "above_high", "nearest", "depth", "chars", "density",
    "link_share", "marks", "blocks", "children", "place", "siblings", "same_tag", "sibling_chars", "page_share",
)


def describe(page: Page, lean: dict[str, float]) -> np.ndarray:
    """One row of ``FEATURES`` per node; ``lean``: log-odds of tags and attribute words."""
    nodes = page.nodes
    rows = np.zeros((len(nodes), len(FEATURES)))
    ways: list[tuple[float, float, float]] = []  # lowest, highest and nearest that says something, so far
    total = max(1, nodes[0].chars)
    for at, node in enumerate(nodes):
        tag = lean.get(f"<{node.tag}", 0.0)
        words = [lean.get(w, 0.0) for w in node.tokens]
        low, high = (min(words), max(words)) if words else (0.0, 0.0)
        above_low, above_high, nearest = ways[node.parent] if at else (0.0, 0.0, 0.0)
        own = min((tag, low, high), key=lambda x: (-abs(x), x))
        ways.append((min(above_low, tag, low), max(above_high, tag, high), own if abs(own) > 0.5 else nearest))
        peers = nodes[node.parent].children if at else [0]
        around = nodes[node.parent] if at else node
        rows[at] = (
            tag, low, high, above_low, above_high, nearest, node.depth, np.log1p(node.chars),
            node.chars / (1 + node.elements), node.linked / max(1, node.chars), np.log1p(node.marks),
            np.log1p(node.blocks), np.log1p(len(node.children)),
            0.0, np.log1p(len(peers)), 0.0, np.log1p(around.chars - node.chars), node.chars / total,
        )
    for node in nodes:
        kinds: dict[str, int] = {}
        for child in node.children:
            kinds[nodes[child].tag] = kinds.get(nodes[child].tag, 0) + 1
        for turn, child in enumerate(node.children):
            rows[child, 13] = turn / max(1, len(node.children) - 1)
            rows[child, 15] = kinds[nodes[child].tag] / len(node.children)
    return rows
