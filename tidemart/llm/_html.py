"""Blocks of text of a web page, with the elements they lie in."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

# Element names of the HTML standard (fixed values).
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html
    legend li main menu nav ol optgroup option p pre search section summary table tbody td
    tfoot th thead tr ul""".split()
)
# Elements whose content is not markup, or never text of the page.
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
SILENT = frozenset("audio button canvas datalist head math object select svg video".split())
METADATA = frozenset("base link meta noscript script style template title".split())
# A start tag closes the nearest open element of these, if none of the others lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
SCOPE = frozenset("caption html table td th".split())
# How far the end tags of these reach outwards; other blocks' stay within a cell.
ENDS_IN = {name: frozenset({"table"}) for name in "caption tbody td tfoot th thead tr".split()}
ENDS_IN |= {name: frozenset() for name in "body html table".split()}
# These don't close an open paragraph.
IN_PARAGRAPH = frozenset("body caption html option optgroup tbody td tfoot th thead tr".split())

_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))
      | <[!?][^>]*>?
      | <(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>
      | <(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)""",
    re.S | re.X,
)
_NAMES = re.compile(
    r"""(?<![\w-])(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I
)
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
# Of a path deeper than both together, as left by unclosed tags, a block keeps the
# outermost and the innermost elements.
OUTER, INNER = 8, 56
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Element:
    name: str
    words: tuple[str, ...]


@dataclass(slots=True)
class Block:
    """Text between two edges of block elements, and the open elements there, outermost first."""

    text: str
    path: tuple[Element, ...]
    linked: int  # characters in links


def _words(attrs: str) -> tuple[str, ...]:
    """Words of an element's names, and whether it is hidden."""
    out: list[str] = []
    for found in _NAMES.findall(attrs):
        out += [w.lower() for w in _WORD.findall("".join(found))]
    if _HIDDEN.search(attrs):
        out.append("hidden")
    return tuple(out)


def blocks(html: str) -> list[Block]:
    """Blocks of the page in order, character references decoded, white space as one space.

    Comments, scripts, styles and other elements that show no text give no blocks.
    Start tags close what the standard says they close; end tags without a start are
    ignored; what is open at the end ends there.
    """
    stack: list[Element] = []
    is_open: Counter[str] = Counter()
    out: list[Block] = []
    pieces: list[str] = []
    path: tuple[Element, ...] = ()
    linked = silent = links = 0

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, path, linked))
            pieces, linked = [], 0

    def text_between(a: int, b: int) -> None:
        nonlocal path, linked
        if a >= b:
            return
        text = html[a:b]
        if stack and stack[-1].name == "head" and text.strip():
            pop(len(stack) - 1)
        if silent:
            return
        if "&" in text:
            text = unescape(text)
        if not pieces:
            if not text.strip():
                return
            path = tuple(stack) if len(stack) <= OUTER + INNER else (*stack[:OUTER], *stack[-INNER:])
        pieces.append(text)
        if links:
            linked += len(text)

    def pop(at: int) -> None:
        """Closes the elements from ``at`` on."""
        for e in stack[at:]:
            gone(e.name)
        del stack[at:]

    def gone(name: str) -> None:
        nonlocal silent, links
        is_open[name] -= 1
        silent -= name in SILENT
        links -= name == "a"

    def nearest(names, until=frozenset()) -> int:
        if not any(is_open[n] for n in names):
            return -1
        for at in range(len(stack) - 1, -1, -1):
            if stack[at].name in names:
                return at
            if stack[at].name in until:
                break
        return -1

    at = 0
    while True:
        tag = _MARKUP.search(html, at)
        text_between(at, tag.start() if tag else len(html))
        if tag is None:
            break
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        if tag["close"] or tag["close2"]:
            if name in BLOCK:
                flush()
                found = nearest({name}, ENDS_IN.get(name, SCOPE))
                if found >= 0:
                    pop(found)
            elif (found := nearest({name}, BLOCK if name != "head" else frozenset())) >= 0:
                # An inline element ends alone; what was opened in it stays open.
                gone(name)
                del stack[found]
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if stack and stack[-1].name == "head" and name not in METADATA:
            pop(len(stack) - 1)
        if name == "br":
            if pieces:
                pieces.append(" ")
            continue
        if name in BLOCK:
            flush()
            if name not in IN_PARAGRAPH and (found := nearest({"p"}, SCOPE)) >= 0:
                pop(found)
        if name in CLOSES and (found := nearest(*CLOSES[name])) >= 0:
            pop(found)
        if name in VOID:
            continue
        attrs = tag["attrs"] or tag["attrs2"] or ""
        stack.append(Element(name, _words(attrs) if "=" in attrs or "hidden" in attrs else ()))
        is_open[name] += 1
        silent += name in SILENT
        links += name == "a"
    flush()
    return out
