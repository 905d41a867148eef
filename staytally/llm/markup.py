"""Leaf blocks of an HTML page, each with its text and what surrounds it."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
    r"""((?:[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[a-z]+")

# The elements of HTML by how they are parsed and shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSHOWN = frozenset(
    "script style noscript template iframe object svg math canvas audio video head title"
    " textarea select datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark"
    " nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_CLOSED_BY_SAME = {
    "li": ("ul", "ol", "menu"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table", "tbody", "thead", "tfoot"),
    "td": ("tr", "table"),
    "th": ("tr", "table"),
    "option": ("select",),
}


@dataclass
class Block:
    text: str
    names: frozenset[str]  # of the tags around it and of the parts of their classes and ids
    tag: str  # the nearest that is not inline
    linked: int  # characters inside links


@dataclass
class _Open:
    tag: str
    names: frozenset[str]
    unshown: bool
    block: str


def _own_names(tag: str, attributes: str, known: dict) -> tuple[frozenset[str], bool]:
    if (found := known.get((tag, attributes))) is None:
        names, hidden = {"tag:" + tag}, False
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                names.update("is:" + part for part in _PART.findall(value))
            hidden |= name == "hidden" or name == "style" and "display:none" in value.replace(" ", "")
            if name == "data-label":
                names.add("label:" + value)
        found = frozenset(names), hidden
        if len(known) < 50_000:
            known[tag, attributes] = found
    return found


def blocks(html: str, known: dict | None = None) -> list[Block]:
    """Blocks in page order. Markup that is broken ends where the next element makes it end."""
    known = {} if known is None else known
    out: list[Block] = []
    stack = [_Open("", frozenset(), False, "")]
    depths: dict[str, list[int]] = {}  # where each tag is open, so that no nesting is too deep to search
    texts: list[str] = []
    linked, links, position = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                top = stack[-1]
                out.append(Block(text, top.names, top.block, linked))
            texts.clear()
            linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1].unshown:
            text = unescape(raw) if "&" in raw else raw
            texts.append(text)
            if links:
                linked += len(text.strip())

    def close(depth: int) -> None:
        nonlocal links
        if any(o.tag not in INLINE for o in stack[depth:]):
            flush()
        for element in stack[depth:]:
            links -= element.tag == "a"
            depths[element.tag].pop()
        del stack[depth:]

    def deepest(tags) -> int:
        return max((depths[tag][-1] for tag in tags if depths.get(tag)), default=0)

    def nearest(tags, until) -> int:
        depth = deepest(tags)
        return depth if depth > deepest(until) else 0

    while match := _TOKEN.search(html, position):
        add(html[position : match.start()])
        position = match.end()
        slash, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if depth := nearest((tag,), ()):
                close(depth)
            continue
        if tag == "br":
            texts.append(" ")
            continue
        if tag not in INLINE:
            flush()
            if depth := nearest(("p",), ("button", "table", "td", "th")):
                close(depth)
            if tag in _CLOSED_BY_SAME and (
                depth := nearest(("dt", "dd") if tag in ("dt", "dd") else (tag,), _CLOSED_BY_SAME[tag])
            ):
                close(depth)
        if tag in VOID:
            continue
        if tag == "body" and (depth := nearest(("head",), ())):
            close(depth)
        own, hidden = _own_names(tag, attributes, known)
        top = stack[-1]
        names = top.names if own <= top.names else top.names | own
        unshown = top.unshown or hidden or tag in UNSHOWN
        depths.setdefault(tag, []).append(len(stack))
        stack.append(_Open(tag, names, unshown, top.block if tag in INLINE else tag))
        links += tag == "a"
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, position)
            position = end.start() if end else len(html)
    add(html[position:])
    flush()
    return out
