"""A small reader of listing markup: find elements by a descendant selector."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

_VALUE = r"""(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>"'][^\s>]*))"""
_ATTRIBUTE = re.compile(rf"""([^\s=/"'<>]+)(?:\s*=\s*{_VALUE})?""")
# The inside of a tag. A quote opens a value only after an equals sign, and a value
# or tag that is never closed takes the rest of the page, once.
_INSIDE = r"""(?:[^>=]|=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|=(?!\s*["']))*+"""
_SKIPPED = r"<!--.*?(?:-->|\Z)|<(?:script|style)\b.*?(?:</(?:script|style)\s*>|\Z)"
_ANY_TAG = re.compile(rf"""{_SKIPPED}|</?[a-zA-Z]{_INSIDE}(?:>|\Z)""", re.S | re.I)
_VOID = {"img", "br", "input", "hr", "meta", "link", "source", "wbr"}
# Opening one of these ends an open paragraph.
_BLOCKS = {"p", "div", "ul", "ol", "li", "article", "section", "nav", "h1", "h2", "h3", "h4", "form"}


_LISTS = {"ul", "ol"}
_CLASS = re.compile(rf"""\bclass\s*=\s*{_VALUE}""", re.I)


class Node:
    """One element: its tag, ancestors, attribute text and text span in the page."""

    __slots__ = ("tag", "raw", "parent", "start", "end", "classes")

    def __init__(self, tag: str, raw: str, parent: Node | None, start: int):
        self.tag, self.raw, self.parent = tag, raw, parent
        self.start = self.end = start
        found = _CLASS.search(raw) if raw else None
        self.classes = set((found[1] or found[2] or found[3] or "").split()) if found else _NO_CLASSES

    def get(self, name: str) -> str | None:
        """Value of an attribute, entities resolved; the first of repeated ones."""
        for found, double, single, bare in _ATTRIBUTE.findall(self.raw):
            if found.lower() == name:
                return unescape(double or single or bare)
        return None


_NO_CLASSES: set[str] = set()


@lru_cache(maxsize=256)
def compile_selector(selector: str) -> tuple[tuple[str, frozenset[str]], ...]:
    """``"ul.pager li.next a"`` as (tag, classes) steps, outermost first."""
    steps = []
    for part in selector.split():
        tag, *classes = part.split(".")
        steps.append((tag.lower(), frozenset(classes)))
    return tuple(steps)


@lru_cache(maxsize=64)
def _tag_scanner(tags: frozenset[str]) -> re.Pattern[str]:
    names = "|".join(sorted(tags | _BLOCKS))
    return re.compile(
        rf"""{_SKIPPED}|<(/?)({names})(?=[\s/>])({_INSIDE})(?:>|\Z)""", re.S | re.I
    )


def read_nodes(html: str, selectors: tuple[str, ...]) -> list[Node]:
    """Elements of the tags the selectors mention, in document order.

    Markup need not be well formed: a block ends an open paragraph, a list item the
    one before it in its list, a link an open link, and an end tag everything
    opened inside its element. Blocks count whether selectors name them or not.
    """
    tags = frozenset(tag for s in selectors for tag, _ in compile_selector(s))
    nodes: list[Node] = []
    open_nodes: list[Node] = []
    standing: dict[str, list[int]] = {}  # places of the open elements of a tag
    items = [0]  # open list items of each open list, outside any list first

    def close(depth: int, at: int) -> None:
        while len(open_nodes) > depth:
            node = open_nodes.pop()
            node.end = at
            standing[node.tag].pop()
            if node.tag in _LISTS:
                items.pop()
            elif node.tag == "li":
                items[-1] -= 1

    for m in _tag_scanner(tags).finditer(html):
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if standing.get(tag):
                close(standing[tag][-1], m.start())
            continue
        if tag in _BLOCKS and standing.get("p"):
            close(standing["p"][-1], m.start())
        if (tag == "li" and items[-1]) or (tag == "a" and standing.get("a")):
            close(standing[tag][-1], m.start())
        node = Node(tag, m[3], open_nodes[-1] if open_nodes else None, m.end())
        if tag in tags:
            nodes.append(node)
        if tag not in _VOID:
            node.end = len(html)
            standing.setdefault(tag, []).append(len(open_nodes))
            open_nodes.append(node)
            if tag in _LISTS:
                items.append(0)
            elif tag == "li":
                items[-1] += 1
    return nodes


def matches(node: Node, selector: str) -> bool:
    """Whether the element and its ancestors satisfy a descendant selector."""
    steps = compile_selector(selector)
    return node.tag == steps[-1][0] and _fits(node, steps)


def _fits(node: Node, steps: tuple[tuple[str, frozenset[str]], ...]) -> bool:
    """The part of a match behind the tag name: classes, then ancestors inside out."""
    if not steps[-1][1] <= node.classes:
        return False
    above, left = node.parent, len(steps) - 2
    while left >= 0 and above is not None:
        tag, classes = steps[left]
        if above.tag == tag and classes <= above.classes:
            left -= 1
        above = above.parent
    return left < 0


def select(nodes: list[Node], selector: str) -> list[Node]:
    steps = compile_selector(selector)
    tag = steps[-1][0]
    return [n for n in nodes if n.tag == tag and _fits(n, steps)]


def first(nodes: list[Node], selector: str) -> Node | None:
    steps = compile_selector(selector)
    tag = steps[-1][0]
    for node in nodes:
        if node.tag == tag and _fits(node, steps):
            return node
    return None


def text_of(html: str, node: Node) -> str:
    """Text content: the element's span without tags, entities resolved."""
    return unescape(_ANY_TAG.sub("", html[node.start : node.end]))


def descendants(nodes: list[Node], at: int) -> list[Node]:
    """The elements inside the one at position *at*; they follow it directly."""
    end, stop = nodes[at].end, at + 1
    while stop < len(nodes) and nodes[stop].start < end:
        stop += 1
    return nodes[at + 1 : stop]
