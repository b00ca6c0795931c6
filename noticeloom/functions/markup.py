"""A small tolerant HTML tree on the standard library's parser, with the few selectors that notices need."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: An opening tag ends an open one of the same group: paragraphs, list items, rows and cells are often left open.
_ENDS = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "p": {"p"}}
_WITHIN = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "dd": {"dl"}, "dt": {"dl"}, "p": {"div", "td", "li", "body", "table", "dd"}}


class Node:
    __slots__ = ("attrs", "kids", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order; without recursion, so deep nesting is no matter."""
        stack = [iter(self.kids)]
        while stack:
            for k in stack[-1]:
                if isinstance(k, Node):
                    yield k
                    stack.append(iter(k.kids))
                    break
            else:
                stack.pop()

    def pieces(self, skip: frozenset[str] = frozenset()) -> Iterator[str]:
        stack = [iter(self.kids)]
        while stack:
            for k in stack[-1]:
                if isinstance(k, str):
                    yield k
                elif k.tag not in skip:
                    stack.append(iter(k.kids))
                    break
            else:
                stack.pop()

    def text(self, sep: str = "", stripped: bool = False, skip: frozenset[str] = frozenset()) -> str:
        parts = self.pieces(skip)
        return sep.join(p.strip() for p in parts if p.strip()) if stripped else sep.join(parts)

    def matches(self, simple: str) -> bool:
        """tag, .class, #id, tag.class"""
        if simple.startswith("#"):
            return self.attrs.get("id") == simple[1:]
        tag, _, cls = simple.partition(".")
        return (not tag or tag == self.tag) and (not cls or cls in (self.attrs.get("class") or "").split())

    def select(self, selector: str) -> Iterator[Node]:
        """``selector``: simple ones with blanks between them for "somewhere below"."""
        *above, last = selector.split()
        for node in self.walk():
            if node.matches(last):
                up, need = node.parent, list(above)
                while need and up is not None:
                    if up.matches(need[-1]):
                        need.pop()
                    up = up.parent
                if not need:
                    yield node

    def first(self, *selectors: str) -> Node | None:
        """The first match of the first selector that has one."""
        return next((n for s in selectors for n in self.select(s)), None)

    def drop(self, selectors: list[str]) -> None:
        for node in list(self.walk()):
            if any(node.matches(s) for s in selectors):
                node.parent.kids = [k for k in node.parent.kids if k is not node]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        up = self.at
        while up.parent is not None and tag in _ENDS and up.tag not in _WITHIN[tag]:
            if up.tag in _ENDS[tag]:
                self.at = up.parent
                if tag != "tr":
                    break
            up = up.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.kids.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        up = self.at
        while up.parent is not None and up.tag != tag:
            up = up.parent
        if up.parent is not None:
            self.at = up.parent

    def handle_data(self, data):
        self.at.kids.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root
