"""A tolerant DOM on the standard HTML parser: void elements, implied ends, raw text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

from larder.constants import WHITE_CODES

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ENDS = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCK = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "section", "table", "ul"}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


class Node:
    """An element; children are nodes and strings."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """This element and all below, in document order, without recursion."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def find(self, *tags: str, **attrs: str) -> list[Node]:
        """Descendants with one of the tags whose attributes contain the given values."""
        return [n for n in self.walk() if n is not self and (not tags or n.tag in tags) and all(v in n.attrs.get(k, "") for k, v in attrs.items())]

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                stack.extend(reversed(node.children))
        return "".join(out)

    def following(self) -> list[Node]:
        """Sibling elements after this one."""
        own = [c for c in self.parent.children if isinstance(c, Node)] if self.parent else []
        return own[own.index(self) + 1 :] if self in own else []


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ends = ENDS.get(tag, set()) | ({"p"} if tag in BLOCK else set())
        if self.at.tag in ends:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


#: Elements whose end is a line's end.
_LINES = {"p", "div", "li", "tr", "section", "article", *HEADINGS}


def text_with_breaks(root: Node) -> str:
    """Text of the body with line feeds at line breaks and after blocks."""
    out: list[str] = []
    stack: list[Node | str] = [next(iter(root.find("body")), root)]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node.replace("\xa0", " "))
        elif node.tag == "br":
            out.append("\n")
        else:
            if node.tag in _LINES:
                stack.append("\n")
            stack.extend(reversed(node.children))
    return "".join(out)


_WHITE = re.compile("[" + "".join(re.escape(chr(c)) for c in WHITE_CODES) + "]+")


_CONTROL = re.compile("[\x1c-\x1f]")


def clean(text: str | None) -> str:
    """White space collapsed, none at the ends. ASCII text goes by words: there, only the separators differ in what is white."""
    text = text or ""
    if text.isascii() and not _CONTROL.search(text):
        return " ".join(text.split())
    return _WHITE.sub(" ", text).strip(" ")


def distinct(values) -> list[str]:
    """Cleaned, without empty ones, first occurrences in order."""
    return list(dict.fromkeys(x for x in map(clean, values) if x))
