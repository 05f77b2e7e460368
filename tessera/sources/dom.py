"""A small document tree over the standard library's HTML parser."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: An opening tag ends an open element of these kinds.
ENDS = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
#: ... but not beyond these.
BARRIERS = {"ul", "ol", "table", "div", "section", "article", "main", "body", "dl", "select"}


@dataclass(eq=False)
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)
    parent: Node | None = None

    def walk(self) -> Iterator[Node]:
        """This node and all below it, in document order."""
        stack: list[Node] = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item.tag not in ("script", "style") or item is self:
                stack += reversed(item.children)

    def text(self) -> str:
        """All strings, each stripped, one after the other."""
        return "".join(s.strip() for s in self.strings())

    def find_all(self, test: Callable[[Node], bool]) -> list[Node]:
        return [n for n in self.walk() if n is not self and test(n)]

    def find(self, test: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.walk() if n is not self and test(n)), None)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def html(self) -> str:
        if self.tag == "#root":
            return "".join(c.html() if isinstance(c, Node) else escape(c, quote=False) for c in self.children)
        attrs = "".join(f' {k}="{escape(v)}"' for k, v in self.attrs.items())
        if self.tag in VOID:
            return f"<{self.tag}{attrs}>"
        raw = self.tag in ("script", "style")
        inner = "".join(c.html() if isinstance(c, Node) else (c if raw else escape(c, quote=False)) for c in self.children)
        return f"<{self.tag}{attrs}>{inner}</{self.tag}>"

    def following(self) -> list[Node | str]:
        """The siblings after this node."""
        if self.parent is None:
            return []
        at = next(k for k, c in enumerate(self.parent.children) if c is self)
        return self.parent.children[at + 1 :]


def tagged(*names: str) -> Callable[[Node], bool]:
    return lambda n: n.tag in names


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ENDS:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in ENDS[tag]:
                    del self.open[k:]
                    break
                if self.open[k].tag in BARRIERS:
                    break
        node = Node(tag, {k: v or "" for k, v in attrs}, [], self.open[-1])
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root
