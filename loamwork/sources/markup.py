"""A small tree of a page and the selectors that recipes use: tags, ids, classes, attributes and descendants."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children if isinstance(c, str) or c.tag not in ("script", "style"))

    def markup(self) -> str:
        inner = "".join(c if isinstance(c, str) else c.markup() for c in self.children)
        return inner if self.tag == "" else f"<{self.tag}>{inner}</{self.tag}>"

    def descendants(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.descendants()

    def select(self, selector: str) -> list[Node]:
        """Nodes below this one that match a selector, in document order; a comma joins alternatives."""
        wanted: set[int] = set()
        for one in selector.split(","):
            level = [self]
            for step in one.replace(">", " ").split():
                seen: dict[int, Node] = {}
                for node in level:
                    seen |= {id(n): n for n in node.descendants() if _matches(n, step)}
                level = list(seen.values())
            wanted |= {id(n) for n in level}
        return [n for n in self.descendants() if id(n) in wanted]


def _matches(node: Node, step: str) -> bool:
    tag = re.match(r"[a-zA-Z0-9]*", step).group(0).lower()
    classes = node.attrs.get("class", "").split()
    return (
        (not tag or node.tag == tag)
        and all(c in classes for c in re.findall(r"\.([\w-]+)", step))
        and all(node.attrs.get("id") == i for i in re.findall(r"#([\w-]+)", step))
        and all(k in node.attrs and (not v or node.attrs[k] == v.strip("'\"")) for k, v in re.findall(r"\[([\w-]+)(?:=([^\]]+))?\]", step))
    )


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack = [Node("")]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].children.append(node)
        if tag not in _VOID:
            self.stack.append(node)

    def handle_endtag(self, tag: str) -> None:
        if any(n.tag == tag for n in self.stack[1:]):
            while self.stack.pop().tag != tag:
                pass

    def handle_data(self, data: str) -> None:
        self.stack[-1].children.append(data)


def parse(page: str) -> Node:
    builder = _Builder()
    builder.feed(page or "")
    builder.close()
    return builder.stack[0]
