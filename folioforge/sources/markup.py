"""HTML and XML by the standard library: text, ids, chapters, rewriting."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser

# Elements without content, elements whose content is no text, and those that hold a text's lines.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template"}
LINES = ("p", "h1", "h2", "h3", "h4", "h5", "h6")


@dataclass
class Node:
    """An element with its children, or (tag None) a piece of text; raw markup, such as a comment, has tag ''."""

    tag: str | None
    attrs: dict = field(default_factory=dict)
    text: str = ""
    children: list = field(default_factory=list)

    def walk(self):
        yield self
        for c in self.children:
            yield from c.walk()

    def get_text(self) -> str:
        if self.tag is None:
            return self.text
        return "" if self.tag == "" or self.tag in HIDDEN else "".join(c.get_text() for c in self.children)

    def find_all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def find(self, *tags: str) -> Node | None:
        return next((n for n in self.walk() if n.tag in tags), None)

    def to_html(self) -> str:
        if self.tag is None:
            return escape(self.text, quote=False)
        if self.tag == "":
            return self.text
        inner = "".join(c.text if self.tag in HIDDEN and c.tag is None else c.to_html() for c in self.children)
        if self.tag == "#root":
            return inner
        attrs = "".join(f" {k}" if v is None else f' {k}="{escape(v)}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}/>" if self.tag in VOID else f"<{self.tag}{attrs}>{inner}</{self.tag}>"


class _Builder(HTMLParser):
    """Unclosed elements end with what holds them; a p ends where the next begins."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in LINES and self.open[-1].tag == "p":
            self.open.pop()
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(Node(None, text=data))

    def handle_comment(self, data):
        self.open[-1].children.append(Node("", text=f"<!--{data}-->"))

    def handle_decl(self, decl):
        self.open[-1].children.append(Node("", text=f"<!{decl}>"))

    def handle_pi(self, data):
        self.open[-1].children.append(Node("", text=f"<?{data}>"))


def parse_html(markup: str) -> Node:
    b = _Builder()
    b.feed(markup)
    b.close()
    return b.root


def body_of(doc: Node) -> Node:
    return doc.find("body") or doc


def html_text(markup: str | None) -> str | None:
    """The text of the body, without scripts, styles and comments."""
    return None if markup is None else body_of(parse_html(markup)).get_text()


def collapse(text: str) -> str:
    """Outer white space stripped, runs of newlines made one."""
    return re.sub("\n+", "\n", text.strip())


def title_id(node: Node) -> str | None:
    """The first id found from the element down, the last children first."""
    if node.tag in (None, ""):
        return None
    if node.attrs.get("id"):
        return node.attrs["id"]
    return next((found for c in reversed(node.children) if (found := title_id(c))), None)


def main_element(body: Node) -> Node:
    """The div with most p elements, the last of equals; the body if it has none."""
    divs = body.find_all("div")
    return max(enumerate(divs), key=lambda d: (len(d[1].find_all("p")), d[0]))[1] if divs else body


def split_by_ids(body: Node, ids: list[str]) -> tuple[str, list[tuple[str, str]]]:
    """(text before the first of the ids, [(id, text up to the next)]) in document order."""
    wanted, parts = set(ids), [("", [])]

    def walk(n: Node) -> None:
        if n.tag is None:
            parts[-1][1].append(n.text)
            return
        if n.tag in HIDDEN or n.tag == "":
            return
        if n.attrs.get("id") in wanted:
            parts.append((n.attrs["id"], ["\n"]))
        for c in n.children:
            walk(c)

    walk(body)
    return "".join(parts[0][1]), [(i, "".join(t)) for i, t in parts[1:]]


def text_elements(doc: Node) -> list[tuple[int, int, Node]]:
    """(rank of the tag, place among its like, element) of p and h1 to h6, by rank."""
    return [(rank, i, n) for rank, tag in enumerate(LINES) for i, n in enumerate(doc.find_all(tag))]


def rewrite_element(node: Node, text: str) -> None:
    """The element's content becomes the text, within its first link if it has one."""
    link = node.find("a")
    if link is not None:
        link.children = [Node(None, text=text)]
        node.children = [link]
    else:
        node.children = [Node(None, text=text)]


def replace_lines(docs: list[Node], pairs: list[tuple[str, str]], most_difference: int | None = None) -> list[str]:
    """Puts each translation into the first element whose current text holds the source line.

    Elements come in order of document and tag; what was replaced is searched in
    its new form. With most_difference the lengths may differ by so much only.
    Returns the lines that were found nowhere.
    """
    elements = [n for d in docs for _, _, n in text_elements(d)]
    texts = [n.get_text().replace("　", " ") for n in elements]
    missed = []
    for source, target in pairs:
        source = source.replace("　", " ")
        at = next((i for i, t in enumerate(texts) if source in t and (most_difference is None or abs(len(source) - len(t)) <= most_difference)), None)
        if at is None:
            missed.append(source)
            continue
        texts[at] = texts[at].replace(source, target)
        rewrite_element(elements[at], texts[at])
    return missed
