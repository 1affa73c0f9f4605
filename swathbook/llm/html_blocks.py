"""Leaf blocks of an HTML page: runs of inline text between block boundaries, with the elements around them."""

from __future__ import annotations

import html as _html
import re
from dataclasses import dataclass

# Element names of the HTML standard.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup, up to their own end tag, and no text of the page.
RAW_TAGS = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
#: Their content is markup, but no text of the page.
SILENT_TAGS = frozenset("audio button canvas datalist map math object select svg template video".split())
#: An open element of the first kind ends where one of the second starts, unless one of the third lies between.
IMPLIED_ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir td th table".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset("dl td th table".split())),
    "dd": (frozenset(["dt", "dd"]), frozenset("dl td th table".split())),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset("thead tbody tfoot caption".split()), frozenset(["table"])),
    "thead": (frozenset("thead tbody tfoot caption".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot caption".split()), frozenset(["table"])),
}
#: End tags do not reach beyond these.
CELLS = frozenset("td th caption table".split())

#: Comments, tags (an attribute value may hold ">"), and other declarations; each to the end of the page if left open.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|[\s\"'/])(?P<key>class|id|role|hidden|aria-hidden|style|data-main|data-other)(?:\s*=\s*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[^\s>]+)))?(?=[\s/]|$)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An open element: its features are those of its ancestors and its own tag, class, id and role words."""

    __slots__ = ("tag", "parent", "block", "features", "names", "link", "silent", "main", "p_open", "score")

    def __init__(self, tag: str, outer: Node | None):
        self.tag, self.score = tag, None
        self.block = self if tag in BLOCK_TAGS or outer is None else outer.block
        self.parent = (outer.block if outer else None) if self.block is self else self.block.parent
        self.features = outer.features if outer else frozenset()
        self.names = ()
        self.link = tag == "a" or (outer is not None and outer.link)
        self.silent = tag in SILENT_TAGS or (outer is not None and outer.silent)
        self.main = outer is not None and outer.main
        self.p_open = tag == "p" or (outer is not None and outer.p_open and tag not in CELLS)


@dataclass
class Block:
    text: str
    node: Node
    links: float  # share of its characters in links


def _name_words(attributes: str) -> tuple[list[str], bool | None]:
    """Features of class, id, role and hiding attributes, and whether the element is marked as main text or as other."""
    words, main = [], None
    for found in _NAMES.finditer(attributes):
        key, value = found["key"].lower(), found["a"] or found["b"] or found["c"] or ""
        if key in ("data-main", "data-other"):
            main = key == "data-main"
        elif key in ("class", "id", "role"):
            words += ["n:" + w.lower() for w in _WORD.findall(value)]
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)):
            words.append("hidden")
    return words, main


def parse(page: str | None, known: frozenset[str] | None = None) -> tuple[list[Block], str]:
    """Blocks of a page in order, without those that hold no text, and the text of its title.

    Only features in ``known`` are kept (None: all). Time and memory grow with the length of the page, however deep
    its elements nest.
    """
    page = page or ""
    root = Node("", None)
    stack, open_tags = [root], {}
    blocks: list[Block] = []
    pieces: list[str] = []
    size = linked = 0
    title, leaf = "", root

    def flush() -> None:
        nonlocal size, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append(Block(text, leaf, linked / size))
            pieces.clear()
            size = linked = 0

    def pop_to(i: int) -> None:
        for node in stack[i:]:
            open_tags[node.tag] -= 1
        del stack[i:]

    def text_piece(raw: str) -> None:
        nonlocal size, linked, leaf
        top = stack[-1]
        if raw and not top.silent:
            text = _html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            leaf = top.block
            size += len(text)
            linked += len(text) if top.link else 0

    at = 0
    while True:
        token = _TOKEN.search(page, at)
        text_piece(page[at : token.start()] if token else page[at:])
        if token is None:
            break
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            if name in BLOCK_TAGS:
                flush()
            if not open_tags.get(name):
                continue
            inline = name not in BLOCK_TAGS
            for i in range(len(stack) - 1, 0, -1):
                tag = stack[i].tag
                if tag == name:
                    pop_to(i)
                    break
                if (inline and tag in BLOCK_TAGS) or (tag in CELLS and name not in CELLS and name not in ("tr", "tbody", "thead", "tfoot")):
                    break
            continue
        if name in RAW_TAGS:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if name == "title" and not title:
                title = " ".join(_html.unescape(page[at : close.start() if close else len(page)]).split())
            at = close.end() if close else len(page)
            continue
        if name in BLOCK_TAGS:
            flush()
            if stack[-1].p_open:
                i = len(stack) - 1
                while stack[i].tag != "p":
                    i -= 1
                pop_to(i)
            ends, stops = IMPLIED_ENDS.get(name, (frozenset(), frozenset()))
            if any(open_tags.get(t) for t in ends):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in ends:
                        pop_to(i)
                        break
                    if stack[i].tag in stops:
                        break
        elif name == "br":
            text_piece(" ")
        if name in VOID_TAGS:
            continue
        node = Node(name, stack[-1])
        attributes = token["attributes"]
        if node.block is node or name in SILENT_TAGS:
            words, main = _name_words(attributes) if attributes.strip(" /\n\t") else ([], None)
            node.main = node.main if main is None else main
            words.append("t:" + name)
            words = [w for w in words if known is None or w in known]
            node.names = tuple(words)
            if not node.features.issuperset(words):
                node.features = node.features.union(words)
        stack.append(node)
        open_tags[name] = open_tags.get(name, 0) + 1
    flush()
    return blocks, title
