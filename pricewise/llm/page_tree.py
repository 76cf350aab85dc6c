"""A page's DOM as a tree of block elements and text blocks.

A tolerant reader of real-world HTML: missing end tags, stray end tags, raw text
in scripts, comments, references. Inline elements dissolve into the text block
around them, so a tree's leaves are the page's text blocks in page order and its
inner nodes the block elements around them. Reading is linear in the page.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Fixed values of the HTML standard: element groups.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
HEAD = frozenset("base link meta noscript script style template title".split())
TABLE = frozenset("table caption tbody thead tfoot tr td th".split())
CLOSES_P = frozenset("""address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary ul table""".split())
BLOCK = CLOSES_P | TABLE | {"html", "body", "legend"}
SCOPE = frozenset("table td th caption html template object".split())
# start tag -> (elements it ends, elements beyond which it does not look)
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"} | TABLE),
    "dt": ({"dt", "dd"}, {"dl"} | TABLE), "dd": ({"dt", "dd"}, {"dl"} | TABLE),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}), "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
}
# Elements whose text is never shown as page text.
UNSEEN = frozenset("head noscript template svg math canvas audio video object select button datalist dialog".split())

_TOKEN = re.compile(r"""
    <!--(?:-?>|.*?(?:--!?>|\Z))
  | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=|["'])*+)(?:>|\Z)
  | <[!?/][^>]*+(?:>|\Z)""", re.S | re.X)
_ATTR = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_NAMED = ("class", "id", "role", "aria-label", "itemprop", "hidden", "style")


@dataclass
class Tree:
    """Nodes in page order: parent (-1 for the first), depth, tag ('' for a text block),
    attributes that name an element's purpose, text and its characters inside links."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, names: str = "", text: str = "", linked: int = 0) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


class _Reader:
    def __init__(self) -> None:
        self.tree = Tree()
        self.tree.add(-1, "html")
        self.stack: list[list] = []  # [tag, node, block, unseen]
        self.open: dict[str, int] = {}
        self.unseen = self.links = 0
        self.pieces: list[str] = []
        self.linked = 0

    def node(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.tree.add(self.node(), "", text=text, linked=min(self.linked, len(text)))
            self.pieces, self.linked = [], 0

    def chars(self, raw: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and not raw.isspace():
            self.pop(len(self.stack) - 1)
        if not self.unseen:
            text = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(text)
            if self.links:
                self.linked += len(text.strip())

    def forget(self, entry: list) -> None:
        self.open[entry[0]] -= 1
        self.unseen -= entry[3]
        self.links -= entry[0] == "a"

    def pop(self, at: int) -> None:
        """Close every element from place ``at`` of the stack on."""
        if any(e[2] for e in self.stack[at:]):
            self.flush()
        for e in self.stack[at:]:
            self.forget(e)
        del self.stack[at:]

    def close(self, targets, stops) -> None:
        """Close the innermost of ``targets`` unless one of ``stops`` lies inside of it."""
        if any(self.open.get(t) for t in targets):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in targets:
                    return self.pop(i)
                if self.stack[i][0] in stops:
                    return None
        return None

    def start(self, tag: str, attrs: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and tag not in HEAD:
            self.pop(len(self.stack) - 1)
        if tag == "br":
            return self.pieces.append(" ") if not self.unseen else None
        block = tag in BLOCK or "-" in tag
        if tag in CLOSES_P:
            self.close({"p"}, SCOPE | {"button"})
        if tag in ENDS:
            self.close(*ENDS[tag])
        if block:
            self.flush()
        if tag in ("html", "body") and self.open.get(tag) or tag in VOID:
            return None
        named = {}
        if attrs.strip(" \t\n\f\r/"):
            for m in _ATTR.finditer(attrs):
                name = m[1].lower()
                if name in _NAMED:
                    named.setdefault(name, m[2] or m[3] or m[4] or "")
        hidden = "hidden" in named or "display:none" in named.get("style", "").replace(" ", "").lower()
        unseen = tag in UNSEEN or hidden
        node = self.node()
        if block:
            names = " ".join(html.unescape(named[n]) for n in _NAMED[:5] if n in named)
            node = self.tree.add(node, tag, names)
        self.stack.append([tag, node, block, unseen])
        self.open[tag] = self.open.get(tag, 0) + 1
        self.unseen += unseen
        self.links += tag == "a"
        return None

    def end(self, tag: str) -> None:
        if tag in ("br", "p") and not self.open.get(tag):
            return self.pieces.append(" ") if tag == "br" else self.flush()
        if not self.open.get(tag):
            return None
        if tag in BLOCK or "-" in tag:
            return self.close({tag}, SCOPE - {tag} if tag not in TABLE else {"table"} - {tag})
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if any(e[2] for e in self.stack[i:]):  # an inline element around blocks ends alone
                    self.forget(self.stack.pop(i))
                else:
                    self.pop(i)
                return None
            if self.stack[i][0] in SCOPE:
                return None
        return None


def read_page(page: str | None) -> Tree:
    """The tree of a page; null and empty pages have the root alone."""
    r, at, page = _Reader(), 0, page or ""
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            r.chars(page[at:])
            break
        if m.start() > at:
            r.chars(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            r.end(tag)
        elif tag in RAW:
            stop = _RAW_END[tag].search(page, at)
            if stop is None:
                break
            at = page.find(">", stop.end()) + 1 or len(page)
        else:
            r.start(tag, m["attrs"])
    r.flush()
    return r.tree
