"""From HTML to blocks: a forgiving tokenizer, the form of a page (a trie of its block elements) and the text of its blocks.

The form has one node for all sibling elements of the same signature (tag, and words of class, id and role), so records
of a list or paragraphs of a text are one node, and pages of one layout have one form whatever their length.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|([^<]++|<)", re.S)
#: A tag with an open quote ends at the next bracket.
_TORN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"([a-z0-9])([A-Z])")

# Elements of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav object ol
optgroup option p pre search section select summary svg table tbody td template textarea tfoot th thead title tr ul video
audio canvas script style noscript iframe""".split())
_CLOSES_P = BLOCK - frozenset("""body head html title script style noscript iframe template button option optgroup select
textarea td th tr tbody thead tfoot caption object svg video audio canvas legend summary""".split())
#: What a start tag ends, up to the nearest element of the second set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
_SCOPE = frozenset("article aside body button caption dialog fieldset footer form header html li main nav section table td th template".split())
#: Beyond this depth an element is no node of its own; its text belongs to the node above.
_DEPTH = 100


@dataclass
class Node:
    """A node of a form or a wrapper; ``pages`` counts the pages that have it."""

    sign: str
    pages: int = 1
    children: list["Node"] = field(default_factory=list)
    number: int = -1


@dataclass
class Page:
    """A page's form in preorder, and its blocks: their node, text and how many of the characters are links'."""

    signs: list[str]
    depths: list[int]
    nodes: list[int]
    texts: list[str]
    linked: list[int]


def _signature(tag: str, attributes: str) -> str:
    """Tag and the words of class, id and role; words with digits go, since ids are numbered."""
    words: set[str] = set()
    if attributes.strip():
        for name, double, single, bare in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), double or single or bare
            if name in ("class", "id", "role", "itemprop"):
                for token in value.split():
                    cut = _WORDS.findall(_CAMEL.sub(r"\1 \2", token).lower())
                    words.update(w for w in cut if not w[0].isdigit() and len(w) > 1)
            elif name in ("hidden", "aria-hidden") and value.lower() != "false":
                words.add("=hidden")
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                words.add("=hidden")
    return " ".join([tag, *sorted(words)])


def parse(source: str) -> Page:
    """The form and the blocks of a page; anything is a page, the empty string has one node and no blocks."""
    signs, depths, parents = ["#page"], [0], [-1]
    children: list[dict[str, int]] = [{}]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements and their nodes
    nodes: list[int] = []
    texts: list[str] = []
    linked: list[int] = []
    held: list[str] = []
    links = 0  # open <a>
    in_links = 0

    def flush() -> None:
        nonlocal in_links
        if held:
            text = " ".join("".join(held).split())
            if text:
                nodes.append(stack[-1][1])
                texts.append(text)
                linked.append(min(in_links, len(text)))
            held.clear()
        in_links = 0

    def close(at: int) -> None:
        flush()
        del stack[at:]

    def nearest(tags, stop) -> int:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in tags:
                return at
            if stack[at][0] in stop:
                return -1
        return -1

    def add(text: str) -> None:
        nonlocal in_links
        held.append(text)
        if links:
            in_links += len(text.strip())

    position, size = 0, len(source)
    while position < size:
        found = _TOKEN.match(source, position)
        position = found.end()
        cdata, slash, name, attributes, text = found.groups()
        torn = _TORN.match(source, position - 1) if text == "<" else None
        if torn:
            position, text = torn.end(), None
            slash, name, attributes = torn.groups()
        if text is not None:
            add(html.unescape(text) if "&" in text else text)
            continue
        if cdata is not None:
            add(cdata)
            continue
        if name is None:
            continue
        tag = name.lower()
        if slash:
            if tag in BLOCK:
                at = nearest({tag}, ())
                if at > 0:
                    close(at)
                    links = 0
                elif tag == "p":
                    flush()
            elif tag == "a":
                links = max(0, links - 1)
            elif tag == "br":
                held.append(" ")
            continue
        if tag in _CLOSES_P:
            at = nearest({"p"}, _SCOPE)
            if at > 0:
                close(at)
        if tag in _ENDS:
            ends, stop = _ENDS[tag]
            at = nearest(ends, stop)
            while at > 0:
                close(at)
                at = nearest(ends, stop)
        elif tag[0] == "h" and tag[1:].isdigit() and stack[-1][0][0] == "h" and stack[-1][0][1:].isdigit():
            close(len(stack) - 1)
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, position)
            position = source.find(">", end.end()) + 1 if end else size
            position = position or size
            held.append(" ")
            continue  # none of them holds text of the page
        if tag in BLOCK and tag not in VOID:
            flush()
            links = 0
            above = stack[-1][1]
            if depths[above] >= _DEPTH:
                node = above
            else:
                sign = _signature(tag, attributes)
                node = children[above].get(sign, -1)
                if node < 0:
                    node = children[above][sign] = len(signs)
                    signs.append(sign)
                    depths.append(depths[above] + 1)
                    parents.append(above)
                    children.append({})
            stack.append((tag, node))
        elif tag == "hr":
            flush()
        elif tag == "br":
            held.append(" ")
        elif tag == "a":
            links = 1
    flush()
    order = _preorder(children)
    place = {node: i for i, node in enumerate(order)}
    return Page([signs[i] for i in order], [depths[i] for i in order], [place[i] for i in nodes], texts, linked)


def _preorder(children: list[dict[str, int]]) -> list[int]:
    order, waiting = [], [0]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(reversed(children[node].values()))
    return order


def form_text(page: Page) -> str:
    return "\n".join(f"{d} {s}" for d, s in zip(page.depths, page.signs))


def form_tree(text: str, pages: int = 1) -> Node:
    """The tree behind ``form_text``; nodes are numbered in preorder."""
    path: list[Node] = []
    for number, line in enumerate(text.split("\n")):
        depth, sign = line.split(" ", 1)
        node = Node(sign, pages, [], number)
        del path[int(depth):]
        if path:
            path[-1].children.append(node)
        path.append(node)
    return path[0]
