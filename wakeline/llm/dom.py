"""A small tolerant HTML reader: elements with parents, and the texts between them in page order."""

from __future__ import annotations

import re

# Fixed lists of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes iframe noembed".split())
UNSEEN = frozenset("head script style template noscript title textarea iframe object svg math xmp noframes noembed select canvas audio video".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "caption legend option optgroup button br head".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr li main menu nav ol p pre section summary table ul dd dt".split()
)
#: An element that opens closes these if they are open, down to the nearest element of the second set.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "body": ({"head"}, {"html"}),
}
SCOPES = frozenset("html body table td th button object article section div main aside header footer nav form li blockquote".split())

_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)


class Node:
    """An element: its name, the text of telling attributes, its parent's number, its depth."""

    __slots__ = ("name", "attributes", "parent", "depth", "children")

    def __init__(self, name: str, attributes: str, parent: int, depth: int):
        self.name, self.attributes, self.parent, self.depth = name, attributes, parent, depth
        self.children: list[int] = []


def tag_end(html: str, at: int, fails: set[int]) -> int:
    """Place of the ``>`` outside of quotes that ends a tag, -1 if there is none.

    ``fails`` keeps the quotes, seen from outside of quotes, behind which no tag ends: what has been read in vain once is
    not read again, so a page with quotes left open is read in linear time.
    """
    passed = []
    while m := _STOP.search(html, at):
        k = m.start()
        if html[k] == ">":
            return k
        if k in fails:
            break
        passed.append(k)
        at = html.find(html[k], k + 1) + 1
        if not at:
            break
    fails.update(passed)
    return -1


def read(html: str) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """(elements, pieces): element 0 is the page itself. A piece is (element, text), or (element, None) for a break.

    Comments, declarations, what is inside script-like elements and a tag cut off at the end are left out. Elements are
    closed as a browser would in the usual cases: paragraphs by blocks, list items and cells by their like, what is
    open inside an element by that element's end. An inline element's end never closes a block.
    """
    nodes = [Node("page", "", -1, 0)]
    pieces: list[tuple[int, str | None]] = []
    stack = [0]
    at, n = 0, len(html)
    fails: set[int] = set()

    def close(names, scope) -> None:
        for k in range(len(stack) - 1, 0, -1):
            name = nodes[stack[k]].name
            if name in names:
                for i in reversed(stack[k:]):
                    if nodes[i].name in BLOCK:
                        pieces.append((i, None))
                del stack[k:]
                return
            if name in scope:
                return

    while at < n:
        begin = html.find("<", at)
        if begin < 0:
            pieces.append((stack[-1], html[at:]))
            break
        if begin > at:
            pieces.append((stack[-1], html[at:begin]))
        after = html[begin + 1 : begin + 2]
        if after == "!" or after == "?":
            if html.startswith("<!--", begin):
                end = html.find("-->", begin + 4)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", begin)
                at = n if end < 0 else end + 1
            continue
        if not (after.isascii() and after.isalpha()) and after != "/":
            pieces.append((stack[-1], "<"))
            at = begin + 1
            continue
        m = _NAME.match(html, begin)
        end = tag_end(html, m.end(), fails) if m else -1
        if end >= 0:
            slash, name, rest = m[1], m[2].lower(), html[m.end() : end]
            at = end + 1
        elif m := _LOOSE.match(html, begin):
            slash, name, rest = m[1], m[2].lower(), m[3]
            at = m.end()
        else:
            if after == "/":
                end = html.find(">", begin)
                at = n if end < 0 else end + 1
            else:
                at = n  # a tag that never ends
            continue
        if slash:
            if name in BLOCK or name not in VOID:
                inner = name not in BLOCK
                for k in range(len(stack) - 1, 0, -1):
                    if nodes[stack[k]].name == name:
                        for i in reversed(stack[k:]):
                            if nodes[i].name in BLOCK:
                                pieces.append((i, None))
                        del stack[k:]
                        break
                    if inner and nodes[stack[k]].name in BLOCK:
                        break
            continue
        if name in CLOSES_P:
            close({"p"}, SCOPES)
        if name in SIBLINGS:
            close(*SIBLINGS[name])
        if name == "br" or name == "hr":
            pieces.append((stack[-1], None))
            continue
        if name in VOID:
            continue
        told = " ".join(f"{a[0]} {a[1] or a[2] or a[3]}" for a in _ATTRIBUTE.findall(rest)) if rest else ""
        number = len(nodes)
        nodes.append(Node(name, told.lower(), stack[-1], len(stack)))
        nodes[stack[-1]].children.append(number)
        if name in BLOCK:
            pieces.append((number, None))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)", re.I).search(html, at)
            if end:
                stop = html.find(">", end.end())
                at = n if stop < 0 else stop + 1
            else:
                at = n
            continue
        if not rest.endswith("/") or name in BLOCK:
            stack.append(number)
    return nodes, pieces
