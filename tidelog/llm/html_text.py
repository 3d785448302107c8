"""Main text of a web page by minimum-cut labelling.

A page is read into text blocks.  A classifier gives every block the cost of calling
it content and of calling it boilerplate, from the elements and class names around
it and from its words; these become capacities to the two terminals of a graph.
Neighbouring blocks, and blocks close in the element tree, are tied by smoothness
edges.  The minimum cut, found by maximum flow, labels all blocks of the page at the
least total cost; the blocks on the source side, in page order, are the text.

Inside a block white space becomes one space and character references are decoded.
Scripts, styles, comments and markup are never text.  Null, empty and unmarked
html, unclosed or cut-off markup have defined results: what is there is read, an
element left open ends where its parent ends.  Equal pages give equal texts.
"""

from __future__ import annotations

import html as references
import re
from collections import deque

from pyspark.sql import DataFrame

from tidelog.llm.common import per_text

#: Elements whose text is part of the block around them; all others begin and end blocks.
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr "
    # formulas are read as words of the sentence around them
    "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts none mtable mtr mtd mlabeledtr maction".split()
)
#: A formula once more in another notation, not shown; its text is left out and the block goes on after it.
_NOTATION_END = {name: re.compile(rf"</{name}\s*>|(?=</math[\s>])", re.I) for name in ("annotation", "annotation-xml")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup or never shown.
HIDDEN = frozenset("script style noscript template iframe object svg canvas head textarea select option title audio video".split())
#: Elements whose content is characters up to their own closing tag, whatever these look like.
_RAW = frozenset("script style textarea title noscript iframe".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
#: Elements that end an open one of these names.
_CLOSES = {
    "li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = frozenset("ul ol dl table div section article nav aside footer header main body form".split())

CONTENT_ELEMENTS = {"article": 4.0, "main": 3.0}
BOILERPLATE_ELEMENTS = {
    "nav": 6.0, "footer": 6.0, "header": 4.0, "aside": 6.0, "form": 6.0, "button": 6.0, "menu": 6.0, "dialog": 6.0, "fieldset": 5.0,
    "address": 2.0,
}
#: Names of page furniture that no part of a text is named after.
_FURNITURE = (
    r"nav|navbar|breadcrumbs?|masthead|side-?bar|ads?|advert\w*|adv|promo\w*|sponsor\w*|cookies?|popup|modal|newsletter|disqus|comments|toolbar|"
    r"pagination|pager|widgets?|gdpr"
)
_BAD = (
    rf"(?:{_FURNITURE}|navigation|menus?|footer|header|banner|aside|consent|notices?|notification|overlay|subscribe|signup|login|search|share|"
    r"sharing|social|comment|replies|reply|respond|related|recommended|skip|alert|legal|copyright)"
)
#: What furniture names are made of besides: 'related-posts', 'share-buttons'.
_PLACE = (
    r"(?:site|page|top|bottom|left|right|inner|outer|area|box|bar|block|container|wrapper|wrap|list|links?|items?|buttons?|section|panel|form|icons?|"
    r"posts|articles|stories|this|primary|secondary|global|\d+)"
)
_BAD_PART = re.compile(rf"(?:^|[_-]){_BAD}(?:$|[_-])")
_BAD_WHOLE = re.compile(rf"(?:{_PLACE}[_-]+)*{_BAD}(?:[_-]+(?:{_BAD}|{_PLACE}))*")
_BAD_ALONE = re.compile(_BAD)
_CLEAR = re.compile(_FURNITURE)
_GOOD_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body|text)(?:$|[\s_-])")
_BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")

NEIGHBOURS, SIBLINGS = 0.6, 1.2
#: Evidence of a doubtful name: for the whole name, for a part of it.  It fades with the words of a block up to LONG.
WHOLE, PART, LONG = -4.0, -2.0, 24


class Element:
    __slots__ = ("name", "parent", "cue", "doubt", "depth", "hidden")

    def __init__(self, name: str, parent: Element | None, cue: float, doubt: float, hidden: bool):
        self.name, self.parent, self.cue, self.doubt, self.hidden = name, parent, cue, doubt, hidden
        self.depth = parent.depth + 1 if parent else 0


class Block:
    __slots__ = ("parts", "element", "linked")

    def __init__(self, element: Element):
        self.parts: list[str] = []
        self.element = element
        self.linked = 0


def named(name: str, attributes: dict[str, str], content: bool) -> float:
    """Evidence of class names and id for boilerplate: -6 if clear, WHOLE or PART if doubtful, 0 for none.

    Around the content a class with one bad part, or a bad id, is clear.  Within it ids
    are made from titles ('related-work', 'search'): there a part of an id says nothing,
    a whole id little, and only classes that are page furniture as a whole are clear.
    """
    if name in ("html", "body", "article", "main"):
        return 0.0
    found = 0.0
    for token in attributes.get("class", "").lower().split():
        if _BAD_PART.search(token):
            if not content or _CLEAR.fullmatch(token) or _BAD_WHOLE.fullmatch(token) and not _BAD_ALONE.fullmatch(token):
                return -6.0
            found = min(found, WHOLE if _BAD_ALONE.fullmatch(token) else PART)
    own = attributes.get("id", "").strip().lower()
    # a heading's id is its title
    if own and name not in ("h1", "h2", "h3", "h4", "h5", "h6") and _BAD_PART.search(own):
        whole = _BAD_WHOLE.fullmatch(own)
        if whole and not content:
            return -6.0
        if whole or not content:
            found = min(found, WHOLE if whole else PART)
    return found


def cue_of(name: str, attributes: dict[str, str], parent: float) -> tuple[float, float]:
    """Evidence that text in the element is content (positive) or boilerplate, the nearest clear element decides; and doubtful evidence."""
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return -8.0, 0.0
    if attributes.get("role", "").lower() in _BAD_ROLES:
        return -6.0, 0.0
    if name in BOILERPLATE_ELEMENTS and not (name == "header" and parent > 0):
        return -BOILERPLATE_ELEMENTS[name], 0.0
    doubt = named(name, attributes, parent > 0) if names != " " else 0.0
    if doubt == -6.0:
        return -6.0, 0.0
    # what lies inside boilerplate stays boilerplate: comments hold articles of their own
    if parent < 0:
        return parent, 0.0
    if name in CONTENT_ELEMENTS:
        return max(parent, CONTENT_ELEMENTS[name]), doubt
    if attributes.get("role", "").lower() in ("main", "article") or names != " " and _GOOD_NAMES.search(names):
        return max(parent, 2.5), doubt
    return parent, doubt


def blocks_of(page: str) -> list[tuple[str, Element, float]]:
    """Text, element and share of linked characters of every block, in page order."""
    root = Element("", None, 0.0, 0.0, False)
    at, links, block = root, 0, Block(root)
    out: list[tuple[str, Element, float]] = []

    def flush() -> None:
        nonlocal block
        text = " ".join(references.unescape("".join(block.parts)).split())
        if text:
            out.append((text, block.element, min(1.0, block.linked / len(text))))
        block = Block(at)

    place = 0
    while (token := _TOKEN.match(page, place)) is not None:
        place = token.end()
        closing, name, rest = token.group(1), token.group(2), token.group(3)
        if name is None:
            if at.hidden:
                continue
            text = token.group()
            if text[0] != "<" or text == "<":
                block.parts.append(text)
                block.linked += len(text) if links else 0
            continue
        name = name.lower()
        if name in _NOTATION_END:
            end = None if closing or rest.endswith("/") else _NOTATION_END[name].search(page, place)
            place = end.end() if end else place
            continue
        if name in INLINE:
            if name == "a":
                links = max(0, links + (-1 if closing else 1))
            elif name == "br":
                block.parts.append(" ")
            continue
        if closing:
            node = at
            while node is not None and node.name != name:
                if node.name in _SCOPE and name not in _SCOPE:
                    node = None
                    break
                node = node.parent
            if node is not None and node.parent is not None:
                at = node.parent
            links = 0
            flush()
            continue
        closes = _CLOSES.get(name, {"p"} if name not in VOID else set())
        node = at
        while node.name in closes:
            node = node.parent
        at = node
        links = 0
        if name not in VOID:
            attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(rest)} if "=" in rest else {}
            if rest and re.search(r"(?:^|\s)hidden(?:\s|$)", rest):
                attributes["hidden"] = ""
            cue, doubt = cue_of(name, attributes, at.cue)
            at = Element(name, at, cue, 0.0 if cue < 0 else min(doubt, at.doubt), at.hidden or name in HIDDEN)
        flush()
        if name in _RAW:
            end = _RAW_END[name].search(page, place)
            place = end.start() if end else len(page)
        elif rest.endswith("/") and name not in VOID:
            at = at.parent
    flush()
    return out


def costs(text: str, element: Element, linked: float) -> tuple[float, float]:
    """Cost of calling the block boilerplate, and of calling it content."""
    n = text.count(" ") + 1
    score = element.cue
    if element.doubt:
        score -= (score - element.doubt) * max(0.0, 1 - n / LONG)
    # long running text speaks for content, linked text against it
    score += 0.25 + min(1.5, n / 20) - 3.0 * linked
    if element.name in ("h1", "h2", "h3", "p", "blockquote", "pre"):
        score += 0.75
    if n < 12 and (text[0] == "©" or text.lower().startswith("copyright")):
        score -= 3.0
    return (score, 0.0) if score > 0 else (0.0, -score)


def labels(blocks: list[tuple[str, Element, float]]) -> list[bool]:
    """True for content: the source side of the minimum cut."""
    n = len(blocks)
    terminals = [costs(*b) for b in blocks]
    edges: dict[tuple[int, int], float] = {}
    for i in range(n - 1):
        a, b = blocks[i][1], blocks[i + 1][1]
        apart = a.depth + b.depth - 2 * _common(a, b)
        edges[i, i + 1] = NEIGHBOURS / (1 + apart)
    last: dict[int, int] = {}
    for i, (_, element, _) in enumerate(blocks):
        parent = id(element.parent if element.parent is not None else element)
        if parent in last:
            edges[last[parent], i] = edges.get((last[parent], i), 0.0) + SIBLINGS
        last[parent] = i
    return source_side(terminals, edges)


def _common(a: Element, b: Element) -> int:
    """Depth of the nearest element around both."""
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a.depth


def source_side(terminals: list[tuple[float, float]], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Nodes on the source side of a minimum cut.

    ``terminals``: capacity from the source and to the sink of every node;
    ``edges``: capacity both ways.  Shortest augmenting paths: flow straight
    through a node first, then level by level from nodes with supply left to
    nodes with demand left.
    """
    n = len(terminals)
    supply, demand = [0.0] * n, [0.0] * n
    for i, (a, b) in enumerate(terminals):
        supply[i], demand[i] = max(a - b, 0.0), max(b - a, 0.0)
    near: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[float] = []
    for (i, j), capacity in edges.items():
        near[i].append(len(to))
        near[j].append(len(to) + 1)
        to += (j, i)
        room += (capacity, capacity)
    tiny = 1e-12
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i] > tiny)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            reached = reached or demand[i] > tiny
            for e in near[i]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        nexts = [0] * n
        for source in range(n):
            while supply[source] > tiny:
                path: list[int] = []
                at = source
                while demand[at] <= tiny or (not path and at != source):
                    while nexts[at] < len(near[at]):
                        e = near[at][nexts[at]]
                        if room[e] > tiny and level[to[e]] == level[at] + 1:
                            break
                        nexts[at] += 1
                    else:
                        if not path:
                            at = -1
                            break
                        at = to[path.pop() ^ 1]
                        nexts[at] += 1
                        continue
                    path.append(e)
                    at = to[e]
                if at < 0:
                    break
                flow = min([supply[source], demand[at], *(room[e] for e in path)])
                supply[source] -= flow
                demand[at] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    return "\n".join(b[0] for b, content in zip(blocks, labels(blocks)) if content)


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``text`` (empty if there is none) and ``n_chars`` of every page, after the ``keep`` columns."""

    def work(documents: list[bytes]) -> dict[str, list]:
        texts = [main_text(d.decode()) for d in documents]
        return {"text": texts, "n_chars": list(map(len, texts))}

    return per_text(pages, html, keep or [], "text string, n_chars bigint", work)
