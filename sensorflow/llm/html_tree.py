"""HTML pages as trees of block elements, their skeletons, and simple tree matching of two skeletons."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np

#: Elements of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
UNSEEN = frozenset("audio canvas iframe math noscript object script select style svg template textarea title video button option datalist".split())
SIDE = frozenset("aside dialog fieldset footer form menu nav".split())
MAIN = frozenset("article main".split())
SIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
SIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
    "disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split()
)
#: Among these, names of what holds a heading of the whole site.
SITE_NAMES = frozenset("banner masthead menu nav navbar navigation topbar".split())
#: An element on the left ends an open one on the right.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
LISTS = frozenset("ul ol dl table menu".split())
#: Unseen elements that the start of one on the right ends, as they cannot hold it.
LEFT_BY = {
    "select": (BLOCK - {"div", "hr", "legend"}) | {"input", "select", "textarea"}, "datalist": BLOCK, "svg": BLOCK, "math": BLOCK,
    "option": BLOCK - {"div", "hr", "legend"}, "button": MAIN | {"body", "button"},
} | {tag: frozenset({"body"}) for tag in ("audio", "canvas", "noscript", "object", "textarea", "title", "video")}
#: Inside these, what would end an element outside does not.
SHUT = frozenset({"template", "foreignobject"})
COMMENT = re.compile(r"<!--(?:-?>|.*?--!?>)", re.DOTALL)
LEAVES = {tag: [left for left, by in LEFT_BY.items() if tag in by] for tag in BLOCK | {"input", "select", "textarea", "button"}}
NAMES = re.compile(r"[a-z0-9]+")


@dataclass(eq=False)
class Node:
    """A block element; ``parts`` are its children in order, text as strings."""

    tag: str
    label: str
    main: bool
    side: bool
    named_side: bool
    parent: Node | None = None
    parts: list = field(default_factory=list)


@dataclass
class Block:
    """A block of text: its element, and whether it is inside the main region and inside something that is not content."""

    node: Node
    text: str
    main: bool
    side: bool


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#", "#", False, False, False)
        self.open: list[tuple[str, Node, bool]] = [("#", self.root, True)]  # every open element, the block element it adds to, if seen
        self.times = Counter()  # open elements by name
        self.ending = False

    def close(self):
        self.ending = True
        super().close()

    def _or_rest(self, end: int, at: int) -> int:
        """Where a tag ends; one that the end of the page cuts off takes what is left."""
        return len(self.rawdata) if end < 0 and self.ending and self.rawdata.find(">", at) < 0 else end

    def parse_starttag(self, i):
        return self._or_rest(super().parse_starttag(i), i)

    def parse_endtag(self, i):
        return self._or_rest(super().parse_endtag(i), i)

    def parse_html_declaration(self, i):
        return self._or_rest(super().parse_html_declaration(i), i)

    def parse_pi(self, i):
        return self._or_rest(super().parse_pi(i), i)

    def parse_comment(self, i, report=1):
        """Called only where a comment can begin; one without an end reaches to the end of the page."""
        found = COMMENT.match(self.rawdata, i)
        return found.end() if found else len(self.rawdata) if self.ending else -1

    def handle_starttag(self, tag, attrs):
        if not self.open[-1][2] and any(self.times[left] for left in LEAVES.get(tag, ())):
            self._leave(tag)
        if tag in VOID:
            if self.open[-1][2]:
                self._text(" ") if tag not in BLOCK else self._block(tag, attrs, False)
            return
        if tag in BLOCK:
            self._end({"p"}, LISTS | {"table"}) if tag != "p" or self.times["p"] else None
        if tag in ENDS:
            self._end(ENDS[tag], LISTS)
        seen = self.open[-1][2] and tag not in UNSEEN
        if tag in BLOCK and seen:
            self._block(tag, attrs, True)
        else:
            if tag in ("td", "th"):
                self._text(" ")
            self._open(tag, self.open[-1][1], seen)

    def _leave(self, tag: str) -> None:
        """Ends the outermost unseen element that cannot hold ``tag``."""
        first = len(self.open)
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][2] or self.open[at][0] in SHUT:
                break
            if tag in LEFT_BY.get(self.open[at][0], ()):
                first = at
        self._cut(first)

    def _open(self, tag: str, node: Node, seen: bool) -> None:
        self.open.append((tag, node, seen))
        self.times[tag] += 1

    def _cut(self, at: int) -> None:
        """Closes the elements from place ``at`` on."""
        for tag, *_ in self.open[at:]:
            self.times[tag] -= 1
        del self.open[at:]

    def _block(self, tag, attrs, stays: bool) -> None:
        parent = self.open[-1][1]
        given = {k: v or "" for k, v in attrs}
        names = NAMES.findall(f"{given.get('class', '')} {given.get('id', '')}".lower())
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "")
        role = given.get("role", "").lower()
        named = bool(SIDE_NAMES.intersection(names)) or ("header" in names and tag != "article")
        label = ".".join([tag, *sorted({re.sub("[0-9]+", "#", n) for n in names})])
        node = Node(tag, label, tag in MAIN or role == "main", tag in SIDE or hidden or role in SIDE_ROLES, named and tag not in ("html", "body", "main"), parent)
        if tag == "header":
            node.named_side = True
        parent.parts.append(node)
        if stays:
            self._open(tag, node, True)

    def _end(self, tags, stop) -> None:
        """Closes the innermost open element among ``tags`` unless one of ``stop`` is opened inside it."""
        if not any(self.times[tag] for tag in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at][0]
            if tag in tags:
                self._cut(at)
                return
            if tag in stop or (tag in UNSEEN and tag != "option") or (tag in BLOCK and tag not in ("p", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt")):
                return

    def handle_endtag(self, tag):
        if not self.times[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                self._cut(at)
                return
            if self.open[at][0] in SHUT or (self.open[at][0] in BLOCK and tag not in BLOCK and tag not in UNSEEN):
                return

    def handle_data(self, data):
        self._text(data)

    def _text(self, data: str) -> None:
        _, node, seen = self.open[-1]
        if seen:
            node.parts.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _above(node: Node | None) -> Iterator[Node]:
    """The element and all that it is in."""
    while node is not None:
        yield node
        node = node.parent


def _preorder(root: Node) -> list[Node]:
    out, waiting = [], [root]
    while waiting:
        out.append(node := waiting.pop())
        waiting.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return out


def _add(held: set[Node], node: Node | None) -> None:
    for up in _above(node):
        if up in held:
            return
        held.add(up)


def _holders(order: list[Node]) -> tuple[set[Node], Node | None, bool]:
    """Elements that no name makes something else, the page's heading, and whether it stands in the header of the site.

    These hold the page's heading or a main element; also an article with more than half of the text, if it has a heading of its own
    or the page has neither.
    """
    inside: list[Node] = []
    named: set[Node] = set()
    flags: dict[Node | None, tuple] = {None: (False, False, False, False)}
    for node in order:
        shut, name, site, marked = flags[node.parent]
        shut, name, marked = shut or node.side, name or node.named_side, marked or node.main
        site = site or node.tag == "header" or (node.named_side and node.tag != "body" and not SITE_NAMES.isdisjoint(node.label.split(".")[1:]))
        flags[node] = shut, name, site, marked
        if not shut:
            inside.append(node)
            if name and node.tag == "article":
                named.add(node)
    headings = [n for n in inside if n.tag == "h1"]
    of_site = {n for n in headings if flags[n][2] and not flags[n][3]}
    heading = next((n for n in headings if n not in of_site), headings[0] if headings else None)
    held: set[Node] = set()
    for node in inside:
        if node.main and node.tag != "article":
            _add(held, node)
    if heading:
        _add(held, heading.parent)
    if named and (not held or len(headings) > 1):
        chars: dict[Node, int] = {}
        for node in reversed(inside):
            chars[node] = sum(len(p.strip()) if isinstance(p, str) else chars.get(p, 0) for p in node.parts)
        with_heading: set[Node] = set()
        for node in headings:
            _add(with_heading, node.parent)
        most = (n for n in inside if n in named and 2 * chars[n] > chars[inside[0]] and (not held or n in with_heading))
        _add(held, next(most, None))
    return held, heading, heading in of_site


def _region(found: list[Block], tops: list[tuple[Node | None, Node | None]], heading: Node | None, of_site: bool) -> list[bool]:
    """Which blocks are inside the main region; none if no marked element is known to hold the page's article.

    ``tops`` has the outermost main element of each block, and its outermost main or article.
    """
    sizes = [0 if b.side else len(b.text) for b in found]
    above = set(_above(heading))
    title = sum(n for n, b in zip(sizes, found, strict=True) if heading and heading in (b.node, b.node.parent))
    in_main = sum(n for n, (main, _) in zip(sizes, tops, strict=True) if main)
    each: Counter[Node] = Counter()
    for n, (_, top) in zip(sizes, tops, strict=True):
        if top:
            each[top] += n
    total, marked = sum(sizes), sum(each.values())
    if in_main and (2 * in_main > total or (any(main in above for main, _ in tops if main) and in_main > title and 2 * in_main > marked)):
        return [main is not None for main, _ in tops]
    if marked > title and not above.isdisjoint(each):
        return [top is not None for _, top in tops]
    if each and 2 * max(each.values()) > total and (heading is None or of_site):
        return [top is not None for _, top in tops]
    return [False] * len(found)


def blocks(root: Node) -> list[Block]:
    """All blocks of text in page order, white space turned into single spaces."""
    order = _preorder(root)
    held, heading, of_site = _holders(order)
    state: dict[Node | None, tuple] = {None: (False, None, None)}  # side, outermost main element, outermost main or article
    for node in order:
        side, main, top = state[node.parent]
        named = node.named_side and node not in held and not (top and node.tag == "header")
        side = side or node.side or named
        if node.main and not side:
            top = top or node
            if node.tag != "article":
                main = main or node
        state[node] = side, main, top
    out: list[Block] = []
    tops: list[tuple[Node | None, Node | None]] = []
    pending: list[str] = []

    def flush(node: Node) -> None:
        if pending and (text := " ".join("".join(pending).split())):
            side, main, top = state[node]
            out.append(Block(node, text, False, side))
            tops.append((main, top))
        pending.clear()

    waiting = [(root, iter(root.parts))]
    while waiting:
        node, parts = waiting[-1]
        for part in parts:
            if isinstance(part, str):
                pending.append(part)
                continue
            flush(node)
            waiting.append((part, iter(part.parts)))
            break
        else:
            flush(node)
            waiting.pop()
    for block, main in zip(out, _region(out, tops, heading, of_site), strict=True):
        block.main = main
    return out


Skeleton = list  # [label, size] of each element in preorder; equal neighbours are one element


class _Shapes:
    """Numbers of trees: equal trees have one number."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.labels: list[str] = []
        self.children: list[tuple[int, ...]] = []
        self.sizes: list[int] = []

    def number(self, label: str, children: tuple[int, ...]) -> int:
        found = self.numbers.setdefault((label, children), len(self.labels))
        if found == len(self.labels):
            self.labels.append(label)
            self.children.append(children)
            self.sizes.append(1 + sum(self.sizes[c] for c in children))
        return found

    def of(self, tree: Skeleton) -> int:
        done: dict[int, int] = {}
        for at in range(len(tree) - 1, -1, -1):
            label, size = tree[at]
            children, child = [], at + 1
            while child < at + size:
                children.append(done[child])
                child += tree[child][1]
            done[at] = self.number(label, tuple(children))
        return done[0]

    def starts(self, shape: int, at: int) -> list[int]:
        out, following = [], at + 1
        for child in self.children[shape]:
            out.append(following)
            following += self.sizes[child]
        return out


def skeleton(root: Node) -> tuple[Skeleton, dict[Node, int]]:
    """The tree of labels, and each element's slot: its place in preorder, the same for equal neighbours."""
    shapes, order = _Shapes(), _preorder(root)
    of: dict[Node, int] = {}
    for node in reversed(order):
        children: list[int] = []
        for part in node.parts:
            if isinstance(part, Node) and (not children or children[-1] != of[part]):
                children.append(of[part])
        of[node] = shapes.number(node.label, tuple(children))
    slots = {root: 0}
    for node in order:
        following, last, at = slots[node] + 1, None, 0
        for part in node.parts:
            if isinstance(part, Node):
                if of[part] != last:
                    at, last = following, of[part]
                    following += shapes.sizes[last]
                slots[part] = at
    tree, waiting = [], [of[root]]
    while waiting:
        shape = waiting.pop()
        tree.append([shapes.labels[shape], shapes.sizes[shape]])
        waiting.extend(reversed(shapes.children[shape]))
    return tree, slots


def _flat(tree: tuple) -> Skeleton:
    """The skeleton of a tree given as (label, children)."""
    out, waiting = [], [(tree, False)]
    open_at: list[int] = []
    while waiting:
        (label, children), left = waiting.pop()
        if left:
            at = open_at.pop()
            out[at][1] = len(out) - at
        else:
            open_at.append(len(out))
            out.append([label, 1])
            waiting.append(((label, children), True))
            waiting.extend((child, False) for child in reversed(children))
    return out


#: Cells of a table of two lists of children that is kept whole; longer lists are aligned row by row.
WHOLE_CELLS = 1 << 10
#: Weights of rows that are spread over all columns at once; beyond, row by row.
WIDE_CELLS = 1 << 22


class _Alignment:
    """The heaviest order-preserving pairs of two long lists of children, in memory that grows with the length times its root.

    A row of the table is one vector operation. Every so many rows one is kept; going back, the rows between two of them are made again.
    """

    def __init__(self, a: Sequence[int], b: Sequence[int], weight: Callable[[int, int], int]):
        rows, self.row_of = np.unique(a, return_inverse=True)
        columns, self.column_of = np.unique(b, return_inverse=True)
        self.weights = np.array([[weight(x, y) for y in columns.tolist()] for x in rows.tolist()], np.int32)
        self.wide = self.weights[:, self.column_of] if len(rows) * len(b) <= WIDE_CELLS else None
        self.step = max(1, math.isqrt(len(a)))
        self.kept = {0: np.zeros(len(b) + 1, np.int32)}
        last = self.kept[0]
        for at, last in enumerate(self._rows(last, 0, len(a)), 1):
            if at % self.step == 0:
                self.kept[at] = last
        self.value = int(last[-1])

    def _rows(self, row: np.ndarray, begin: int, end: int) -> Iterator[np.ndarray]:
        for shape in self.row_of[begin:end]:
            following = row.copy()
            weights = self.weights[shape][self.column_of] if self.wide is None else self.wide[shape]
            np.maximum(row[1:], row[:-1] + weights, out=following[1:])
            row = np.maximum.accumulate(following)
            yield row

    def pairs(self) -> Iterator[tuple[int, int]]:
        """Matched places, from the last; the same ones that the whole table would give."""
        i, j = len(self.row_of), len(self.column_of)
        while i and j:
            low = (i - 1) // self.step * self.step
            table = [self.kept[low], *self._rows(self.kept[low], low, i)]
            while i > low and j:
                here, above = table[i - low], table[i - low - 1]
                if here[j] == above[j]:
                    i -= 1
                elif here[j] == here[j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    yield i, j


class _Table:
    """The same for short lists, with the whole table."""

    def __init__(self, a: Sequence[int], b: Sequence[int], weight: Callable[[int, int], int]):
        self.rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            above, here = self.rows[i - 1], self.rows[i]
            for j, y in enumerate(b, 1):
                here[j] = max(above[j], here[j - 1], above[j - 1] + weight(x, y))
        self.value = self.rows[-1][-1]

    def pairs(self) -> Iterator[tuple[int, int]]:
        table = self.rows
        i, j = len(table) - 1, len(table[0]) - 1
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                yield i, j


def match(one: Skeleton | tuple, two: Skeleton | tuple) -> dict[int, int]:
    """Simple tree matching: the largest order-preserving match of the two trees, as slots of one to slots of two."""
    shapes = _Shapes()
    first, second = (shapes.of(_flat(tree) if isinstance(tree, tuple) else tree) for tree in (one, two))
    labels, children = shapes.labels, shapes.children
    if labels[first] != labels[second]:
        return {}
    best: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], _Table] = {}

    def weight(x: int, y: int) -> int:
        return best[x, y] if labels[x] == labels[y] else 0

    def aligned(a: int, b: int) -> _Table | _Alignment:
        whole = len(children[a]) * len(children[b]) <= WHOLE_CELLS
        return (_Table if whole else _Alignment)(children[a], children[b], weight)

    waiting = [(first, second)]
    while waiting:
        a, b = pair = waiting[-1]
        if pair in best:
            waiting.pop()
            continue
        ours, theirs = set(children[a]), set(children[b])
        needed = {(x, y) for x in ours for y in theirs if labels[x] == labels[y] and (x, y) not in best}
        if needed:
            waiting.extend(needed)
            continue
        table = aligned(a, b)
        best[pair] = 1 + table.value
        if isinstance(table, _Table):
            tables[pair] = table
        waiting.pop()

    out: dict[int, int] = {}
    taken = [(first, second, 0, 0)]
    while taken:
        a, b, at, bt = taken.pop()
        out[at] = bt
        starts_a, starts_b = shapes.starts(a, at), shapes.starts(b, bt)
        table = tables.get((a, b)) or aligned(a, b)
        taken += [(children[a][i], children[b][j], starts_a[i], starts_b[j]) for i, j in table.pairs()]
    return out
