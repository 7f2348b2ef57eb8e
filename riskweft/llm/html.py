"""Text of web pages, laid out as a reader sees it.

A tokeniser splits a page into tags and text, a tree builder adds the tags that
HTML implies (a `li` ends the `li` before it, a block ends an open `p`, an end
tag closes what stands open inside it), visibility rules leave out what is not
shown, and a renderer walks the tree: blocks stand on lines of their own,
paragraphs and headings have an empty line around them, lists are indented and
numbered, tables have their cells in columns, `pre` keeps its spaces.

Nulls: a null page has null text. Text that is no HTML comes back with its white
space folded. Broken markup never fails: what is no tag is text, what is not
closed ends with the page. Tags nest as deep as they do: neither the builder nor
the renderer recurses, and a tag finds what it ends in a fixed number of looks.
Repeated rows get equal texts. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Generator, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.words import pieces

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript iframe object svg math canvas audio video select datalist dialog title noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table ul xmp".split()
)
#: Blocks with an empty line before and after.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl menu dir table figure hr".split())
#: A start tag in the first list ends an open element of the second, as far as one of the third.
_CELLS, _TABLE = frozenset(("td", "th")), frozenset(("table",))
IMPLIED_ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))), "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "td": (_CELLS, frozenset(("tr", "table"))), "th": (_CELLS, frozenset(("tr", "table"))),
    "tr": (frozenset(("tr", "caption", "colgroup")), _TABLE),
    **{t: (frozenset(("thead", "tbody", "tfoot", "caption", "colgroup")), _TABLE) for t in ("thead", "tbody", "tfoot")},
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))), "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "body": (frozenset(("head",)), frozenset()),
}
#: A block start ends an open p, as far as one of these.
P_SCOPE = frozenset("button td th caption object table".split())
#: End tags do not reach out of these, but for those of the second list.
WALLS = frozenset("td th table caption button".split())
_THROUGH = frozenset("table tr tbody thead tfoot td th body html".split())
_ROWS = frozenset("thead tbody tfoot tr".split())
_PARTS = frozenset("table thead tbody tfoot".split())
#: Columns and rows that a cell may span in HTML.
SPANS = {"colspan": 1000, "rowspan": 65534}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\r\n\f]+")
_NONE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


class Open:
    """Elements that are open, outermost first, and where each tag stands among them."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.at: dict[str, list[int]] = {}

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, i: int) -> None:
        """Ends the i-th element and all inside it."""
        for node in self.nodes[i:]:
            self.at[node.tag].pop()
        del self.nodes[i:]

    def last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element with one of the tags, 0 for none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)


def parse(page: str) -> Node:
    """The tree of a page; children are nodes and text."""
    root = Node("#root", {})
    stack, at, end = Open(root), 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            _text(stack, page[at:])
            break
        if m.start() > at:
            _text(stack, page[at : m.start()])
        at = m.end()
        if m.group(1) is None:
            continue
        tag = m.group(1).lower()
        if page[m.start() + 1] == "/":
            _close(stack, tag)
            continue
        _open(stack, tag, m.group(2))
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            body = page[at : close.start() if close else end]
            if body and tag not in ("script", "style"):
                stack.top.children.append(html.unescape(body) if tag in ("textarea", "title") else body)
            stack.cut(len(stack.nodes) - 1)
            at = close.end() if close else end
    return root


def _text(stack: Open, said: str) -> None:
    if stack.top.tag in ("table", "tbody", "thead", "tfoot", "tr", "ul", "ol", "dl") and not said.strip():
        return
    stack.top.children.append(html.unescape(said) if "&" in said else said)


def _open(stack: Open, tag: str, said: str) -> None:
    rule = IMPLIED_ENDS.get(tag)
    if rule:
        ended, scope = rule
        i = stack.last(ended)
        if i > stack.last(scope):
            stack.cut(i)
        if tag in _ROWS:  # rows end what a cell left open
            i = stack.last(_PARTS | {"tr"} if tag == "tr" else _PARTS)
            if i:
                stack.cut(i + (stack.nodes[i].tag != "tr"))
    elif tag in BLOCK:
        i = stack.last(("p",))
        if i > stack.last(P_SCOPE):
            stack.cut(i)
    if tag in _CELLS and stack.top.tag in _PARTS:
        row = Node("tr", {})
        stack.top.children.append(row)
        stack.push(row)
    attributes = {}
    if said and said.strip(" \t\r\n\f/"):
        for name, a, b, c in _ATTRIBUTE.findall(said):
            attributes.setdefault(name.lower(), html.unescape(a or b or c))
    node = Node(tag, attributes)
    stack.top.children.append(node)
    if tag not in VOID:
        stack.push(node)


def _close(stack: Open, tag: str) -> None:
    if tag == "br":
        stack.top.children.append(Node("br", {}))
        return
    i = stack.last((tag,))
    if i and (i >= stack.last(WALLS) or tag in _THROUGH):
        stack.cut(i)


def visible(node: Node) -> bool:
    a = node.attributes
    if node.tag in HIDDEN or not a:
        return node.tag not in HIDDEN
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or (node.tag == "input" and a.get("type", "").lower() == "hidden"):
        return False
    return not ("style" in a and _NONE.search(a["style"]))


class Lines:
    """Lines of output; text of one line is folded as it comes."""

    def __init__(self):
        self.done: list[str] = []
        self.line: list[str] = []
        self.gap = 0

    def add(self, said: str) -> None:
        said = _SPACE.sub(" ", said)
        if not self.line or self.line[-1].endswith(" "):
            said = said.lstrip(" ")
        if said:
            self.line.append(said)

    def end(self) -> None:
        said = "".join(self.line).rstrip(" ")
        self.line = []
        if said:
            self.put(said)

    def put(self, said: str) -> None:
        if self.done and self.gap:
            self.done.append("")
        self.gap = 0
        self.done.append(said)

    def space(self) -> None:
        self.end()
        self.gap = 1


#: A step of rendering yields the step that has to be done before it goes on, and gets its result.
Step = Generator


def _done(step: Step):
    """Runs a step and all that it asks for; what waits stands in a list, not on the call stack."""
    waiting, value = [step], None
    while waiting:
        try:
            step = waiting[-1].send(value)
        except StopIteration as end:
            waiting.pop()
            value = end.value
        else:
            waiting.append(step)
            value = None
    return value


def _render(node: Node, out: Lines) -> Step:
    for child in node.children:
        if isinstance(child, str):
            out.add(child)
            continue
        if not visible(child):
            continue
        tag = child.tag
        if tag == "br":
            out.end()
        elif tag in ("ul", "ol", "menu", "dir"):
            yield _list(child, out)
        elif tag == "table":
            yield _table(child, out)
        elif tag in ("pre", "xmp", "textarea"):
            out.space()
            for line in _plain(child).strip("\n").split("\n"):
                out.put(line.rstrip())
            out.space()
        elif tag == "dd":
            out.end()
            yield _indented(child, out, "    ", "    ")
        elif tag in BLOCK:
            out.space() if tag in SPACED else out.end()
            yield _render(child, out)
            out.space() if tag in SPACED else out.end()
        else:
            yield _render(child, out)


def _inner(node: Node) -> Step:
    out = Lines()
    yield _render(node, out)
    out.end()
    return out.done


def _indented(node: Node, out: Lines, first: str, rest: str) -> Step:
    for i, line in enumerate((yield _inner(node))):
        out.put((first if i == 0 else rest) + line if line else line)


def _list(node: Node, out: Lines) -> Step:
    """Items stand by a dash or their number; lists inside an item are indented under it."""
    out.space()
    start = node.attributes.get("start", "1")
    number = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                out.put(_SPACE.sub(" ", child).strip())
        elif visible(child):
            if child.tag == "li":
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += 1
                yield _indented(child, out, mark, " " * len(mark))
            else:
                shell = Node("li", {})
                shell.children.append(child)
                yield _indented(shell, out, "  ", "  ")
    out.space()


def _width(said: str) -> int:
    """Columns of a text; wide characters take two, combining ones none."""
    if said.isascii():
        return len(said)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in said)


def _span(cell: Node, name: str) -> int:
    said = cell.attributes.get(name, "1")
    return min(max(int(said), 1), SPANS[name]) if re.fullmatch("[0-9]{1,6}", said) else 1


def _rows(node: Node) -> Iterator[Node]:
    for child in node.children:
        if isinstance(child, Node) and visible(child):
            if child.tag == "tr":
                yield child
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(child)


def _loose(node: Node, out: Lines) -> Step:
    """What stands in a table but in no cell comes before it."""
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                out.add(child)
        elif visible(child):
            if child.tag in ("tr", "thead", "tbody", "tfoot"):
                yield _loose(child, out)
            elif node.tag != "tr" and child.tag not in ("colgroup", "col"):
                out.end()
                yield _render(child, out)
                out.end()


def _table(node: Node, out: Lines) -> Step:
    """Cells of a column start at one place; a cell's lines stand below each other. A cell over several columns starts at its first."""
    out.space()
    yield _loose(node, out)
    out.end()
    grid: list[dict[int, list[str]]] = []
    widths: dict[int, int] = {}
    below: dict[int, int] = {}  # column -> rows that a cell above still covers
    for row in _rows(node):
        cells, column = {}, 0
        for cell in row.children:
            if not isinstance(cell, Node) or not visible(cell):
                continue
            while below.get(column, 0) > 0:
                column += 1
            wide, high = _span(cell, "colspan"), _span(cell, "rowspan")
            lines = [x for x in (yield _inner(cell)) if x]
            cells[column] = lines
            if wide == 1:
                widths[column] = max([widths.get(column, 0), *map(_width, lines)])
            for k in range(column, column + wide):
                below[k] = high
            column += wide
        below = {k: n - 1 for k, n in below.items() if n > 1}
        grid.append(cells)
    starts, at = {}, 0
    for column in range(max((c for row in grid for c in row), default=-1) + 1):
        starts[column] = at
        if widths.get(column):
            at += widths[column] + 2
    for cells in grid:
        for i in range(max(map(len, cells.values()), default=0)):
            line, used = "", 0
            for column in sorted(cells):
                if i < len(cells[column]):
                    pad = max(starts[column] - used, 2 if line else 0)
                    line += " " * pad + cells[column][i]
                    used += pad + _width(cells[column][i])
            if line.strip():
                out.put(line)
    out.space()


def _plain(node: Node) -> str:
    """Text as it stands, for `pre`."""
    said, waiting = [], [node]
    while waiting:
        now = waiting.pop()
        if isinstance(now, str):
            said.append(now)
        elif now.tag == "br":
            said.append("\n")
        elif now is node or visible(now):
            waiting.extend(reversed(now.children))
    return "".join(said)


def page_text(page: str) -> str:
    return "\n".join(_done(_inner(parse(page))))


def page_title(page: str) -> str:
    m = re.search(r"<title[^>]*>(.*?)(?:</title|\Z)", page, re.I | re.S)
    return _SPACE.sub(" ", html.unescape(m.group(1))).strip() if m else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, title, text for every page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            said = batch.column("html").to_pylist()
            columns = [batch.column("page_id"), batch.column("url")]
            columns += [pa.array([None if p is None else f(p) for p in said], pa.string()) for f in (page_title, page_text)]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "title", "text"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(read, "page_id long, url string, title string, text string")
