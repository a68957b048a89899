"""Visible text of HTML pages, laid out in blocks, lists and aligned tables.

A tokenizer feeds a tree builder that opens and closes the tags which authors
leave out; visibility rules then drop what a browser would not show (controls keep
their labels, drawings and formulas their text; what assistive software skips is
still seen), and a
renderer walks the tree: blocks are set apart, list items get markers and
indents, table cells are aligned in columns.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element categories of the public HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "script style head title template noscript iframe noembed noframes object audio video canvas datalist area base link meta param rp source track".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead tr ul caption xmp".split()
)
SPACED = frozenset("p blockquote dl figure h1 h2 h3 h4 h5 h6 ol ul pre table fieldset menu dir listing xmp".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre search section summary table ul".split()
)
# an opening tag closes an open element of these names, up to the scope elements
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
SCOPE = frozenset("table td th caption html template button object".split())
ROW_PARTS = frozenset("tr td th thead tbody tfoot".split())
UNDRAWN = frozenset("annotation annotation-xml clippath defs desc lineargradient marker mask metadata pattern radialgradient symbol".split())  # of svg and math
HEAD_CONTENT = frozenset("title base link meta style script noscript template head html".split())

# In a tag, quotes count only where a value begins; elsewhere they are characters like any other.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?>[\s/]+|[^\s/>=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))?|=)*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
MOST_DEPTH = 512  # as in the tree builders of browsers
MOST_COLUMNS, MOST_ROWS = 1000, 65534  # of one cell, as HTML itself has it
SPACE = re.compile(r"[ \t\n\r\f]+")
# What the properties that decide on visibility may be; other declarations are invalid and don't count.
STYLES = {
    "display": frozenset(
        "none block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell table-row-group table-caption list-item flow-root contents ruby initial inherit unset revert".split()
    ),
    "visibility": frozenset("visible hidden collapse inherit initial unset revert".split()),
    "content-visibility": frozenset("visible hidden auto".split()),
}
VISIBILITY = re.compile("visibility|&", re.I)  # a property's name may be written with entities
CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
UNLABELLED = frozenset("hidden password checkbox radio file color range image".split())  # inputs whose value is no text on the page


class Node:
    __slots__ = ("tag", "attributes", "children", "shown")

    def __init__(self, tag: str, attributes: dict[str, str], shown: bool = True):
        self.tag, self.attributes, self.children, self.shown = tag, attributes, [], shown


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if not raw or raw.isspace():
        return found
    for name, double, single, bare in ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), entities.unescape(double or single or bare))
    return found


def build_tree(markup: str) -> Node:
    """The tree of a page. Never fails: stray end tags are dropped, open elements end with their parents."""
    root = Node("html", {})
    stack = [root]
    at, end = 0, len(markup)

    def close(names: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                return
            if stack[k].tag in stops:
                return

    def put_text(text: str) -> None:
        if text:
            if stack[-1].tag == "head" and not text.isspace():
                stack.pop()
            stack[-1].children.append(entities.unescape(text))

    while at < end:
        m = TOKEN.search(markup, at)
        if not m:
            put_text(markup[at:])
            break
        put_text(markup[at : m.start()])
        at = m.end()
        name = m[2]
        if not name:
            continue
        name = name.lower()
        if m[1]:
            if name == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].children.append(Node("p", {}))
            elif name == "br":
                stack[-1].children.append(Node("br", {}))
            elif name not in ("body", "html"):
                stops = set() if name == "table" else {"table"} if name in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else SCOPE - {name}
                close({name}, stops)
            continue
        attributes = _attributes(m[3])
        if name in ("html", "body") and any(n.tag == name for n in stack):
            continue
        if stack[-1].tag == "head" and name not in HEAD_CONTENT:
            stack.pop()
        if name in CLOSES_P and name != "table":
            close({"p"}, SCOPE)
        if name in IMPLIED_END:
            names, stops = IMPLIED_END[name]
            while any(n.tag in names for n in stack[1:]):
                before = len(stack)
                close(names, stops | {"table"} - names)
                if len(stack) == before:
                    break
        if len(name) == 2 and name[0] == "h" and name[1].isdigit() and len(stack[-1].tag) == 2 and stack[-1].tag[0] == "h" and stack[-1].tag[1].isdigit():
            stack.pop()
        if name in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            stack[-1].children.append(row := Node("tr", {}))
            stack.append(row)
        if name in UNDRAWN and any(n.tag in ("svg", "math") for n in stack):
            attributes = {"hidden": ""}
        node = Node(name, attributes)
        stack[-1].children.append(node)
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(markup, at)
            text = markup[at : stop.start()] if stop else markup[at:]
            node.children.append(entities.unescape(text) if name in ("textarea", "title") else text)
            at = stop.end() if stop else end
        elif name not in VOID and not (m[3].endswith("/") and name not in BLOCKS and name not in HIDDEN):
            stack.append(node)
        if len(stack) > MOST_DEPTH:  # deeper elements become siblings; none of their text is lost
            stack.pop()
    if VISIBILITY.search(markup):
        _inherit(root)
    return root


def styles(declarations: str) -> dict[str, str]:
    """The properties of a style attribute that decide on visibility; of several valid values the last counts, important ones before others."""
    found: dict[str, tuple[bool, str]] = {}
    for part in CSS_COMMENT.sub("", declarations).split(";"):
        name, _, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        important = value.endswith("!important") or value.replace(" ", "").endswith("!important")
        value = value.split("!")[0].strip()
        if value in STYLES.get(name, ()) and (important or not found.get(name, (False, ""))[0]):
            found[name] = important, value
    return {name: value for name, (_, value) in found.items()}


def _inherit(root: Node) -> None:
    """Set ``shown``: an element is hidden by its own visibility, or its parent's if it has none."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        for child in node.children:
            if isinstance(child, Node):
                style = child.attributes.get("style")
                own = styles(style).get("visibility", "inherit") if style else "inherit"
                child.shown = node.shown if own in ("inherit", "unset", "revert") else own in ("visible", "initial")
                waiting.append(child)


def visible(node: Node) -> bool:
    """Whether an element and what is in it is laid out at all."""
    a = node.attributes
    if node.tag in HIDDEN or (node.tag == "dialog" and "open" not in a):
        return False
    if not a:
        return True
    style = styles(a["style"]) if a.get("style") else {}
    return style.get("display", "none" if "hidden" in a else "") != "none" and style.get("content-visibility") != "hidden"


def label(node: Node) -> str:
    """The text that an input shows: its value."""
    return "" if node.attributes.get("type", "text").strip().lower() in UNLABELLED else node.attributes.get("value", "")


def _number(node: Node, name: str) -> int | None:
    value = node.attributes.get(name, "").strip()
    return int(value) if re.fullmatch(r"[-+]?\d{1,9}", value) else None


def walk(steps: Iterator) -> None:
    """Run a generator that yields generators to be run in its place; depth takes memory, not the interpreter's stack."""
    stack = [steps]
    while stack:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
        else:
            stack.append(step)


def cells_wide(text: str) -> int:
    """Columns that a text fills: wide characters fill two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Layout:
    """Lines of text; ``gap`` is the number of empty lines due before the next text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line, self.gap, self.space, self.pad, self.marker = "", 0, False, "", ""
        self.blocks = self.items = self.rows = 0

    def text(self, raw: str, keep: bool) -> None:
        if keep:
            parts = raw.replace("\r\n", "\n").split("\n")
            for k, part in enumerate(parts):
                if k:
                    self.end_line(force=True)
                if part:
                    self._put(part)
            return
        for k, word in enumerate(SPACE.split(raw)):
            if k:
                self.space = True
            if word:
                self._put((" " if self.space and self.line else "") + word)
                self.space = False

    def _put(self, part: str) -> None:
        if not self.line:
            if self.lines and self.gap:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.line = self.pad + self.marker if not self.marker else self.pad[: -len(self.marker)] + self.marker if len(self.pad) >= len(self.marker) else self.marker
            self.marker = ""
        self.line += part

    def end_line(self, force: bool = False) -> None:
        if self.line:
            self.lines.append(self.line.rstrip(" "))
            self.blocks += not force
        elif force and self.lines:
            self.lines.append("")
        self.line, self.space = "", False

    def block(self, empty: int) -> None:
        self.end_line()
        self.gap = max(self.gap, empty)


def _render(node: Node, out: Layout, keep: bool, numbers: list[list[int] | None]) -> Iterator:
    """numbers: for each list around, the next number and the step to the one after it; None for lists without numbers."""
    children = node.children
    if node.tag == "details" and "open" not in node.attributes:  # closed: only its summary is seen
        children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
    for child in children:
        if isinstance(child, str):
            if node.shown:
                out.text(child, keep)
            continue
        tag = child.tag
        if not visible(child):
            continue
        if tag == "br":
            if out.line:
                out.end_line(force=True)
            elif out.lines:
                out.lines.append("")
            continue
        if tag == "wbr":
            continue
        if tag == "img":
            if child.shown and child.attributes.get("alt", "").strip():
                out.text(child.attributes["alt"], False)
            continue
        if tag == "input":
            if child.shown and label(child).strip():
                out.text(f" {label(child)} ", False)
            continue
        if tag == "hr":
            out.block(1)
            continue
        if tag == "table":
            out.block(1)
            yield _table(child, out)
            out.block(1)
            continue
        is_block = tag in BLOCKS
        empty = 1 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir", "dl") and numbers) else 0
        if is_block:
            out.block(empty)
        inner, pad, marker = numbers, out.pad, out.marker
        if tag in ("ul", "menu", "dir"):
            inner = [*numbers, None]
        elif tag == "ol":
            step = -1 if "reversed" in child.attributes else 1
            start = _number(child, "start")
            if start is None:
                start = 1 if step > 0 else sum(isinstance(c, Node) and c.tag == "li" and visible(c) for c in child.children)
            inner = [*numbers, [start, step]]
        elif tag == "li":
            out.items += 1
            sign = "- "
            if numbers and numbers[-1] is not None:
                number, step = numbers[-1]
                own = _number(child, "value")
                number = number if own is None else own
                sign = f"{number}. "
                numbers[-1][0] = number + step
            out.pad, out.marker = pad + " " * len(sign), sign
        elif tag in ("blockquote", "dd"):
            out.pad = pad + "  "
        keeps = keep or tag in ("pre", "textarea", "listing", "xmp")
        if tag == "details" or any(type(c) is Node for c in child.children):
            yield _render(child, out, keeps, inner)
        elif child.shown:
            for c in child.children:
                out.text(c, keeps)
        if is_block:
            out.block(empty)
        out.pad = pad
        if tag == "li":
            out.marker = marker if out.marker else ""


def _parts(table: Node, strays: list[Node | str]) -> Iterator[Node]:
    """The rows of a table, with their cells alone; what stands outside of cells goes to ``strays``, as browsers put it before the table."""
    loose: Node | None = None  # a row of cells that stand in none
    for child in table.children:
        if isinstance(child, str):
            if table.shown:
                strays.append(child)
        elif child.tag == "tr":
            if visible(child):
                row = Node("tr", child.attributes)
                row.children = list(_cells(child, strays))
                yield row
        elif child.tag in ("thead", "tbody", "tfoot") or _holds_rows(child):
            if visible(child):
                yield from _parts(child, strays)
        elif child.tag in ("td", "th"):
            if loose is None:
                loose = Node("tr", {})
                yield loose
            loose.children.append(child)
            continue
        elif child.tag not in ("colgroup", "col"):
            strays.append(child)
        elif visible(child):
            strays.extend(c for c in child.children if child.shown or isinstance(c, Node))
        if not isinstance(child, str):
            loose = None


def _cells(row: Node, strays: list[Node | str]) -> Iterator[Node]:
    for child in row.children:
        if isinstance(child, Node) and child.tag in ("td", "th"):
            yield child
        elif isinstance(child, Node) and _holds_rows(child):
            if visible(child):
                yield from _cells(child, strays)
        elif row.shown or isinstance(child, Node):
            strays.append(child)


def _holds_rows(node: Node) -> bool:
    """Whether an element between a table and its rows holds some, tables and captions inside it aside."""
    waiting = [node]
    while waiting:
        at = waiting.pop()
        if at.tag in ("table", "caption"):
            continue
        for c in at.children:
            if isinstance(c, Node):
                if c.tag in ROW_PARTS:
                    return True
                waiting.append(c)
    return False


def _span(cell: Node, name: str, most: int) -> int:
    value = cell.attributes.get(name, "1")
    return max(1, min(int(value), most)) if re.fullmatch(r"\d{1,6}", value) else 1


def _table(table: Node, out: Layout) -> Iterator:
    strays: list[Node | str] = []  # captions and text outside of cells stand before the table
    rows = list(_parts(table, strays))
    holder = Node("div", {})
    holder.children = strays
    yield _render(holder, out, False, [])
    out.block(0)
    grid: list[list[tuple[list[str], int]]] = []
    waiting: dict[int, int] = {}  # columns that cells from rows above still fill
    for row in rows:
        cells: list[tuple[list[str], int]] = []
        column = 0
        for cell in row.children:
            if not visible(cell):
                continue
            while waiting.get(column, 0) > 0:
                waiting[column] -= 1
                cells.append(([], 1))
                column += 1
            inner = Layout()
            holder = Node("div", {}, cell.shown)
            holder.children = cell.children
            yield _render(holder, inner, False, [])
            inner.end_line()
            out.items += inner.items
            wide = _span(cell, "colspan", MOST_COLUMNS)
            cells.append(([x for x in inner.lines if x], wide))
            for c in range(column, column + wide):
                waiting[c] = _span(cell, "rowspan", MOST_ROWS) - 1
            column += wide
        if any(lines for lines, _ in cells):
            grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        column = 0
        for lines, wide in cells:
            if wide == 1:
                widths[column] = max([widths.get(column, 0), *map(cells_wide, lines)])
            column += wide
    for cells in grid:
        out.rows += 1
        for k in range(max(len(lines) for lines, _ in cells)):
            text, due, column = "", 0, 0
            for lines, wide in cells:
                part = lines[k] if k < len(lines) else ""
                if part:
                    text += " " * max(0 if not text else 1, due - cells_wide(text)) + part
                due += sum(widths.get(c, 0) + 2 for c in range(column, column + wide))
                column += wide
            out.text(text.rstrip(), True)
            out.end_line()


def render(markup: str | None) -> tuple[str, int, int, int]:
    """(visible text, blocks, list items, table rows) of a page; a null or empty page has none."""
    if not markup:
        return "", 0, 0, 0
    out = Layout()
    walk(_render(build_tree(markup), out, False, []))
    out.end_line()
    while out.lines and not out.lines[-1]:
        out.lines.pop()
    return "\n".join(out.lines), out.blocks, out.items, out.rows


def extract_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The visible text of every whole page, one row per row of ``pages``.

    Columns: ``key``, text, n_blocks, n_items, n_rows. Null and empty pages give
    an empty text; broken markup is repaired, never refused.
    """
    schema = T.StructType(
        [T.StructField(key, pages.schema[key].dataType), T.StructField("text", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in ("n_blocks", "n_items", "n_rows")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                text, blocks, items, rows = zip(*map(render, part.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(text, pa.string()), *(pa.array(x, pa.int64()) for x in (blocks, items, rows))],
                    names=[key, "text", "n_blocks", "n_items", "n_rows"],
                )

    return pages.select(F.col(key), F.col(html)).mapInArrow(run, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
