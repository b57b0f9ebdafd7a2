"""Operator 2: all visible text of an HTML page, laid out.

``parse`` builds a tree: tags that HTML leaves out are implied (a block closes an open paragraph; items, rows, cells,
terms and options close their like; end tags without a start are dropped, and what is still open ends with its
parent).  ``render`` walks it: invisible elements (head, scripts, templates, ``hidden``, ``display: none``,
``visibility: hidden``, what svg and math do not draw) give nothing, ``visibility: visible`` shows again inside the latter; inline text collapses
white space; blocks begin lines and paragraphs, headings and lists are set off by an empty line; list items are
marked and indented; preformatted text keeps its spaces; the cells of a table's columns are aligned (with column and row spans), and
what stands in a table outside its cells comes before them.  Deep nesting is
no recursion: the walk keeps its own stack.

Limits: style sheets are not read (only style attributes and ``hidden`` hide), a closed ``details`` is shown whole, of inputs only
buttons' labels are text, tables nested deeper than ``DEPTH`` and indents beyond ``MOST_INDENT`` lose their layout but no text.

Defined cases: null html gives null text; empty html empty text; text outside any tag is visible; a tag, comment or
script that never ends takes the rest of the page; repeated rows get equal texts; an empty table gives an empty
result; only page_id and html are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from unicodedata import east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentalytics.llm.common import slices, small_batches

#: How HTML treats its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head title script style template noscript iframe object video audio canvas datalist noembed noframes param".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul tr caption""".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure menu dir".split())
CLOSES_P = BLOCK - frozenset("html body dd dt li option optgroup tr caption legend".split()) | {"dd", "dt", "li"}
#: A start tag closes an open element of the first set unless one of the second lies between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th", "caption"}, {"table", "tr"}), "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "body": ({"head"}, set()), "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
}
BUTTONS = frozenset("submit button reset".split())
TABLE_PARTS = frozenset("caption thead tbody tfoot tr td th".split())
#: In svg and math: what is not drawn, what holds HTML again, and the HTML elements that end them.
UNDRAWN = frozenset("desc defs metadata symbol clippath mask pattern marker annotation annotation-xml".split())
HTML_AGAIN = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
ENDS_FOREIGN = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre
ruby s small span strong strike sub sup table tt u ul var""".split())
#: Elements whose end tag must not reach past these.
SCOPE = frozenset("table td th caption button template html".split())
HEAD_ONLY = frozenset("html head title meta link base script style noscript template".split())

#: A quote opens a value only right after "="; an unquoted value ends at white space or ">".
_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)?+"""
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]|{_ATTRIBUTE})*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>"'][^\s>]*)?)?""")


class Node:
    __slots__ = ("tag", "attributes", "children", "foreign")

    def __init__(self, tag: str, attributes: dict[str, str], foreign: bool = False):
        self.tag, self.attributes, self.children, self.foreign = tag, attributes, [], foreign  # foreign: inside svg or math

    def holds_foreign(self) -> bool:
        return self.tag in ("svg", "math") or self.foreign and self.tag not in HTML_AGAIN


def parse(html: str) -> Node:
    root = Node("#root", {})
    stack, at = [root], 0
    places: dict[str, list[int]] = {}  # of each tag's open elements in the stack

    def close_to(k: int) -> None:
        while len(stack) > k:
            places[stack.pop().tag].pop()

    def last(tags: set | frozenset) -> int:
        return max((p[-1] for t in tags if (p := places.get(t))), default=0)

    def find(tags: set | frozenset, stop: set | frozenset) -> int | None:
        """The innermost open element of ``tags``, unless one of ``stop`` lies inside it."""
        k = last(tags)
        return k if k and k >= last(stop) else None

    def text(s: str) -> None:
        if s:
            if stack[-1].tag == "head" and not s.isspace():
                close_to(len(stack) - 1)
            stack[-1].children.append(unescape(s))

    while m := TOKEN.search(html, at):
        text(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            k = find({tag}, frozenset() if tag in SCOPE or tag in ("body", "tr", "thead", "tbody", "tfoot") else SCOPE)
            if k is not None:
                close_to(k)
            elif tag == "p":
                stack[-1].children.append(Node("p", {}))
            elif tag == "br":
                stack[-1].children.append(Node("br", {}))
            continue
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:
            close_to(len(stack) - 1)
        if tag in ENDS_FOREIGN:
            while stack[-1].holds_foreign():
                close_to(len(stack) - 1)
        foreign = stack[-1].holds_foreign()
        if tag in IMPLIED:
            likes, stop = IMPLIED[tag]
            while (k := find(likes, stop)) is not None:
                close_to(k)
        if tag in CLOSES_P and (k := find({"p"}, SCOPE)) is not None:
            close_to(k)
        attributes = {}
        if m[3].strip(" /\n\t\r"):
            for a in ATTRIBUTE.finditer(m[3]):
                value = a[2] or ""
                if value.startswith(("'", '"')):
                    value = value[1:].removesuffix(value[0])
                attributes.setdefault(a[1].lower(), unescape(value))
        node = Node(tag, attributes, foreign)
        stack[-1].children.append(node)
        if tag in VOID or foreign and m[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            raw = html[at:end.start() if end else len(html)]
            node.children.append(unescape(raw) if tag in ("textarea", "title") else raw)
            at = end.end() if end else len(html)
            continue
        if not m[3].endswith("/") or tag not in ("svg", "math"):
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    text(html[at:])
    return root


def width(s: str) -> int:
    return len(s) if s.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in s)


#: Columns by which lists and quotations are set in at most.
MOST_INDENT = 200


class Lines:
    """Text laid out so far: lines, the line being written, and the empty lines owed before the next."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now = ""
        self.first = ""  # a list marker for the next line
        self.indent = 0
        self.gap = 0

    def add(self, text: str, keep: bool = False) -> None:
        if keep:
            head, *rest = text.expandtabs(8).replace("\r\n", "\n").split("\n")
            self.now += head
            for line in rest:
                self.end(empty=True)
                self.now = line
            return
        text = re.sub(r"[ \t\n\r\f]+", " ", text)
        if not self.now or self.now.endswith(" "):
            text = text.lstrip(" ")
        self.now += text

    def end(self, gap: int = 0, empty: bool = False) -> None:
        """End the line; at least ``gap`` empty lines before the next."""
        line = self.now.rstrip(" ")
        self.now = ""
        if line or empty:
            if self.lines:
                self.lines += [""] * self.gap
            indent = min(self.indent, MOST_INDENT)
            pad = " " * indent
            if self.first:
                pad = (" " * max(indent - len(self.first), 0) + self.first)
                self.first = ""
            self.lines.append((pad + line).rstrip(" "))
            self.gap = 0
        if self.lines:
            self.gap = max(self.gap, gap)

    def block(self, lines: list[str]) -> None:
        for line in lines:
            self.now = line
            self.end(empty=True)

    def text(self) -> list[str]:
        self.end()
        return self.lines


def style_of(node: Node) -> dict[str, str]:
    """The first word of each property of the style attribute; the last one counts, and an important one before it."""
    found: dict[str, tuple[bool, str]] = {}
    for declaration in node.attributes.get("style", "").lower().split(";"):
        name, _, value = declaration.partition(":")
        name, important = name.strip(), "!" in value
        if (word := re.match(r"\s*([a-z-]+)", value)) and (important or not found.get(name, (False, ""))[0]):
            found[name] = important, word[1]
    return {name: word for name, (_, word) in found.items()}


def shown(node: Node, visible: bool) -> bool | None:
    """Whether a node's own text is visible; None if all below it is not displayed at all."""
    if node.tag in HIDDEN or node.foreign and node.tag in UNDRAWN or "hidden" in node.attributes and node.attributes["hidden"].lower() != "until-found" or \
            node.tag == "input" and node.attributes.get("type", "").lower() not in BUTTONS or node.tag == "dialog" and "open" not in node.attributes:
        return None
    if "style" in node.attributes:
        style = style_of(node)
        if style.get("display") == "none":
            return None
        value = style.get("visibility")
        visible = value == "visible" if value in ("visible", "hidden", "collapse") else visible
    return visible


def parts_of(node: Node) -> list[Node]:
    """A table's, row group's or row's rows, cells and captions, and what browsers show before the table: a run of
    other children with any text, as one node."""
    parts: list[Node] = []
    run: list = []
    for c in [*node.children, None]:
        if c is not None and (isinstance(c, str) or c.tag not in TABLE_PARTS):
            run.append(c)
            continue
        if any(isinstance(x, Node) or x.strip(" \t\n\r\f") for x in run):
            parts.append(Node("#stray", {}))
            parts[-1].children = run
        run = []
        if c is not None:
            parts.append(c)
    return parts


def cells_of(table: Node, visible: bool) -> tuple[list[list[tuple[Node, bool]] | None], list[tuple[Node, bool]]]:
    """The rows of cells of a table, without those of tables inside it (None where a group of rows begins), and its captions and
    stray content."""
    rows: list[list[tuple[Node, bool]] | None] = []
    other: list[tuple[Node, bool]] = []
    stack: list[tuple[Node, bool, int]] = [(c, visible, 0) for c in reversed(parts_of(table))]
    open_row = False
    while stack:
        node, see, depth = stack.pop()
        if (own := shown(node, see)) is None:
            continue
        if node.tag in ("td", "th"):
            if not open_row:
                rows.append([])
                open_row = True
            rows[-1].append((node, own))
        elif node.tag in ("tr", "thead", "tbody", "tfoot"):
            if node.tag == "tr":
                rows.append([])
                open_row = True
            else:
                rows.append(None)
                open_row = False
            stack += [(c, own, depth + 1) for c in reversed(parts_of(node))]
        else:
            other.append((node, own))
    return rows, other


def layout(children: list, visible: bool) -> list[str]:
    """Lines of some nodes; tables and list items below them are laid out with the stack, not by recursion, but for
    a cell, which is laid out by itself (nested tables deeper than ``DEPTH`` become plain blocks)."""
    return _layout(children, visible, 0)


DEPTH = 20


def _layout(children: list, visible: bool, depth: int) -> list[str]:
    out = Lines()
    stack: list = [(c, visible, False, None) for c in reversed(children)]
    while stack:
        item, see, pre, lists = stack.pop()
        if callable(item):
            item()
            continue
        if isinstance(item, str):
            if see:
                out.add(item, pre)
            continue
        own = shown(item, see)
        if own is None:
            continue
        tag = item.tag
        if tag == "br":
            out.end(empty=True)
        elif tag == "hr":
            out.end()
            if own:
                out.now = "---"
            out.end()
        elif tag == "img":
            if own and item.attributes.get("alt"):
                out.add(item.attributes["alt"])
        elif tag == "input":
            if own and item.attributes.get("value"):
                out.add(item.attributes["value"])
        elif tag == "table" and depth < DEPTH:
            out.end(1)
            out.block(_table(item, own, depth))
            out.end(1)
        elif tag in BLOCK or tag in ("td", "th", "thead", "tbody", "tfoot") or item.foreign and tag == "text":
            gap = 1 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists) else 0
            out.end(gap)
            before = out.indent
            inside = lists
            if tag in ("ul", "ol", "menu", "dir"):
                start = item.attributes.get("start", "1")
                inside = ["ol" if tag == "ol" else "ul", int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0]
            elif tag == "li":
                inside = lists or ["ul", 0]
                inside[1] += 1
                mark = f"{inside[1]}. " if inside[0] == "ol" else "- "
                out.indent += len(mark)
                out.first = mark
            elif tag in ("blockquote", "dd"):
                out.indent += 4

            def leave(before=before, gap=gap, tag=tag) -> None:
                out.end(gap)
                out.indent = before
                if tag == "li":
                    out.first = ""
            stack.append((leave, see, pre, lists))
            stack += [(c, own, pre or tag == "pre", inside) for c in reversed(item.children)]
        else:
            stack += [(c, own, pre or tag in ("textarea", "xmp"), lists) for c in reversed(item.children)]
    return out.text()


def _table(table: Node, visible: bool, depth: int) -> list[str]:
    rows, other = cells_of(table, visible)
    lines: list[str] = []
    for node, see in other:
        lines += _layout([node], see, depth + 1)
    laid, widths = [], {}
    until: dict[int, int] = {}  # the row in which a column is free again from cells of rows before
    for r, row in enumerate(rows):
        if row is None:
            until.clear()
            continue
        cells, column = [], 0
        for node, see in row:
            text = _layout(node.children, see, depth + 1)
            while until.get(column, 0) > r:
                column += 1
            span, down = (min(int(n), 1000) if re.fullmatch(r"\d{1,6}", n) else 1 for n in (node.attributes.get(a, "1") for a in ("colspan", "rowspan")))
            span, down = span or 1, down or len(rows)  # a rowspan of 0 reaches to the end
            if down > 1:
                until |= dict.fromkeys(range(column, column + span), r + down)
            cells.append((column, span, text))
            if span == 1:
                widths[column] = max(widths.get(column, 0), max(map(width, text), default=0))
            column += span
        laid.append(cells)
    starts, at = {}, 0
    for column in sorted({c for row in laid for c, _, _ in row}):
        starts[column] = at
        at += widths.get(column, 0) + 2 if column in widths else 0
    for cells in laid:
        for k in range(max((len(t) for _, _, t in cells), default=0)):
            line = ""
            for column, _, text in cells:
                if k < len(text) and text[k]:
                    line += " " * max(starts[column] - width(line), 2 if line else 0) + text[k]
            lines.append(line)
    return lines


def visible_text(html: str | None) -> str | None:
    return None if html is None else "\n".join(layout(parse(html).children, True)).strip("\n")


def extract(pages: DataFrame) -> DataFrame:
    """page_id and text of each page."""
    small_batches(pages.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [visible_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string())], names=["page_id", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(work, "page_id long, text string")
