"""Operator 9, visible text of web pages by layout-aware rendering.

A tree builder closes what HTML lets authors leave open (paragraphs, list items, table parts, the head) and ignores
stray end tags; visibility rules drop what a browser does not show; the renderer then lays out what is left: blocks
on lines of their own, a blank line around paragraphs and headings, list markers with indents, table cells aligned
in columns, preformatted text as it is. Labels of SVG and the text of MathML are inline text. Neither builder nor renderer recurses, so depth is not bounded by a stack.

Time and output are in proportion to the page. The builder looks open elements up by name; indents stop at INDENT
characters; in a table, a cell wider than CELL does not widen its column, no gap in a row is wider than GAP, and tables
nested more than TABLES deep are set as blocks.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right

from pyspark.sql import DataFrame

from .common import map_texts

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=|\"|')*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
SPACE = re.compile(r"[ \t\n\r\f]+")
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.IGNORECASE)
#: The widest indent, cell and gap that a line is padded for, and the deepest table that is set in columns.
INDENT, CELL, GAP, TABLES = 60, 60, 120, 12
#: The largest numbers of columns and rows that a cell spans.
COLUMN_SPAN, ROW_SPAN = 1000, 65_534
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|initial|hidden|collapse)", re.IGNORECASE)

# Element groups of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template noscript title meta link base datalist iframe noembed noframes object audio video canvas "
    "area param source track col colgroup rp".split()
)
FOREIGN = frozenset(["svg", "math"])
FOREIGN_UNSEEN = frozenset(
    "defs symbol clippath mask pattern marker filter lineargradient radialgradient desc metadata annotation annotation-xml".split()
)
#: Elements of SVG and MathML whose content is HTML, and HTML elements that end SVG and MathML.
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Elements of SVG and MathML whose text, or whose children, stand apart.
APART, PARTS_APART = frozenset(["text", "mtd"]), frozenset(["mfrac", "mroot"])
ROWS = frozenset("tr tbody thead tfoot".split())
HEAD_ONLY = frozenset("base link meta title style script template noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table ul caption optgroup option xmp".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure hr xmp".split())
CLOSES_P = BLOCK - frozenset("body html caption legend li dd dt option optgroup".split())
# What a start tag ends where it is still open, and the elements beyond which it does not look.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table td th".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "dd": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset("tbody thead tfoot table".split())),
} | {x: (frozenset("tbody thead tfoot tr td th caption colgroup".split()), frozenset(["table"])) for x in ("tbody", "thead", "tfoot")}
P_SCOPE = frozenset("td th caption table button html object".split())
END_SCOPE = frozenset("td th caption table html".split())
LISTS = frozenset("ul ol menu dir".split())
# End of the fixed values.


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        if name not in self.attributes.lower():
            return None
        for m in ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return entities.unescape(m[2] or m[3] or m[4] or "")
        return None

    def hidden(self) -> bool:
        if self.tag in UNSEEN:
            return True
        if not self.attributes:
            return self.tag == "dialog"
        said = DISPLAY.findall(self.attribute("style") or "")
        if said:  # the last one holds, also against `hidden` and a closed dialog
            return said[-1].lower() == "none"
        return bool(
            self.attribute("hidden") is not None or self.tag == "dialog" and self.attribute("open") is None
            or self.tag == "input" and (self.attribute("type") or "").lower() in ("hidden", "checkbox", "radio", "password", "file")
        )

    def foreign_hidden(self) -> bool:
        """Whether an element of SVG or MathML hides what it holds."""
        return self.tag in FOREIGN_UNSEEN or (self.attribute("display") or "").strip().lower() == "none"

    def number(self, name: str) -> int | None:
        """A whole number that an attribute gives."""
        found = re.match(r"\s*([+-]?[0-9]{1,9})", self.attribute(name) or "")
        return int(found[1]) if found else None

    def shown(self) -> list:
        """The children; of closed details, the summary only."""
        if self.tag != "details" or self.attribute("open") is not None:
            return self.children
        return [x for x in self.children if isinstance(x, Node) and x.tag == "summary"][:1]

    def visibility(self, mode: str) -> str | None:
        """What the element says of its visibility, which is inherited where it says nothing."""
        if self.tag == "mphantom" and mode == "math":
            return "hidden"
        if "visibility" not in self.attributes.lower():
            return None
        said = VISIBILITY.findall(self.attribute("style") or "")
        if not said and mode in ("svg", "label"):
            said = VISIBILITY.findall(f"visibility:{self.attribute('visibility') or ''}")
        return said[-1].lower() if said else None


class Builder:
    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # where the open elements of a name are, but for the root
        self.marks: list[int] = []  # where elements are that begin or end SVG and MathML

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        if node.tag in FOREIGN or node.tag in INTEGRATION:
            self.marks.append(len(self.open))
        self.open.append(node)

    def pop_to(self, at: int) -> None:
        for node in self.open[at:]:
            self.places[node.tag].pop()
        while self.marks and self.marks[-1] >= at:
            self.marks.pop()
        del self.open[at:]

    def last(self, tags: frozenset) -> int:
        """The place of the innermost open element of `tags`, or 0."""
        return max((self.places[x][-1] for x in tags if self.places.get(x)), default=0)

    def end(self, tags: frozenset, stop: frozenset) -> None:
        """Ends the outermost open element of `tags` within the nearest element of `stop`."""
        if not self.last(tags):
            return
        bound, found = self.last(stop), []
        for tag in tags:
            own = self.places.get(tag, [])
            at = bisect_right(own, bound)
            found += own[at : at + 1]
        if found:
            self.pop_to(min(found))

    def foreign(self) -> int:
        """The place of the open svg or math element, if what comes next is not HTML, or else 0."""
        return self.marks[-1] if self.marks and self.open[self.marks[-1]].tag in FOREIGN else 0

    def start(self, tag: str, attributes: str, closed: bool) -> None:
        while (at := self.foreign()) and tag in BREAKOUT:
            self.pop_to(at)
        if at:
            node = Node(tag, attributes)
            self.open[-1].children.append(node)
            if not closed:
                self.push(node)
            return
        if tag in ("html", "body"):
            if tag == "body":
                self.end(frozenset(["head"]), frozenset())
            target = self.root if tag == "html" else self.open[self.places[tag][0]] if self.places.get(tag) else None
            if target:
                target.attributes = target.attributes or attributes
                return
        if self.places.get("head") and self.open[-1].tag == "head" and tag not in HEAD_ONLY:
            self.end(frozenset(["head"]), frozenset())
        if tag in CLOSES_P:
            self.end(frozenset(["p"]), P_SCOPE)
        if tag in ENDS:
            self.end(*ENDS[tag])
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        if tag not in VOID and not (closed and tag in FOREIGN):
            self.push(node)

    def finish(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br"))
        if not self.places.get(tag) or tag in ("html", "body"):
            return
        stop = END_SCOPE if tag not in END_SCOPE and tag not in ("tr", "tbody", "thead", "tfoot") else frozenset(["table"])
        at = self.places[tag][-1]
        if at >= self.last(stop):
            self.pop_to(at)

    def text(self, text: str) -> None:
        if self.open[-1].tag == "head":
            if not text.strip():
                return
            self.end(frozenset(["head"]), frozenset())
        self.open[-1].children.append(text)


def build(page: str) -> Node:
    builder, at, size = Builder(), 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        stop = m.start() if m else size
        if stop > at:
            builder.text(entities.unescape(page[at:stop]))
        if not m:
            break
        at = m.end()
        if page.startswith("<![CDATA[", stop) and builder.foreign():
            close = page.find("]]>", stop)
            builder.text(page[stop + 9 : close if close >= 0 else size])
            at = close + 3 if close >= 0 else size
        elif m[1]:
            builder.finish(m[1].lower())
        elif m[2]:
            tag = m[2].lower()
            raw_text = tag in RAW and not builder.foreign()
            builder.start(tag, m[3], m[3].endswith("/"))
            if raw_text:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                raw = page[at : close.start() if close else size]
                if tag in ("textarea", "xmp"):
                    builder.text(entities.unescape(raw) if tag == "textarea" else raw)
                at = close.end() if close else size
                builder.finish(tag)
    return builder.root


class Flow:
    """Lines under construction: collapses white space, and keeps blank lines between spaced blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = False
        self.blank = False
        self.broken = False
        self.indent = 0
        self.marker = ""

    def text(self, text: str) -> None:
        if text[0] in " \t\n\r\f" and self.parts:
            self.gap = True
        words = SPACE.sub(" ", text).strip(" ")
        if not words:
            return
        if self.gap:
            self.parts.append(" ")
        self.parts.append(words)
        self.gap = text[-1] in " \t\n\r\f"

    def put(self, line: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        self.broken = False
        lead = " " * min(self.indent - len(self.marker), INDENT) + self.marker
        self.marker = ""
        self.lines.append(lead + line if line else "")

    def line(self) -> None:
        if self.parts:
            self.put("".join(self.parts))
            self.parts = []
        self.gap = False

    def break_line(self) -> None:
        """Ends the line; a second break leaves an empty one."""
        if self.parts:
            self.line()
            self.broken = True
        elif self.broken:
            self.lines.append("")

    def block(self, spaced: bool) -> None:
        self.line()
        self.broken = False
        self.blank = self.blank or spaced


class Grid:
    """A table's cells by row and column, as their spans place them."""

    def __init__(self):
        self.rows: list[list[tuple[int, int, str]]] = []  # column, the columns it spans, text
        self.held: dict[int, int] = {}  # by column, the row from which it is free again
        self.column = 0

    def row(self) -> None:
        self.rows.append([])
        self.column = 0
        if len(self.rows) % 64 == 0:
            self.held = {c: free for c, free in self.held.items() if free >= len(self.rows)}

    def cell(self, text: str, across: int, down: int) -> None:
        if not self.rows:
            self.row()
        here = len(self.rows) - 1
        while self.held.get(self.column, 0) > here:
            self.column += 1
        across = min(max(across, 1), COLUMN_SPAN)
        if down > 1:
            for c in range(self.column, self.column + across):
                self.held[c] = max(self.held.get(c, 0), here + min(down, ROW_SPAN))
        self.rows[-1].append((self.column, across, text))
        self.column += across

    def lines(self) -> list[str]:
        """Rows as lines. A column is as wide as the widest line of a cell that ends in it and has one after it; cells
        wider than CELL do not count, and what follows them is two spaces on."""
        starts = sorted({c for row in self.rows for c, _, _ in row})
        widths = dict.fromkeys(starts, 0)
        split = [[(c, across, text.split("\n")) for c, across, text in row] for row in self.rows]
        for row in split:
            for c, across, cell in row[:-1]:
                width = max(map(len, cell))
                if across == 1 and width <= CELL:
                    widths[c] = max(widths[c], width)
        left, at = {}, 0
        for c in starts:
            left[c] = at
            at += widths[c] + 2
        lines = []
        for row in split:
            for k in range(max((len(cell) for _, _, cell in row), default=0)):
                parts, at = [], 0
                for c, _, cell in row:
                    text = cell[k] if k < len(cell) else ""
                    if not text:
                        continue
                    gap = left[c] - at
                    parts.append(" " * (gap if 0 <= gap <= GAP and (not parts or gap >= 2) else 2 if parts else 0) + text)
                    at = max(at, left[c]) + len(text)
                lines.append("".join(parts).rstrip())
        return lines


def render(root: Node) -> str:
    flow, flows, tables, lists = Flow(), [], [], []
    pre, indents = 0, []
    # whether text is visible, and what text is: of "html", "math", an "svg" (no text) or a "label" in one
    stack: list[tuple] = [(root, False, True, "html")]
    while stack:
        node, leaving, visible, mode = stack.pop()
        if isinstance(node, str):
            if not visible or mode == "svg":
                continue
            if pre:
                for k, line in enumerate(node.split("\n")):
                    if k:
                        flow.put("".join(flow.parts))
                        flow.parts = []
                    if line:
                        flow.parts.append(line)
            elif node:
                flow.text(node)
            continue
        tag = node.tag
        if not leaving:
            if node.hidden() or mode != "html" and node.foreign_hidden():
                continue
            if node.attributes or mode == "math":
                said = node.visibility("svg" if tag == "svg" else mode)
                if said == "collapse" and tag in ROWS:
                    continue
                visible = visible if said is None else said in ("visible", "initial")
            if tag in FOREIGN and mode != "label":
                mode = tag
            elif mode == "svg" and tag == "text":
                mode = "label"
            elif mode in ("svg", "label") and tag == "foreignobject":
                mode = "html"
            if mode != "html":
                children = node.children
                if tag in PARTS_APART:
                    children = [x for child in children for x in (" ", child)] + [" "]
                elif tag in APART:
                    children = [" ", *children, " "]
                stack.extend((x, False, visible, mode) for x in reversed(children))
                continue
            if tag == "br":
                flow.break_line()
                continue
            if tag == "input":
                if visible:
                    flow.text(node.attribute("value") or node.attribute("placeholder") or " ")
                continue
            if tag in BLOCK:
                flow.block(tag in SPACED and not (tag in LISTS and lists))
            if tag in LISTS:
                step = -1 if tag == "ol" and node.attribute("reversed") is not None else 1
                first = node.number("start")
                if first is None:
                    first = 1 if step > 0 else sum(isinstance(x, Node) and x.tag == "li" for x in node.children)
                lists.append([tag, first, step])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 0, 1]
                if node.attributes and kind[0] == "ol" and node.number("value") is not None:
                    kind[1] = node.number("value")
                marker = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += kind[2]
                indents.append(len(marker))
                flow.indent += len(marker)
                flow.marker = marker if visible else ""
            elif tag == "table":
                tables.append(Grid() if len(tables) < TABLES else None)
            elif tag == "tr" and tables:
                if tables[-1]:
                    tables[-1].row()
                else:
                    flow.block(False)
            elif tag in ("td", "th") and tables:
                if tables[-1]:
                    flows.append(flow)
                    flow = Flow()
                else:
                    flow.block(False)
            elif tag in ("pre", "xmp"):
                pre += 1
            elif tag == "blockquote" or tag == "dd":
                flow.indent += 2
            if node.children or tag in BLOCK or tag in ("tr", "td", "th"):
                stack.append((node, True, visible, mode))
                stack.extend((x, False, visible, mode) for x in reversed(node.shown()))
            continue
        if tag in ("td", "th") and tables and tables[-1]:
            flow.line()
            cell, flow = "\n".join(flow.lines), flows.pop()
            tables[-1].cell(cell, node.number("colspan") or 1, node.number("rowspan") or 1)
        elif tag == "tr" and tables and tables[-1] and not visible:
            if tables[-1].rows and not any(text for _, _, text in tables[-1].rows[-1]):
                tables[-1].rows.pop()
        elif tag == "table":
            flow.line()
            grid = tables.pop()
            for line in grid.lines() if grid else ():
                flow.put(line)
        if tag in BLOCK:
            flow.block(tag in SPACED and not (tag in LISTS and len(lists) > 1))
        if tag in LISTS:
            lists.pop()
        elif tag == "li":
            flow.marker = ""
            flow.indent -= indents.pop()
        elif tag in ("pre", "xmp"):
            pre -= 1
        elif tag == "blockquote" or tag == "dd":
            flow.indent -= 2
    flow.line()
    while flow.lines and not flow.lines[-1]:
        flow.lines.pop()
    return "\n".join(flow.lines)


def visible_text(page: str) -> str:
    return render(build(page))


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The visible text of every whole page, one row per input row.

    Columns: the id, text, n_chars and n_lines. Null and empty pages have an empty text; broken markup is read as
    far as it goes (an unclosed tag or comment reaches to the end of the page); null and repeated ids stay rows of
    their own; other columns are not read, so their names can't clash.
    """

    def prepare():
        def work(pages: list[str]) -> dict:
            texts = [visible_text(x) for x in pages]
            return {"text": texts, "n_chars": [len(x) for x in texts], "n_lines": [x.count("\n") + 1 if x else 0 for x in texts]}

        return work

    return map_texts(pages, id_col, html_col, "text string, n_chars long, n_lines long", prepare)
