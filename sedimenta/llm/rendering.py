"""HTML extraction by layout: a small tree builder and a renderer of visible text.

The builder follows the usual rules for leaving out tags (a new paragraph, list item,
cell, row or option ends the one before; a cell outside of a row opens one; stray end tags
are ignored; what is open at the end is closed) and never recurses, so nesting of any depth
is read. Visibility follows elements that are never shown, the ``hidden`` attribute, inline
``display:none`` and inline ``visibility``, which is inherited and may be undone within;
dialogs show if they are open, objects show their fallback if they name no data, drawings
show their texts. The renderer emits every visible text once: blocks on lines of their own,
paragraphs and headings with an empty line around them, two line breaks as an empty line,
lists with bullets or numbers indented by depth, options one a line, preformatted text as it
is, and tables in aligned columns: a cell is rendered like a page of its own and put into
its columns line by line, spans counted; what wraps rows or cells is transparent.

Work and output are linear in the page. That bounds the layout, never the text: lines are
indented by MAX_INDENT characters at most, cells longer than WIDE do not set their column,
columns from COLUMNS on and tables nested deeper than DEEP are not aligned, and neither is
a table that would take more than four characters of padding for one of text.

Defined cases: null and empty pages give an empty text; a page without tags gives its own
text; unclosed comments and raw elements run to the end of the page; unknown elements are
inline; the content of closed ``details`` is emitted; repeated rows give repeated results;
an empty table gives an empty result; columns other than the id and the markup are not read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from sedimenta.llm.common import map_texts

# Element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
ESCAPABLE = frozenset("textarea title".split())
NEVER_SHOWN = frozenset(
    "head title script style template noscript iframe noembed noframes audio video canvas "
    "datalist meta link base param source track area col colgroup "
    "defs desc metadata symbol annotation annotation-xml".split())
PRE = frozenset("pre listing xmp textarea".split())
SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl pre listing xmp table blockquote figure hr fieldset menu dir".split())
BLOCKS = SPACED | frozenset(
    "html body div section article aside header footer nav main address form li dt dd tr thead tbody tfoot "
    "caption figcaption legend details summary hgroup search center dialog".split())
LINES = BLOCKS | frozenset("textarea select option optgroup".split())
LISTS = frozenset("ul ol menu dir".split())
CELLS = frozenset("td th".split())
SECTIONS = {"thead": 0, "tbody": 1, "tfoot": 2}
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SHOWN_VALUES = frozenset(["", *"button email number reset search submit tel text url".split()])

# A start tag ends these open elements, up to a boundary.
ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset({"li"}), LISTS | CELLS),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"}) | CELLS),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"}) | CELLS),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "td": (CELLS, frozenset({"tr", "table"})),
    "th": (CELLS, frozenset({"tr", "table"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "thead": (frozenset({"thead", "tbody", "tfoot", "caption", "tr"}), frozenset({"table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot", "caption", "tr"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody", "tfoot", "caption", "tr"}), frozenset({"table"})),
    "body": (frozenset({"head"}), frozenset()),
}
SCOPE = frozenset("table td th caption html button object template".split())
FOREIGN = frozenset("svg math".split())
# Elements of drawings and formulas that hold ordinary markup.
ORDINARY_WITHIN = frozenset("foreignobject desc mtext mi mo mn ms annotation-xml".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"[ \t\n\r\f]+")
COLUMN_GAP = 2
MAX_INDENT = 20
WIDE = 40
COLUMNS = 200
DEEP = 8
PADDING = 4


@dataclass(slots=True)
class Node:
    name: str
    start: int = 1
    across: int = 1
    down: int = 1
    shown: bool = True
    visible: bool | None = None
    """What the element says of its visibility; None inherits."""
    wraps: bool = False
    """Holds rows or cells of the table around it."""
    children: list[Node | str] = field(default_factory=list)


def _number(value: str, otherwise: int) -> int:
    return int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else otherwise


def _node(name: str, attributes: str) -> Node:
    given = {}
    for a in ATTRIBUTE.finditer(attributes):
        given.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
    node = Node(name, visible=True if name == "html" else None)
    style = {}
    for declaration in given.get("style", "").split(";"):
        key, _, value = declaration.partition(":")
        style[key.strip().lower()] = (value.lower().split() or [""])[0].partition("!")[0]
    node.shown = style.get("display") != "none" and not ("hidden" in given and "display" not in style)
    if "visibility" in style:
        node.visible = {"visible": True, "hidden": False, "collapse": False}.get(style["visibility"])
    if name == "ol":
        node.start = _number(given.get("start", ""), 1)
    elif name in CELLS:
        node.across = min(max(_number(given.get("colspan", ""), 1), 1), COLUMNS)
        node.down = _number(given.get("rowspan", ""), 1)
        node.down = node.down if node.down > 0 else 1 if node.down < 0 else 65534
    elif name == "dialog":
        node.shown = node.shown and "open" in given
    elif name == "object":
        node.shown = node.shown and "data" not in given
    elif name == "input" and given.get("type", "").lower() in SHOWN_VALUES and given.get("value"):
        node.children.append(html.unescape(given["value"]))
    return node


class Builder:
    def __init__(self):
        self.root = Node("html", visible=True)
        self.open: list[Node] = [self.root]
        self.depths: dict[str, list[int]] = {"html": [0]}

    def enter(self, node: Node) -> None:
        self.open[-1].children.append(node)
        if node.name == "tr" or node.name in CELLS:
            # Mark what lies between the part and its table or row.
            for around in reversed(self.open):
                if around.wraps or around.name in ("table", "tr") or around.name in CELLS:
                    break
                around.wraps = True
        self.depths.setdefault(node.name, []).append(len(self.open))
        self.open.append(node)

    def close(self, depth: int) -> None:
        while len(self.open) > depth:
            self.depths[self.open.pop().name].pop()

    def last(self, names) -> int:
        return max((d[-1] for n in names if (d := self.depths.get(n))), default=0)

    def nearest(self, names, bounds) -> int:
        """The depth of the last open element of these names, 0 if there is none or a bound lies deeper."""
        depth = self.last(names)
        return depth if depth and depth >= self.last(bounds) else 0

    def end_tag(self, name: str) -> None:
        bounds = () if name in TABLE_PARTS else CELLS | {"table"} - {name}
        depth = self.nearest((name,), bounds)
        if depth:
            self.close(depth)
        elif name in ("p", "br"):
            self.open[-1].children.append(Node(name))

    def start_tag(self, name: str, attributes: str) -> Node | None:
        """The new element, entered unless it is void, raw or closes itself."""
        if name in ("html", "body") and self.depths.get(name):
            return None
        foreign = self.nearest(FOREIGN, ORDINARY_WITHIN)
        if foreign and name in BLOCKS:
            self.close(foreign)
            foreign = 0
        if name in BLOCKS and name not in ("html", "body"):
            depth = self.nearest(("p",), SCOPE)
            if depth:
                self.close(depth)
        while name in ENDS and (depth := self.nearest(*ENDS[name])):
            self.close(depth)
        if name in HEADINGS and self.open[-1].name in HEADINGS:
            self.close(len(self.open) - 1)
        if name not in NEVER_SHOWN and self.open[-1].name == "head":
            self.close(len(self.open) - 1)  # the end of head may be left out
        if name in CELLS and self.last(("table",)) > self.last(("tr",)):
            self.enter(Node("tr"))
        node = _node(name, attributes)
        if name in VOID or name in RAW or foreign and attributes.endswith("/"):
            self.open[-1].children.append(node)
        else:
            self.enter(node)
        return node

    def text(self, value: str) -> None:
        if self.open[-1].name == "head" and not value.isspace():
            self.close(len(self.open) - 1)
        self.open[-1].children.append(value)


def parse(markup: str) -> Node:
    tree = Builder()
    at, end = 0, len(markup)
    while at < end:
        lt = markup.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            tree.text(html.unescape(markup[at:lt]))
        if lt == end:
            break
        if markup.startswith("<!--", lt):
            stop = markup.find("-->", lt + 4)
            at = end if stop < 0 else stop + 3
            continue
        if markup.startswith(("<!", "<?"), lt):
            stop = markup.find(">", lt)
            at = end if stop < 0 else stop + 1
            continue
        m = TAG.match(markup, lt)
        if not m:
            if markup[lt + 1: lt + 2].isalpha() or markup[lt + 1: lt + 2] == "/":
                stop = markup.find(">", lt)  # a tag with a stray quote, or an unclosed one
                at = end if stop < 0 else stop + 1
            else:
                tree.text("<")
                at = lt + 1
            continue
        at = m.end()
        name = m[2].lower()
        if m[1]:
            tree.end_tag(name)
            continue
        node = tree.start_tag(name, m[3])
        if name in PRE:  # a line break right after the tag is not content
            at += markup.startswith("\r", at)
            at += markup.startswith("\n", at)
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(markup, at)
            inner = markup[at: stop.start() if stop else end]
            if inner:
                node.children.append(html.unescape(inner) if name in ESCAPABLE else inner)
            gt = markup.find(">", stop.start()) if stop else -1
            at = end if gt < 0 else gt + 1
    return tree.root


class Canvas:
    """Lines of text with collapsed spaces and pending breaks."""

    def __init__(self):
        self.lines: list[str] = []
        self.words: list[str] = []
        self.space = False
        self.blank = False
        self.leads: list[str] = [""]
        self.mark: str | None = None
        self.lists: list[list] = []
        # Characters of text, and of what aligns it.
        self.weight = 0
        self.padding = 0

    def text(self, value: str) -> None:
        parts = SPACE.split(value)
        for i, part in enumerate(parts):
            if i:
                self.space = True
            if part:
                if self.words and self.space:
                    self.words.append(" ")
                self.words.append(part)
                self.weight += len(part)
                self.space = False

    def preformatted(self, value: str) -> None:
        self.weight += len(value)
        for i, row in enumerate(value.split("\n")):
            if i:
                self.line("".join(self.words))
                self.words = []
            if row:
                self.words.append(row)

    def flush(self) -> None:
        self.space = False
        if self.words:
            self.line("".join(self.words))
            self.words = []

    def line(self, value: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        lead = self.leads[-1]
        if self.mark is not None:
            lead = self.leads[-2] + self.mark
            self.mark = None
        self.lines.append((lead + value).rstrip())

    def gap(self) -> None:
        self.flush()
        self.blank = True

    def indent(self, by: str) -> None:
        self.leads.append((self.leads[-1] + by)[:MAX_INDENT])

    def outdent(self) -> None:
        self.flush()
        self.mark = None
        self.leads.pop()

    def result(self) -> list[str]:
        self.flush()
        return self.lines


class Grid:
    """Rows of rendered cells of a table."""

    def __init__(self):
        self.captions: list[str] = []
        self.rows: list[tuple[int, list[tuple[list[str], int, int]]]] = []
        self.section = 1
        self.row: list | None = None
        self.weight = 0
        self.padding = 0

    def open_row(self) -> None:
        self.row = []
        self.rows.append((self.section, self.row))

    def end_row(self) -> None:
        self.row = None

    def leave_section(self) -> None:
        self.section = 1

    def take(self, canvas: Canvas) -> list[str]:
        lines = canvas.result()
        self.weight += canvas.weight
        self.padding += canvas.padding
        return lines

    def add(self, canvas: Canvas, across: int = 1, down: int = 1) -> None:
        """A cell of the open row, or what stands outside of rows as a row of its own."""
        lines = self.take(canvas)
        if self.row is not None:
            self.row.append((lines, across, down))
        elif lines:
            self.rows.append((self.section, [(lines, 1, 1)]))

    def _placed(self) -> list[list[tuple[int, int, list[str]]]]:
        """Per row (column, span, lines), top section first."""
        out, busy, before = [], {}, None
        for at, (section, cells) in enumerate(sorted(self.rows, key=lambda r: r[0])):
            if section != before:
                busy, before = {}, section
            column, row = 0, []
            for lines, across, down in cells:
                while busy.get(column, 0) > at:
                    column += 1
                row.append((column, across, lines))
                if down > 1:
                    for c in range(column, min(column + across, COLUMNS)):
                        busy[c] = at + down
                column += across
            if any(lines for _, _, lines in row):
                out.append(row)
        return out

    def draw(self, canvas: Canvas) -> None:
        rows = self._placed()
        self.weight += COLUMN_GAP * sum(map(len, rows))
        aligned, spent = self._aligned(rows)
        for value in [*self.captions, *(aligned if aligned is not None else self._plain(rows))]:
            canvas.line(value)
        canvas.weight += self.weight
        canvas.padding += self.padding + spent

    def _aligned(self, rows) -> tuple[list[str] | None, int]:
        widths: dict[int, int] = {}
        for row in rows:
            if len(row) == 1 and row[0][0] == 0:
                continue  # a lone cell does not set the columns
            for column, across, lines in row:
                if column < COLUMNS:
                    least = widths.setdefault(column, 0)
                    if across == 1:
                        widths[column] = max(least, max((len(x) for x in lines if len(x) <= WIDE), default=0))
        for row in rows:
            for column, across, lines in row:
                if across > 1 and column in widths:
                    columns = [c for c in range(column, min(column + across, COLUMNS)) if c in widths]
                    held = sum(widths[c] + COLUMN_GAP for c in columns if widths[c]) - COLUMN_GAP
                    widths[columns[-1]] += max(0, max((len(x) for x in lines if len(x) <= WIDE), default=0) - max(held, 0))
        offsets, x = {}, 0
        for column in sorted(widths):
            offsets[column] = x
            if widths[column]:
                x += widths[column] + COLUMN_GAP
        out, spent, most = [], 0, PADDING * self.weight - self.padding
        for row in rows:
            made: list[list[str]] = [[] for _ in range(max(len(lines) for _, _, lines in row))]
            ends = [0] * len(made)
            for column, _, lines in row:
                for i, value in enumerate(lines):
                    if value:
                        pad = max(offsets.get(column, 0) - ends[i], COLUMN_GAP if ends[i] else 0)
                        spent += pad
                        if spent > most:
                            return None, 0
                        made[i].append(" " * pad + value)
                        ends[i] += pad + len(value)
            out.extend(map("".join, made))
        return out, spent

    def _plain(self, rows):
        for row in rows:
            if all(len(lines) < 2 for _, _, lines in row):
                yield (" " * COLUMN_GAP).join(lines[0] for _, _, lines in row if lines)
            else:
                for _, _, lines in row:
                    yield from lines


def render(root: Node) -> str:
    page = Canvas()
    frames: list[Canvas | Grid] = [page]
    grids = 0
    # A task is (node, preformatted, visible, muted), or a function to call when its children are done.
    todo: list = [(root, False, True, False)]

    def within(canvas: Canvas, done) -> None:
        """Draws what follows on a canvas of its own, and hands that on."""
        frames.append(canvas)
        todo.append(lambda: (frames.pop(), done(canvas)))

    while todo:
        item = todo.pop()
        if callable(item):
            item()
            continue
        node, pre, visible, muted = item
        top = frames[-1]
        if isinstance(node, str):
            if not visible or muted:
                continue
            if isinstance(top, Grid):
                if not node.isspace():
                    loose = Canvas()
                    loose.text(node)
                    top.add(loose)
            elif pre:
                top.preformatted(node)
            else:
                top.text(node)
            continue
        name = node.name
        if not node.shown or name in NEVER_SHOWN:
            continue
        if node.visible is not None:
            visible = node.visible
        if name == "svg":
            muted = True
        elif name in ("text", "foreignobject"):
            muted = False
        inner = [(child, pre or name in PRE, visible, muted) for child in reversed(node.children)]
        if isinstance(top, Grid):
            if name in SECTIONS:
                top.section = SECTIONS[name]
                todo.append(top.leave_section)
            elif name == "tr":
                top.open_row()
                todo.append(top.end_row)
            elif name == "caption":
                within(Canvas(), lambda c, g=top: g.captions.extend(g.take(c)))
            elif name in CELLS and top.row is not None:
                within(Canvas(), lambda c, g=top, n=node: g.add(c, n.across, n.down))
            elif not node.wraps:
                within(Canvas(), top.add)
                inner = [item]
            todo.extend(inner)
            continue
        if name == "br":
            if top.words:
                top.flush()
            elif top.mark is None:
                top.blank = True
            continue
        spaced = name in SPACED and not (name in LISTS and top.lists)
        if spaced:
            top.gap()
            todo.append(top.gap)
        elif name in LINES:
            top.flush()
            todo.append(top.flush)
        elif name in CELLS or name == "text":
            top.space = True
            todo.append(lambda c=top: setattr(c, "space", True))
        if name == "table" and grids < DEEP:
            grids += 1
            grid = Grid()
            frames.append(grid)

            def drawn(canvas=top, grid=grid):
                nonlocal grids
                grids -= 1
                frames.pop()
                grid.draw(canvas)

            todo.append(drawn)
        elif name in LISTS:
            top.lists.append([name, node.start - 1])
            todo.append(top.lists.pop)
        elif name == "li":
            kind = top.lists[-1] if top.lists else ["ul", 0]
            kind[1] += 1
            mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
            top.indent(" " * len(mark))
            top.mark = mark if visible else None
            todo.append(top.outdent)
        elif name in ("dd", "blockquote"):
            top.indent("  ")
            todo.append(top.outdent)
        todo.extend(inner)
    return "\n".join(page.result()).strip("\n")


def extract(markup: str | None) -> str:
    return render(parse(markup)) if markup else ""


def render_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: id, text, n_chars, n_lines."""

    def start():
        def work(texts):
            found = [extract(t) for t in texts]
            return [found, [len(t) for t in found], [t.count("\n") + 1 if t else 0 for t in found]]

        return work

    return map_texts(pages, [id_col], html_col,
                     [("text", "string"), ("n_chars", "long"), ("n_lines", "long")], start)
