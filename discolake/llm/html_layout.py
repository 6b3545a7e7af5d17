"""Visible text of HTML as a browser lays it out: blocks, lists, aligned tables.

A tokenizer that takes any bytes of markup feeds a tree builder, which closes what
a start tag implies (the head, paragraphs, list items, rows, cells) and adds rows that are missing.  A
renderer walks the tree, leaves out what is not shown, and writes lines.

Not shown: the head, scripts, styles, templates, comments; elements with the hidden attribute, with
display:none or, until a child turns it back, visibility:hidden; closed dialogs, and
closed details but their summary.  These two properties are taken from style attributes and from the
rules of style elements whose selectors are a tag, classes, an id, or these together; rules
with other selectors or within at-rules are passed over.  Scripts do not run, so noscript is shown.

A null page has a null text; an empty one, or one without visible text, has ''.  An open
tag or comment at the end of a cut page ends there.  Nesting may be of any depth.  Repeated rows are
rendered one by one; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.llm.batches import slices
from discolake.llm.tables import in_batches

# Fixed values of HTML: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template title meta link base iframe noembed noframes object audio video"
    " canvas datalist param rp source track".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p"
    " pre search section summary table caption ul".split()
)
#: Blocks with an empty line before and after them.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl blockquote pre figure hr table".split())
LISTS = frozenset("ul ol menu dir".split())
ENDS_PARAGRAPH = BLOCKS - {"body", "html", "option", "optgroup", "caption", "legend"}
SECTIONS = frozenset("thead tbody tfoot".split())
#: For a start tag: the open elements that it closes, and those it does not look beyond.
CLOSES = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, {"body"}),
}
#: Start tags that an open head keeps; any other closes it.
HEAD_HOLDS = frozenset("head html base link meta title style script noscript noframes template".split())
#: End tags do not reach out of these.
SCOPES = frozenset("table td th caption html template".split())
#: Their end tags close no block: a block that began inside goes on.
FORMATTING = frozenset("a b big code em font i nobr s small span strike strong sub sup tt u".split())

#: Parts of an attribute: its name, and after '=' its value.  A quote opens a run only there.
_NAME = r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+"
_EQUALS = r"[ \t\n\f\r]*+=[ \t\n\f\r]*+"
_VALUE = r"\"[^\"]*\"|'[^']*'|[^ \t\n\f\r>\"'][^ \t\n\f\r>]*+"
# Where a CDATA section ends depends on the open elements, so only its start is matched.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|(<!\[CDATA\[)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)((?:[ \t\n\f\r/]++|{_NAME}(?:{_EQUALS}(?:{_VALUE})?+)?+)*+)>"
    r"|</?[a-zA-Z].*|</[^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(rf"({_NAME})(?:{_EQUALS}({_VALUE})?+)?+")
SELF_CLOSED = re.compile(r"(?:\A|[ \t\n\f\r/\"'])/\Z")
#: Their content is not HTML: CDATA sections are text in it, until an element that only HTML has, or
#: one of INTEGRATION, brings HTML back.
FOREIGN = frozenset("svg math".split())
INTEGRATION = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
HTML_ONLY = BLOCKS | FORMATTING - {"a"}
#: Formatting does not end beyond these.
BOUNDS = SCOPES | BLOCKS
BLANKS = re.compile(r"[ \t\n\f\r]+")
#: A column of a table is padded to so many characters at most; longer cells stand out.
MOST_PADDING = 120
COLUMN_GAP = "  "
MOST_SPAN = 1000


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []


def attributes_of(text: str) -> dict[str, str]:
    if not text or text.isspace() or text == "/":
        return {}
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        if value[:1] in ('"', "'"):
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


class Tree:
    """Builds the tree; open elements are kept on a stack, with their places by tag.

    With the places an end is found without a walk down the stack, so a page takes time in
    proportion to its length, however deep its elements are.
    """

    def __init__(self, page: str):
        self.root = Node("html", {})
        self.open = [self.root]
        self.at: dict[str, list[int]] = {"html": [0]}
        self.blocks, self.scopes = [0], [0]  # places of blocks and scopes, and of scopes
        self.styles: list[str] = []
        at, end = 0, len(page)
        while at < end:
            found = TOKEN.search(page, at)
            if found is None:
                self.text(page[at:])
                break
            if found.start() > at:
                self.text(page[at : found.start()])
            at = found.end()
            if found[1]:
                at = self.cdata(page, at)
                continue
            tag = (found[3] or "").lower()
            if not tag:
                continue
            if found[2]:
                self.end(tag)
                continue
            self.start(tag, attributes_of(found[4]))
            if tag in FOREIGN and SELF_CLOSED.search(found[4]):
                self.pop()
            if tag in RAW and self.open[-1].tag == tag:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                stop = close.start() if close else end
                if tag == "textarea":
                    self.text(page[at:stop])
                elif tag == "style":
                    self.styles.append(page[at:stop])
                self.pop()
                at = close.end() if close else end

    def text(self, text: str) -> None:
        if text:
            text = unescape(text) if "&" in text else text
            if self.open[-1].tag in ("head", "noscript") and text.strip(" \t\n\f\r"):
                self.leave_head()
            self.open[-1].children.append(text)

    def innermost(self, tags: Iterable[str], below: int | None = None) -> int:
        """The place of the innermost open element of tags, under a place; -1 if there is none."""
        found = -1
        for tag in tags:
            places = self.at.get(tag)
            if places:
                last = len(places) if below is None else bisect_left(places, below)
                if last and places[last - 1] > found:
                    found = places[last - 1]
        return found

    def foreign(self) -> bool:
        """Whether the innermost open element is one of SVG or MathML."""
        place = self.innermost(FOREIGN)
        if place < 0:
            return False
        return place > max(self.innermost(HTML_ONLY), self.innermost(INTEGRATION, len(self.open) - 1))

    def cdata(self, page: str, at: int) -> int:
        """The end of a CDATA section: text in SVG and MathML, else a comment up to the first '>'."""
        foreign = self.foreign()
        mark = "]]>" if foreign else ">"
        stop = page.find(mark, at)
        if stop < 0:
            stop, mark = len(page), ""
        if foreign and stop > at:
            self.open[-1].children.append(page[at:stop])
        return stop + len(mark)

    def push(self, tag: str, attributes: dict[str, str]) -> None:
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        if tag not in VOID:
            place = len(self.open)
            self.open.append(node)
            self.at.setdefault(tag, []).append(place)
            if tag in BOUNDS:
                self.blocks.append(place)
                if tag in SCOPES:
                    self.scopes.append(place)

    def pop(self) -> None:
        tag = self.open.pop().tag
        self.at[tag].pop()
        if tag in BOUNDS:
            self.blocks.pop()
            if tag in SCOPES:
                self.scopes.pop()

    def close(self, tags: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        """Close up to the outermost open element of tags that lies within until."""
        if not any(self.at.get(t) for t in tags):
            return
        scope = max(self.innermost(until), 0)
        cut = None
        for tag in tags:
            places = self.at.get(tag)
            if places and places[-1] > scope:
                place = places[bisect_right(places, scope)]
                cut = place if cut is None else min(cut, place)
        while cut is not None and len(self.open) > cut:
            self.pop()

    def leave_head(self) -> None:
        """Close the head if it, or a noscript in it, is the innermost open element."""
        if not self.at.get("head"):
            return
        at = len(self.open) - 1
        while self.open[at].tag == "noscript":
            at -= 1
        if self.open[at].tag == "head":
            while len(self.open) > at:
                self.pop()

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body") and self.at.get(tag):
            node = self.open[self.at[tag][0]]
            node.attributes = {**attributes, **node.attributes}
            return
        if tag in ENDS_PARAGRAPH and self.at.get("p"):
            self.close({"p"}, SCOPES | {"button"})
        if tag == "head" and self.at.get("head"):
            return
        if tag not in HEAD_HOLDS:
            self.leave_head()
        if tag in CLOSES:
            self.close(*CLOSES[tag])
        if tag in ("td", "th") and self.at.get("table") and self.open[-1].tag != "tr":
            self.push("tr", {})
        self.push(tag, attributes)

    def end(self, tag: str) -> None:
        places = self.at.get(tag)
        if not places or not places[-1]:
            return
        if tag in FORMATTING:
            bound = self.blocks[-1]
        elif tag in SCOPES or tag in SECTIONS or tag == "tr":
            bound = 0
        else:
            bound = self.scopes[-1]
        if bound <= places[-1]:
            cut = places[-1]
            while len(self.open) > cut:
                self.pop()


COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
SELECTOR = re.compile(r"(\*|[a-z][a-z0-9-]*)?((?:[.#][\w-]+)*)\Z", re.I)
#: What counts more: !important, then the style attribute, ids, classes, tags, and the place of the rule.
Rank = tuple[bool, int, int, int, int, int]


def declared(text: str) -> list[tuple[str, str, bool]]:
    """display and visibility as a style declares them: property, value, whether important."""
    found = []
    for part in text.split(";"):
        name, colon, value = part.partition(":")
        name = name.strip().lower()
        if colon and name in ("display", "visibility"):
            value, mark, _ = value.partition("!")
            found.append((name, value.strip().lower(), bool(mark)))
    return found


def rules_of(text: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations; rules within at-rules, which may not apply, are passed over."""
    text, at, depth, start = COMMENT.sub(" ", text), 0, 0, 0
    for found in re.finditer(r"[{};]", text):
        sign = found[0]
        if sign == "{":
            depth += 1
            if depth == 1:
                at = found.start()
        elif sign == "}":
            depth = max(0, depth - 1)
            if not depth:
                selector = text[start:at].strip()
                if at >= start and selector and selector[0] != "@":
                    yield selector, text[at + 1 : found.start()]
                start = found.end()
        elif not depth:
            start = found.end()


class Sheet:
    """The rules of a page's style elements with simple selectors, by tag, class or id."""

    def __init__(self, styles: list[str]):
        self.rules: dict[str, list[tuple]] = {}
        place = 0
        for text in styles:
            for selectors, body in rules_of(text):
                values = declared(body)
                for selector in selectors.split(",") if values else ():
                    found = SELECTOR.match(selector.strip())
                    if not found or not found[0]:
                        continue
                    tag = (found[1] or "*").lower()
                    names = re.findall(r"[.#][\w-]+", found[2])
                    ids = [n for n in names if n[0] == "#"]
                    place += 1
                    rank = (len(ids), len(names) - len(ids), int(tag != "*"), place)
                    key = ids[0] if ids else names[0] if names else tag
                    self.rules.setdefault(key, []).append((tag, frozenset(names), rank, values))

    def values(self, node: Node) -> dict[str, str]:
        """display and visibility of an element, as far as they are declared."""
        best: dict[str, tuple[Rank, str]] = {}
        if self.rules:
            names = {f".{name}" for name in node.attributes.get("class", "").split()}
            if node.attributes.get("id"):
                names.add(f"#{node.attributes['id']}")
            for key in ("*", node.tag, *names):
                for tag, needed, rank, values in self.rules.get(key, ()):
                    if tag in ("*", node.tag) and needed <= names:
                        for name, value, important in values:
                            one = ((important, 0, *rank), value)
                            if name not in best or one[0] >= best[name][0]:
                                best[name] = one
        for name, value, important in declared(node.attributes.get("style", "")):
            one = ((important, 1, 0, 0, 0, 0), value)
            if name not in best or one[0] >= best[name][0]:
                best[name] = one
        return {name: value for name, (_, value) in best.items()}


class Flow:
    """Lines of one block of text: the page, or a cell of a table."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # white space waits before the next word
        self.gap = 0  # 2: an empty line comes before the next one
        self.indent = 0
        self.mark = ""

    def begin(self) -> None:
        if self.line:
            return
        if self.gap == 2 and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = 0
        self.line.append(" " * (self.indent - len(self.mark)) + self.mark)
        self.mark = ""

    def words(self, text: str) -> None:
        text = BLANKS.sub(" ", text)
        core = text.strip(" ")
        if not core:
            self.blank = self.blank or bool(text)
            return
        if self.line and (self.blank or text[0] == " "):
            self.line.append(" ")
        self.begin()
        self.line.append(core)
        self.blank = text[-1] == " "

    def kept(self, text: str) -> None:
        """Text whose white space counts."""
        for i, line in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if i:
                self.turn()
            if line:
                self.begin()
                self.line.append(line)

    def turn(self) -> None:
        """A line break within a block; a second one leaves an empty line."""
        if self.line:
            self.finish_line()
        elif self.lines and not self.gap:
            self.lines.append("")

    def finish_line(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.blank = False

    def block(self, gap: int) -> None:
        self.finish_line()
        self.gap = max(self.gap, gap)

    def put(self, lines: list[str]) -> None:
        for line in lines:
            self.finish_line()
            self.begin()
            self.line.append(line)
        self.finish_line()

    def done(self) -> list[str]:
        self.finish_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Table:
    """Rows of cells; a cell is its first column, its span and its lines."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.column = 0
        self.taken: dict[int, int] = {}  # column -> rows that a cell from above still covers

    def row(self) -> None:
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1} if self.rows else {}
        self.rows.append([])
        self.column = 0

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        if not self.rows:
            self.row()
        while self.taken.get(self.column):
            self.column += 1
        self.rows[-1].append((self.column, columns, lines))
        if rows > 1:
            # The row itself counts, and is taken off when the next one begins.
            self.taken.update({c: rows for c in range(self.column, self.column + columns)})
        self.column += columns

    def laid_out(self) -> list[str]:
        widths: dict[int, int] = {}
        for row in self.rows:
            for column, span, lines in row:
                if span == 1:
                    width = max(map(len, lines), default=0)
                    widths[column] = max(widths.get(column, 0), min(width, MOST_PADDING))
        for row in self.rows:
            for column, span, lines in row:
                if span > 1:
                    inner = [widths.get(c, 0) for c in range(column, column + span)]
                    room = sum(inner) + len(COLUMN_GAP) * max(0, sum(map(bool, inner)) - 1)
                    more = min(max(map(len, lines), default=0), MOST_PADDING) - room
                    if more > 0:
                        end = column + span - 1
                        widths[end] = widths.get(end, 0) + more
        starts, total = {}, 0
        last = max((c + s for row in self.rows for c, s, _ in row), default=0)
        for column in range(last):
            starts[column] = total
            if widths.get(column):
                total += widths[column] + len(COLUMN_GAP)
        out = []
        for row in self.rows:
            for i in range(max((len(lines) for *_, lines in row), default=0)):
                parts, at = [], 0
                for column, _, lines in row:
                    if i < len(lines) and lines[i]:
                        pad = max(starts[column] - at, len(COLUMN_GAP) if at else 0)
                        parts.append(" " * pad + lines[i])
                        at += pad + len(lines[i])
                out.append("".join(parts))
        return [line for line in out if line]


def span(node: Node, name: str) -> int:
    """Columns or rows of a cell; a rowspan of 0 goes on to the end of the table."""
    value = node.attributes.get(name, "1").strip()
    if name == "rowspan" and value == "0":
        return MOST_SPAN
    return min(max(1, int(value)), MOST_SPAN) if value.isascii() and value.isdigit() else 1


def shown(node: Node, parent: Node | None, seen: bool, sheet: Sheet) -> tuple[bool, bool]:
    """Whether the element is laid out at all, and whether its text is seen."""
    if node.tag in UNSEEN or "hidden" in node.attributes:
        return False, False
    if node.tag == "dialog" and "open" not in node.attributes:
        return False, False
    if parent is not None and parent.tag == "details" and "open" not in parent.attributes and node.tag != "summary":
        return False, False
    if sheet.rules or "style" in node.attributes:
        values = sheet.values(node)
        if values.get("display") == "none":
            return False, False
        if "visibility" in values:
            seen = values["visibility"] not in ("hidden", "collapse")
    return True, seen


def whole(text: str | None, otherwise: int) -> int:
    return int(text) if text is not None and re.fullmatch(r"-?[0-9]{1,9}", text.strip()) else otherwise


def list_start(node: Node) -> tuple[str, int, int]:
    """The kind of a list, the number of its first item, and the step to the next one."""
    back = node.tag == "ol" and "reversed" in node.attributes
    items = sum(isinstance(c, Node) and c.tag == "li" for c in node.children) if back else 1
    return node.tag, whole(node.attributes.get("start"), items), -1 if back else 1


def render(root: Node, sheet: Sheet) -> str:
    flow = Flow()
    flows, tables, lists = [flow], [], []
    pre = 0
    stack: list[tuple[Node | str, Node | None, bool, bool]] = [(root, None, True, False)]
    while stack:
        node, parent, seen, leaving = stack.pop()
        if isinstance(node, str):
            closed = parent is not None and parent.tag == "details" and "open" not in parent.attributes
            if seen and not closed:
                flow.kept(node) if pre else flow.words(node)
            continue
        tag = node.tag
        gap = 2 if tag in SPACED else 1 if tag in BLOCKS else 0
        if tag in LISTS and len(lists) > leaving:
            gap = 1  # a list in a list
        if not leaving:
            laid, seen = shown(node, parent, seen, sheet)
            if not laid:
                continue
            if tag == "br":
                flow.turn()
                continue
            if tag in ("wbr", "input", "img", "area", "embed", "col"):
                continue
            if tag == "table":
                flow.block(2)
                tables.append((Table(), pre, lists))
                pre, lists = 0, []
            elif tag == "tr" and tables:
                tables[-1][0].row()
            elif tag in ("td", "th") and tables:
                flow = Flow()
                flows.append(flow)
            elif gap:
                if tag == "li" and lists:
                    flow.block(1)
                    kind, number, step = lists[-1]
                    number = whole(node.attributes.get("value"), number) if kind == "ol" else number
                    lists[-1] = (kind, number + step, step)
                    mark = f"{number}. " if kind == "ol" else "- "
                    flow.mark += mark
                    flow.indent += len(mark)
                    stack.append((Node("/li", {"by": str(len(mark))}), None, seen, True))
                else:
                    flow.block(gap)
                if tag in LISTS:
                    lists.append(list_start(node))
                elif tag in ("blockquote", "dd"):
                    flow.indent += 2
                elif tag in ("pre", "textarea", "listing"):
                    pre += 1
            elif tag == "textarea":
                pre += 1
            stack.append((node, parent, seen, True))
            stack.extend((child, node, seen, False) for child in reversed(node.children))
            continue
        if tag == "/li":
            flow.finish_line()
            flow.mark = ""
            flow.indent -= int(node.attributes["by"])
        elif tag == "table":
            table, pre, lists = tables.pop()
            flow.block(2)
            flow.put(table.laid_out())
            flow.block(2)
        elif tag in ("td", "th") and tables:
            flows.pop()
            tables[-1][0].cell(flow.done(), span(node, "colspan"), span(node, "rowspan"))
            flow = flows[-1]
        elif gap:
            flow.block(gap)
            if tag in LISTS:
                lists.pop()
            elif tag in ("blockquote", "dd"):
                flow.indent -= 2
            elif tag == "pre":
                pre -= 1
        elif tag == "textarea":
            pre -= 1
    return "\n".join(flows[0].done())


def visible_text(page: str) -> str:
    tree = Tree(page)
    return render(tree.root, Sheet(tree.styles))


def extract_batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch, "html"):
            pages = part.column("html").to_pylist()
            texts = [None if p is None else visible_text(p) for p in pages]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), pa.array(texts, pa.string())], ["page_id", "text"]
            )


def extract(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """One row for each row of pages: page_id, text."""
    given = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"))
    return in_batches(given, extract_batches, "page_id long, text string")
