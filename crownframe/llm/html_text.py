"""Visible text of HTML pages, laid out.

A tree builder reads the markup with HTML's implied tags (a paragraph ends where a block begins, a list
item or table cell where the next one does, void elements have no content), and a renderer walks the tree as a
screen reader would: what isn't shown (scripts, styles, templates, `hidden`, `display:none`,
`visibility:hidden` but for what is visible within it, closed dialogs, hidden inputs, passwords; sound, video and canvas, whose content is for browsers
without them) is left out and all other text is emitted: formulas, labels of inline drawings, what stands in
an object, marked `aria-hidden` or not, and the values of inputs (the placeholder if there is none). In formulas and
drawings, names, descriptions, metadata, annotations, phantoms and definitions aren't shown, nor is text of a drawing
outside its labels; a definition is shown where it is used (not one used within another). Blocks stand on
lines of their own, with a blank line around those that have a margin; list items have bullets or numbers and
are indented by depth; tables are grids with columns aligned to their widest cell, spans included, and a cell of
several lines has them below each other in its column;
preformatted text keeps its spaces.

Defined results: null or empty markup gives the empty text; markup that doesn't parse is text where it
stands; unclosed elements end with their parent; elements nested deeper than `DEEPEST` are kept in
line at that depth (their text too). Other columns are never looked at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownframe.llm.shared import ship, whole_text

#: Element names by their role in HTML.
#: Parts of drawings and formulas that aren't shown; elements whose text is apart from its neighbours'; HTML inside them.
UNDRAWN = set("desc metadata defs symbol clippath mask pattern marker annotation annotation-xml mphantom".split())
APART = set("text mfrac mtr mtd".split())
INNER_HTML = set("foreignobject desc title mi mo mn ms mtext".split())
#: Opening tags that end a drawing or formula.
BREAKS_OUT = set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing "
                 "menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Inputs that show no value.
NO_VALUE = set("hidden password checkbox radio range color file image".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("script style head title meta link base template noscript iframe audio video canvas "
             "noembed noframes datalist".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
             "search section summary table tbody td tfoot th thead tr ul caption".split())
SPACED = set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 ol p pre table ul menu dir".split())
ENDS_P = BLOCKS - set("body html li dd dt option optgroup td th tr tbody thead tfoot caption legend".split())
#: An opening tag closes an open element of the second set, unless one of the third lies in between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "caption"}, {"table"}),
    "body": ({"head"}, {"body"}),
}
#: No end tag reaches beyond these.
WALLS = {"table", "td", "th", "caption", "html", "body", "template"}
#: Parts of a table; their end tags reach to the table itself.
TABLE_PARTS = {"table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th"}
START = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
TAG_STOP = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
DECLARATION = re.compile(r"(?:^|;)\s*([-\w]+)\s*:((?:[^;\"'(]|\"[^\"]*\"|'[^']*'|\([^)]*\))*)")
UNDRAWN_STYLE = {"display": ("none",)}
SELF_CLOSING = re.compile(r"(?<!/)/\s*\Z")
OPEN_VALUE = re.compile(r"=\s*[^\s\"']*/\Z")
BLANKS = re.compile(r"[ \t\n\r\f]+")
#: Nesting that is kept; columns that a cell may span; characters that a column is aligned to at most: longer lines push
#: what follows them to the right.
DEEPEST, WIDEST, ALIGNED = 200, 1000, 200


class Node:
    __slots__ = ("name", "attributes", "children", "foreign", "unseen", "empty")

    def __init__(self, name: str, attributes: str = "", foreign: str = ""):
        self.name, self.children, self.foreign = name, [], foreign       # foreign: svg or math, of their own elements
        self.unseen = self.empty = False     # by visibility: the element itself; and all in it
        self.attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} \
            if attributes.strip(" \t\n\r\f/") else {}


class Scanner:
    """Markup from left to right: comments, declarations and tags; what isn't one is text.

    A tag runs to the first `>` outside quotes. Where a quote doesn't close there is no tag, and neither is there one at
    any other place that such a run passed outside quotes, so few runs reach the end in vain.
    """

    def __init__(self, markup: str):
        self.markup, self.dead = markup, bytearray()

    def _tag_end(self, at: int) -> int:
        spans, start = [], at
        while True:
            stop = TAG_STOP.search(self.markup, at)
            if stop and stop[0] == ">":
                return stop.start()
            close = self.markup.find(stop[0], stop.end()) if stop else -1
            spans.append((start, stop.start() if stop else len(self.markup)))
            if close < 0:
                break
            start = at = close + 1
        self.dead = self.dead or bytearray(len(self.markup))
        for a, z in spans:
            self.dead[a:z] = b"\1" * (z - a)
        return -1

    def next(self, at: int):
        """The next piece at or after `at`: its start and end, whether it is an end tag, its name (none: not a tag) and its
        attributes; None if there is none."""
        while True:
            m = START.search(self.markup, at)
            if not m:
                return None
            if m[1] or m[2]:
                close = self.markup.find("-->" if m[1] else "]]>", m.end())
                return m.start(), close + 3 if close >= 0 else len(self.markup), False, "", ""
            if m[3]:
                close = self.markup.find(">", m.end())
                return m.start(), close + 1 if close >= 0 else len(self.markup), False, "", ""
            end = -1 if self.dead and self.dead[m.start()] else self._tag_end(m.end())
            if end >= 0:
                return m.start(), end + 1, bool(m[4]), m[5].lower(), self.markup[m.end():end]
            at = m.start() + 1


def build(markup: str) -> Node:
    """The tree of a page; strings are children too."""
    root = Node("html")
    open_, at, uses = [root], 0, []

    def close(names: set[str], walls: set[str]) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].name in names:
                del open_[i:]
                return
            if open_[i].name in walls:
                return

    def close_each(names: set[str], walls: set[str]) -> None:
        while True:
            n = len(open_)
            close(names, walls)
            if len(open_) == n:
                return

    def within() -> str:
        top = open_[-1]
        return "" if top.name in INNER_HTML else top.foreign

    def text(piece: str, exact: bool = False) -> None:
        if piece and (open_[-1].foreign != "svg" or labelled()):
            open_[-1].children.append(html.unescape(piece) if "&" in piece and not exact else piece)

    def labelled() -> bool:
        for x in reversed(open_):
            if x.name in ("text", "foreignobject") or x.foreign != "svg":
                return True
            if x.name == "svg":
                return False
        return True

    scanner = Scanner(markup)
    while piece := scanner.next(at):
        start, end, closing, name, attributes = piece
        text(markup[at:start])
        at = end
        if not name:
            if within() and markup.startswith("<![CDATA[", start):
                text(markup[start + 9:end].removesuffix("]]>"), exact=True)
            continue
        if closing:
            if name == "p" and not any(x.name == "p" for x in open_):
                open_[-1].children.append(Node("p"))
            elif name == "br":
                open_[-1].children.append(Node("br"))
            else:
                close({name}, ({"table", "html", "body", "template"} if name in TABLE_PARTS else WALLS) - {name})
            continue
        kind = within()
        if kind and name in BREAKS_OUT:
            while within():
                open_.pop()
            kind = ""
        if kind or name in ("svg", "math"):
            node = Node(name, attributes, kind or name)
            if name == "svg":
                node.foreign = "svg"
            if not kind and open_[-1].name == "head":
                open_.pop()
            open_[-1].children.append(node)
            if name == "use":
                uses.append(node)
            if not (SELF_CLOSING.search(attributes) and not OPEN_VALUE.search(attributes)) and len(open_) < DEEPEST:
                open_.append(node)
            continue
        if name in ("html", "body") and len(open_) > 1 and any(x.name == name for x in open_):
            continue
        if name in ENDS_P:
            close({"p"}, WALLS | {"button", "object"})
        if name in IMPLIED:
            close_each(*IMPLIED[name])
        elif re.fullmatch("h[1-6]", name) and re.fullmatch("h[1-6]", open_[-1].name):
            open_.pop()
        elif open_[-1].name == "head" and name not in UNSEEN:
            open_.pop()
        if name in ("td", "th") and open_[-1].name in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr")
            open_[-1].children.append(row)
            open_.append(row)
        node = Node(name, attributes)
        open_[-1].children.append(node)
        if name in RAW:
            over = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(markup, at)
            inside = markup[at:over.start() if over else len(markup)]
            node.children.append(html.unescape(inside) if name in ("title", "textarea") else inside)
            at = over.end() if over else len(markup)
        elif name not in VOID and len(open_) < DEEPEST:
            open_.append(node)
    text(markup[at:])
    if uses:
        show_used(root, uses)
    if "visibility" in markup.lower():
        set_visibility(root)
    return root


def declared(style: str) -> dict[str, str]:
    """The declarations of a style attribute; of one property the last holds."""
    style = re.sub(r"/\*.*?(?:\*/|\Z)", " ", style, flags=re.S)
    return {k.lower(): v.lower().replace("!important", "").strip() for k, v in DECLARATION.findall(style)}


def set_visibility(root: Node) -> None:
    """Visibility is inherited, and a visible element within an invisible one shows."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        for child in node.children:
            if not isinstance(child, str):
                own = declared(child.attributes.get("style", "")).get("visibility") or (
                    child.attributes.get("visibility", "").strip().lower() if child.foreign else "")
                child.unseen = own in ("hidden", "collapse") if own in ("hidden", "collapse", "visible", "initial") else node.unseen
                waiting.append(child)
    for node in reversed(order):
        node.empty = node.unseen and all(isinstance(x, str) or x.empty for x in node.children)


def show_used(root: Node, uses: list[Node]) -> None:
    """Put the parts of drawings that are used where they are used."""
    named: dict[str, Node] = {}
    waiting = [root]
    while waiting:
        node = waiting.pop()
        if node.foreign and node.attributes.get("id"):
            named.setdefault(node.attributes["id"], node)
        waiting += [x for x in reversed(node.children) if not isinstance(x, str)]
    for use in uses:
        target = named.get((use.attributes.get("href") or use.attributes.get("xlink:href") or "").removeprefix("#"))
        inside = [target] if target else []
        for x in inside:
            inside += [y for y in x.children if not isinstance(y, str)]
        if target and not any(x.name == "use" for x in inside):
            shown = Node(target.name if target.name not in UNDRAWN else "g", "", "svg")
            shown.attributes = {k: v for k, v in target.attributes.items() if k != "id"}
            shown.children = target.children
            use.children = [shown]


def hidden(node: Node) -> bool:
    a = node.attributes
    return (node.name in UNSEEN or node.empty or "hidden" in a
            or bool(a.get("style") and declared(a["style"]).get("display") == "none")
            or (node.name == "dialog" and "open" not in a)
            or (node.name == "input" and a.get("type", "").lower() == "hidden")
            or bool(node.foreign and (node.name in UNDRAWN or any(
                a.get(k, "").lower() in v for k, v in UNDRAWN_STYLE.items()))))


class Page:
    """Lines of laid-out text. Gaps asked for between blocks are joined, the largest counts."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.words: list[str] = []
        self.gap, self.indent, self.mark, self.exact = 0, 0, "", False

    def add(self, text: str, exact: bool) -> None:
        if exact:
            first, *others = text.split("\n")
            self.words.append(first)
            for line in others:
                self.flush(exact=True)
                self.words.append(line)
            self.exact = True
        else:
            self.words.append(BLANKS.sub(" ", text))

    def flush(self, exact: bool = False) -> None:
        line = "".join(self.words)
        exact, self.words, self.exact = exact or self.exact, [], False
        if not exact:
            line = re.sub("  +", " ", line).strip(" ")
        if not line.strip() and not (exact and self.lines):
            return
        if self.lines and self.gap > 1 and self.lines[-1]:
            self.lines.append("")
        lead, self.mark = self.mark or " " * self.indent, ""
        self.lines.append((lead + line).rstrip())
        self.gap = 0

    def block(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)

    def put(self, lines: list[str]) -> None:
        for line in lines:
            self.words = [line]
            self.flush(exact=True)

    def text(self) -> str:
        self.flush()
        return "\n".join(self.lines).strip("\n")


def render(node: Node, page: Page, exact: bool = False) -> None:
    for child in node.children:
        if node.name == "mfrac":
            page.add(" ", False)
        if isinstance(child, str):
            if not node.unseen:
                page.add(child, exact)
        elif hidden(child):
            continue
        elif child.name == "br":
            page.flush(exact=True) if page.words or exact else page.block(2)
        elif child.name == "hr":
            page.block(1)
        elif child.name == "img":
            if child.attributes.get("alt"):
                page.add(child.attributes["alt"], False)
        elif child.name == "input":
            kind, value = child.attributes.get("type", "").lower(), child.attributes.get("value")
            if kind in ("submit", "button", "reset"):
                page.add(value or "", False)
            elif kind == "image":
                page.add(child.attributes.get("alt") or "", False)
            elif kind not in NO_VALUE:
                page.add(f" {value or child.attributes.get('placeholder') or ''} ", False)
            elif kind == "password" and not value:
                page.add(f" {child.attributes.get('placeholder') or ''} ", False)
        elif child.foreign and (child.name in APART or child.attributes.get("display") == "block"):
            apart = child.attributes.get("display") == "block" and child.name == "math"
            page.block(1) if apart else page.add(" ", False)
            render(child, page, exact)
            page.block(1) if apart else page.add(" ", False)
        elif child.name == "table":
            page.block(2)
            page.put(table(child))
            page.block(2)
        elif child.name in ("ul", "ol", "menu", "dir"):
            listed(child, page, exact)
        elif child.name in BLOCKS:
            gap = 2 if child.name in SPACED else 1
            deeper = 2 * (child.name in ("blockquote", "dd"))
            page.block(gap)
            page.indent += deeper
            render(child, page, exact or child.name == "pre")
            page.block(gap)
            page.indent -= deeper
        elif child.name == "textarea" and not any(child.children):
            page.add(f" {child.attributes.get('placeholder') or ''} ", False)
        else:
            render(child, page, exact or child.name == "textarea")


def listed(node: Node, page: Page, exact: bool) -> None:
    inner = page.indent > 0 or bool(page.mark)
    page.block(1 if inner else 2)
    number = node.attributes.get("start") or "1"
    number = int(number) if re.fullmatch(r"-?\d{1,9}", number) else 1
    for child in node.children:
        if isinstance(child, str):
            page.add(child, exact)
            continue
        if child.name != "li":
            render(_around(child), page, exact)
            continue
        if hidden(child):
            continue
        page.block(1)
        sign = f"{number}. " if node.name == "ol" else "- "
        number += 1
        page.mark = page.mark or " " * page.indent + sign
        page.indent += len(sign)
        render(child, page, exact)
        page.block(1)
        page.indent -= len(sign)
        page.mark = ""
    page.block(1 if inner else 2)


def _around(child: Node) -> Node:
    around = Node("div")
    around.children = [child]
    return around


def _span(cell: Node, name: str) -> int:
    value = cell.attributes.get(name) or "1"
    return min(max(int(value), 1), WIDEST) if re.fullmatch(r"\d{1,6}", value) else 1


def table(node: Node) -> list[str]:
    """The lines of a table: captions and stray text first, then the grid."""
    rows, before = [], Page()

    def walk(part: Node) -> None:
        for child in part.children:
            if isinstance(child, str):
                before.add(child, False)
            elif hidden(child):
                continue
            elif child.name == "tr":
                rows.append([c for c in child.children if isinstance(c, Node) and c.name in ("td", "th") and not hidden(c)])
                others = Node("div")
                others.children = [c for c in child.children if isinstance(c, str) or c.name not in ("td", "th")]
                render(others, before)
            elif child.name in ("tbody", "thead", "tfoot"):
                walk(child)
            else:
                before.block(1)
                render(_around(child), before)
                before.block(1)

    walk(node)
    lines = [x for x in before.text().split("\n") if x]
    grid: list[dict[int, list[str]]] = []
    taken: dict[int, int] = {}                      # columns still covered by a cell from above, and for how many rows
    spans: list[dict[int, int]] = []
    for row in rows:
        cells, wide, column = {}, {}, 0
        covered, taken = taken, {c: n - 1 for c, n in taken.items() if n > 1}
        for cell in row:
            while column in covered:
                column += 1
            inside = Page()
            render(cell, inside)
            cells[column] = inside.text().split("\n")
            wide[column], down = _span(cell, "colspan"), _span(cell, "rowspan")
            if down > 1:
                taken |= {c: down - 1 for c in range(column, column + wide[column])}
            column += wide[column]
        grid.append(cells)
        spans.append(wide)
    width: dict[int, int] = {}
    for cells, wide in zip(grid, spans):
        for c, content in cells.items():
            if wide[c] == 1:
                longest = max((len(x) for x in content if len(x) <= ALIGNED), default=0)
                width[c] = max(width.get(c, 0), longest)
    starts = [0]
    for c in range(max((c for cells in grid for c in cells), default=0)):
        starts.append(starts[-1] + width.get(c, 0) + 2)
    for cells in grid:
        for k in range(max((len(content) for content in cells.values()), default=0)):
            line: list[str] = []
            at = 0
            for c, content in sorted(cells.items()):
                if k < len(content) and content[k]:
                    blanks = max(starts[c] - at, 2 * bool(at))
                    line += [" " * blanks, content[k]]
                    at += blanks + len(content[k])
            if at:
                lines.append("".join(line).rstrip())
    return lines


def visible_text(markup: str) -> str:
    page = Page()
    render(build(markup), page)
    return page.text()


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per page: page_id, text, n_lines."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), whole_text(f"`{html_col}`").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [visible_text(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()),
                 pa.array([x.count("\n") + 1 if x else 0 for x in texts], pa.int32())],
                names=["page_id", "text", "n_lines"])

    return rows.mapInArrow(run, f"page_id {kind}, text string, n_lines int")
