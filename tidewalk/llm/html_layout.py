"""Visible text of HTML pages, laid out as it is read.

A page is cut into tags and text, built into a tree under HTML's rules for tags left out
(a block ends an open paragraph, an item the item before, a cell brings its row), and
rendered: what is never shown goes, runs of white space become one space, blocks stand
on lines of their own, items have their marks and depth, and cells of a table are
aligned in columns.  Every page gives a result, however broken.
"""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewalk.llm.common import map_arrow

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript title textarea".split())
UNSEEN = frozenset("head script style template noscript noembed noframes iframe object audio video canvas svg math title datalist".split())
# Blocks with a blank line around them, and those without.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure article section hr form fieldset menu".split())
PLAIN = frozenset("html body div header footer nav main aside address li dt dd tr td th caption thead tbody tfoot figcaption legend details summary center dialog hgroup search option optgroup".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dd dt".split())
# An opening tag ends these, if they are open nearer than the bound.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
# Whatever else begins in an open head ends it.
HEAD_CONTENT = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
# A closing tag of an inline element reaches no farther up than these.
WALLS = frozenset("table td th caption html body template".split())

#: Cells longer than this don't widen their column; else one long cell would pad every row to its length.
MAX_PAD = 40
#: A table wider than this is not aligned.
MAX_WIDE = 1000

# Parts of a tag, each matched where the one before ended, so that reading a page is one pass.
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_COMMENT_END = re.compile(r"--!?>")
_WHITE = re.compile(r"[ \t\n\f\r]+")
_HIDDEN_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None) -> None:
        self.tag, self.attributes, self.children = tag, attributes or {}, []


def _read_tag(html: str, at: int) -> tuple[dict[str, str], int] | None:
    """Attributes of a tag from after its name, and the place after its ``>``; None if the page ends in it."""
    out: dict[str, str] = {}
    while True:
        at = _GAP.match(html, at).end()
        if at >= len(html):
            return None
        if html[at] == ">":
            return out, at + 1
        name = _ATTRIBUTE.match(html, at)
        at, value = name.end(), ""
        if equals := _EQUALS.match(html, at):
            at = equals.end()
            if html[at : at + 1] in ("'", '"'):
                end = html.find(html[at], at + 1)
                if end < 0:
                    return None
                value, at = html[at + 1 : end], end + 1
            else:
                bare = _BARE.match(html, at)
                value, at = bare[0], bare.end()
        out.setdefault(name[0].lower(), unescape(value))


def build_tree(html: str) -> Node:
    """The page's tree, tags that HTML lets one leave out put in."""
    root = Node("#root")
    stack = [root]
    opened: dict[str, list[int]] = {}  # where in the stack each tag is, so that deep pages need no search

    def close(upto: int) -> None:
        for node in stack[upto:]:
            opened[node.tag].pop()
        del stack[upto:]

    def nearest(tags: set[str]) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def find(tags: set[str], bound: set[str]) -> int | None:
        k = nearest(tags)
        return k if k and k >= nearest(bound) else None

    def start(tag: str, attributes: dict[str, str]) -> None:
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag not in VOID:
            opened.setdefault(tag, []).append(len(stack))
            stack.append(node)

    def end_head() -> None:
        if (k := find({"head"}, {"template"})) is not None:
            close(k)

    def text(raw: str) -> None:
        said = unescape(raw)
        if said.strip(" \t\n\f\r"):
            end_head()
        stack[-1].children.append(said)

    at = said = 0  # what stands from ``said`` to the next tag is text
    while (at := html.find("<", at)) >= 0:
        after = html[at + 1 : at + 2]
        closes = after == "/"
        name = _NAME.match(html, at + 1 + closes)
        if name is None and after not in ("!", "?") and not (closes and at + 2 < len(html)):
            at += 1
            continue
        if at > said:
            text(html[said:at])
        if name is None:  # a comment, a declaration, or what browsers take for one
            if html.startswith("<!--", at):
                end = _COMMENT_END.search(html, at + 2)
                at = said = end.end() if end else len(html)
            else:
                end = html.find(">", at + 1)
                at = said = end + 1 if end >= 0 else len(html)
            continue
        tag, read = name[0].lower(), _read_tag(html, name.end())
        if read is None:  # the page ends within a tag, which shows nothing
            said = len(html)
            break
        attributes, at = read
        said = at
        if closes:
            if tag == "p" and find({"p"}, WALLS) is None:
                start("p", {})  # a lone end tag makes an empty paragraph
            bound = set() if tag in WALLS or tag in ("tr", "tbody", "thead", "tfoot", "ul", "ol", "dl") else WALLS
            k = find({tag}, bound)
            if k is not None:
                close(k)
            continue
        if tag not in HEAD_CONTENT:
            end_head()
        if tag in ENDED_BY:
            tags, bound = ENDED_BY[tag]
            while (k := find(tags, bound)) is not None:
                close(k)
        if tag in ENDS_P and (k := find({"p"}, WALLS)) is not None:
            close(k)
        if tag in ("td", "th") and find({"tr"}, {"table"}) is None and find({"table"}, set()) is not None:
            start("tr", {})
        start(tag, attributes)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            body = html[at : end.start() if end else len(html)]
            stack[-1].children.append(unescape(body) if tag in ("title", "textarea") else body)
            close(len(stack) - 1)
            at = said = end.end() if end else len(html)
    if said < len(html):
        text(html[said:])
    return root


def is_shown(node: Node) -> bool:
    if node.tag in UNSEEN or "hidden" in node.attributes:
        return False
    if node.tag == "input" and node.attributes.get("type", "").lower() == "hidden":
        return False
    return not _HIDDEN_STYLE.search(node.attributes.get("style", ""))


class _Page:
    """Lines of text under way: words join the open line, blocks end it."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.open: list[str] = []
        self.gap = 0  # blank lines wanted before the next one
        self.indent = ""
        self.lead = ""  # an item's mark, for its first line

    def words(self, text: str) -> None:
        text = _WHITE.sub(" ", text)
        if text.startswith(" ") and (not self.open or self.open[-1].endswith(" ")):
            text = text[1:]
        if text:
            self.open.append(text)

    def emit(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        at = self.indent
        if self.lead:
            at, self.lead = at[: max(0, len(at) - len(self.lead))] + self.lead, ""
        self.lines.append((at + line).rstrip(" "))

    def end_line(self, even_if_empty: bool = False) -> None:
        line, self.open = "".join(self.open).rstrip(" "), []
        if line or even_if_empty:
            self.emit(line)

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


# Rendering follows the tree, however deep: a step is a generator that yields the steps it needs.
_Step = Generator["_Step", object, object]


def _run(step: _Step) -> object:
    under_way, value = [step], None
    while under_way:
        try:
            inner = under_way[-1].send(value)
        except StopIteration as done:
            under_way.pop()
            value = done.value
        else:
            under_way.append(inner)
            value = None
    return value


def _one_line(node: Node, count: dict[str, int]) -> _Step:
    page = _Page()
    for child in node.children:
        yield _render(child, page, count)
    return " ".join(x.strip() for x in page.text().split("\n") if x.strip())


def _rows(table: Node) -> tuple[list[Node], list[Node]]:
    """(captions and whatever else stands before rows, rows), through row groups."""
    before, rows, todo = [], [], list(reversed(table.children))
    while todo:
        child = todo.pop()
        if isinstance(child, str):
            if child.strip():
                before.append(child)
        elif not is_shown(child):
            continue
        elif child.tag == "tr":
            rows.append(child)
        elif child.tag in ("thead", "tbody", "tfoot"):
            todo += reversed(child.children)
        elif child.tag not in ("colgroup", "col"):
            before.append(child)
    return before, rows


# HTML's greatest spans.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534


def _span(cell: Node, name: str, most: int) -> int:
    value = cell.attributes.get(name, "1").strip()
    return min(max(int(value), 1), most) if value.isdigit() and len(value) < 9 else 1


def _table(table: Node, page: _Page, count: dict[str, int]) -> _Step:
    """Cells under each other by column; a column in which no cell begins takes no room."""
    before, rows = _rows(table)
    for child in before:
        yield _render(child, page, count)
    page.end_line()
    grid: list[list[tuple[int, str]]] = []  # (column, text), ascending
    taken: list[tuple[int, int, int]] = []  # (column, column after the last, rows) that cells from above still cover, ascending
    for row in rows:
        cells: list[tuple[int, str]] = []
        grown: list[tuple[int, int, int]] = []
        at = k = 0
        for cell in row.children:
            if isinstance(cell, str):
                text, wide, tall = cell.strip(), 1, 1
                if not text:
                    continue
            elif not is_shown(cell):
                continue
            else:
                text, wide, tall = (yield _one_line(cell, count)), _span(cell, "colspan", MAX_COLSPAN), _span(cell, "rowspan", MAX_ROWSPAN)
            while k < len(taken) and taken[k][0] <= at:
                at, k = max(at, taken[k][1]), k + 1
            cells.append((at, text))
            if tall > 1:
                grown.append((at, at + wide, tall - 1))
            at += wide
        taken = sorted([(a, b, n - 1) for a, b, n in taken if n > 1] + grown)
        grid.append(cells)
    width: dict[int, int] = {}
    for cells in grid:
        for column, text in cells:
            width[column] = max(width.get(column, 0), len(text) if len(text) <= MAX_PAD else 0)
    place, total = {}, 0
    for column in sorted(width):
        place[column] = total
        total += width[column] + 2
    for cells in grid:
        parts, reached = [], 0  # long cells push what follows to the right
        for column, text in cells:
            if text:
                gap = max(place[column] - reached if total <= MAX_WIDE else 0, 2 if parts else 0)
                parts += [" " * gap, text]
                reached += gap + len(text)
        if parts:
            page.emit("".join(parts))
    count["tables"] += 1


def _list_mark(node: Node, item: Node, number: int) -> str:
    return f"{number}. " if node.tag == "ol" else "- "


def _render(node: Node | str, page: _Page, count: dict[str, int], preformatted: bool = False) -> _Step:
    if isinstance(node, str):
        if not preformatted:
            page.words(node)
            return
        first, *rest = node.split("\n")
        page.open.append(first)
        for line in rest:
            page.end_line(even_if_empty=True)
            page.open.append(line)
        return
    if node.tag != "#root" and not is_shown(node):
        return
    tag = node.tag
    gap = 1 if tag in SPACED else 0
    if tag == "br":
        page.end_line(even_if_empty=True)
        return
    if gap or tag in PLAIN:
        page.block(gap)
    if tag == "table":
        yield _table(node, page, count)
    elif tag in ("ul", "ol", "menu"):
        start = node.attributes.get("start", "1")
        number = int(start) if start.isdigit() and len(start) < 9 else 1
        if page.indent:  # a list in an item has no blank lines around it
            page.gap, gap = 0, 0
        for child in node.children:
            if isinstance(child, Node) and child.tag == "li" and is_shown(child):
                mark, outer = _list_mark(node, child, number), page.indent
                page.block(0)
                page.indent, page.lead = outer + " " * len(mark), mark
                for inner in child.children:
                    yield _render(inner, page, count)
                page.end_line()
                page.indent, page.lead, number = outer, "", number + 1
                page.gap = 0
                count["items"] += 1
            else:
                yield _render(child, page, count)
    elif tag == "details" and "open" not in node.attributes:
        for child in node.children:
            if isinstance(child, Node) and child.tag == "summary":
                yield _render(child, page, count)
    else:
        outer = page.indent
        if tag in ("dd", "blockquote"):
            page.indent = outer + "  "
        for child in node.children:
            yield _render(child, page, count, preformatted or tag in ("pre", "textarea"))
        if gap or tag in PLAIN:
            page.end_line()
        page.indent = outer
    if gap or tag in PLAIN:
        page.block(gap)


def render_page(html: str | None) -> tuple[str, int, int]:
    """(visible text, tables, items) of a page; null and empty pages have none."""
    count = {"tables": 0, "items": 0}
    page = _Page()
    _run(_render(build_tree(html or ""), page, count))
    return page.text(), count["tables"], count["items"]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [render_page(x) for x in batch.column("html").to_pylist()]
        text, tables, items = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
        text = [t.encode("utf-8", "replace").decode() for t in text]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").cast(pa.int64()), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array(tables, pa.int64()), pa.array(items, pa.int64())],
            ["page_id", "text", "n_chars", "n_tables", "n_items"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """Visible text of all pages: ``page_id``, ``text``, ``n_chars``, ``n_tables``, ``n_items``.

    ``pages`` has ``page_id`` and ``html``; other columns are not looked at.  One row per
    row; a null or empty page, or one that shows nothing, has empty text.  Rows are
    independent of each other, so null and repeated ids are kept.  A page is read in one
    pass whatever its length and however broken; an empty table gives no rows.
    """
    return map_arrow(pages.select("page_id", "html"), _extract, "page_id long, text string, n_chars long, n_tables long, n_items long")
