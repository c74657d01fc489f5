"""Op 2, HTML extraction: layout-aware rendering of all visible text.

Method: a tree builder over the standard library's tokenizer adds implied tags (a block closes an
open paragraph, an item the item before it, a row or cell its predecessors, ...) and ignores stray
end tags; a renderer walks the tree and drops what a browser would not show (head, scripts,
``hidden``, ``display:none``, ``visibility:hidden``, closed dialogs and details). A head that isn't
closed ends at the first tag or text that can't be in it; an svg shows its text and foreign objects. Blocks start new
lines, blocks with margins leave a blank line, list items carry their bullet or number under their
list's indentation, preformatted text keeps its white space, and the cells of a table's column are
padded to one display width, that of its widest line of at most `MAX_CELL` columns; a longer line stays
whole and moves what follows it. Nothing visible is lost: there is no boilerplate removal here.

A tag or comment that the page's end cuts short isn't shown, and neither is what it swallows; declarations of any
kind are comments, but CDATA within an svg is text.

Cost is linear in the page: open elements are found by their tag, whatever the nesting, and rows are as
long as their cells.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_set = lambda s: frozenset(s.split())
#: Element names by their role in the HTML standard.
VOID = _set("area base br col embed hr img input link meta param source track wbr")
HIDDEN = _set("head script style template noscript iframe object canvas audio video datalist title meta link base param source track col colgroup rp area noframes")
#: Start tags that leave an open head open; within svg, what is drawn only where referred to, if at all.
IN_HEAD = _set("title meta link base basefont bgsound script style template noscript noframes head")
SVG_HIDDEN = _set("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter")
#: Inside svg: HTML again below these; HTML start tags that end an svg left open.
SVG_HTML = _set("foreignobject desc title")
ENDS_SVG = _set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var")
MARGIN = _set("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure hr fieldset")
BLOCK = MARGIN | _set("address article aside body center dd details dialog dir div dt figcaption footer form header hgroup html legend li main nav optgroup option search section summary caption tr td th thead tbody tfoot")
CLOSES_P = (BLOCK | _set("hr")) - _set("dd dt option optgroup caption tr td th thead tbody tfoot html body legend")
#: Start tag: (the open elements that it closes, the elements at which looking for them stops).
IMPLIED = {
    "li": (_set("li"), _set("ul ol menu")),
    "dt": (_set("dt dd"), _set("dl")),
    "dd": (_set("dt dd"), _set("dl")),
    "option": (_set("option"), _set("select datalist optgroup")),
    "optgroup": (_set("option optgroup"), _set("select")),
    "tr": (_set("tr td th caption colgroup"), _set("table")),
    "td": (_set("td th"), _set("tr table")),
    "th": (_set("td th"), _set("tr table")),
    "thead": (_set("caption colgroup thead tbody tfoot tr td th"), _set("table")),
    "tbody": (_set("caption colgroup thead tbody tfoot tr td th"), _set("table")),
    "tfoot": (_set("caption colgroup thead tbody tfoot tr td th"), _set("table")),
}
#: An end tag is not looked for beyond these.
BARRIER = _set("table td th caption")
MAX_DEPTH = 120
#: A line of a cell that is wider doesn't widen its column. The standard's limits of spans.
MAX_CELL, MAX_COLSPAN, MAX_ROWSPAN = 100, 1000, 65534

_title, _title_end = re.compile("(?i)<title(?=[\\s/>])"), re.compile("(?i)</title")
_space = re.compile(r"[ \t\n\f\r]+")
_comment_end = re.compile("--!?>")
_style = re.compile(r"(?i)(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)")


class Element:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """`root`, an element html. Elements below MAX_DEPTH levels become siblings there, as browsers do; what
    they hide stays hidden."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list)  # tag: its places in `open`
        self.deep: list[tuple[Element, bool, Element]] = []  # below MAX_DEPTH: where content goes, whether it is visible, where it would go outside

    def _last(self, tags: frozenset) -> int:
        """Place of the lowest open element of `tags`; 0 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _cut(self, at: int) -> None:
        """Closes the elements from place `at` on."""
        while len(self.open) > at:
            tag = self.open.pop().tag
            self.places[tag].pop()
            if self.deep:
                _, _, outside = self.deep.pop()
                if tag in BLOCK:  # its content lies beside it: what follows starts a line all the same
                    outside.children.append(Element("p" if tag in MARGIN else "div", {}))

    def _close(self, tags: frozenset, stops: frozenset) -> None:
        """Closes the lowest open element of `tags` and all in it, unless one of `stops` lies in between."""
        at = self._last(tags)
        if at and at >= self._last(stops):
            # All of the tags that lie directly above belong to the same construct (a cell in its row).
            while at > 1 and self.open[at - 1].tag in tags:
                at -= 1
            self._cut(at)

    def _svg(self) -> int:
        """Place of the outermost open svg whose drawing the next tag is part of; 0 if there is none."""
        svgs = self.places.get("svg")
        if not svgs:
            return 0
        at = bisect_right(svgs, self._last(SVG_HTML))
        return svgs[at] if at < len(svgs) else 0

    def _close_head(self) -> None:
        while self.open[-1].tag == "head":
            self._cut(len(self.open) - 1)

    def _host(self) -> Element:
        """The element that content goes to."""
        return self.deep[-1][0] if self.deep else self.open[-1]

    def _upto(self, end: int) -> int:
        """Where the tokenizer goes on; at the page's end if what it looked for isn't there (`end` < 0)."""
        return len(self.rawdata) if end < 0 else end

    def parse_starttag(self, i: int) -> int:
        return self._upto(super().parse_starttag(i))

    def parse_endtag(self, i: int) -> int:
        return self._upto(super().parse_endtag(i))

    def parse_comment(self, i: int, report: bool = True) -> int:
        for empty in ("<!-->", "<!--->"):
            if self.rawdata.startswith(empty, i):
                return i + len(empty)
        found = _comment_end.search(self.rawdata, i + 4)
        return self._upto(found.end() if found else -1)

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata.startswith("<![CDATA[", i) and self._svg():
            end = self.rawdata.find("]]>", i)
            self.handle_data(self.rawdata[i + 9 : self._upto(end)])
            return self._upto(end + 3 if end >= 0 else -1)
        return self.parse_pi(i)

    def parse_pi(self, i: int) -> int:
        end = self.rawdata.find(">", i + 2)
        return self._upto(end + 1 if end >= 0 else -1)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        attrs = dict(reversed(attrs))  # the first of equal names counts
        if tag == "html":
            self.root.attrs = attrs | self.root.attrs
            return
        at = self._svg()
        if at and (tag in ENDS_SVG or (tag == "font" and not attrs.keys().isdisjoint(("color", "face", "size")))):
            self._cut(at)
        elif at:
            self._push(tag, attrs)
            return
        if tag not in IN_HEAD:
            self._close_head()
        if tag == "body":
            self._close(_set("head"), frozenset())
        elif tag in CLOSES_P:
            self._close(_set("p"), BARRIER | _set("button"))
            if tag[0] == "h" and tag[1:].isdigit() and re.fullmatch("h[1-6]", self.open[-1].tag):
                self._cut(len(self.open) - 1)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push("tr", {})
        if tag in VOID:
            self._host().children.append(Element(tag, attrs))
        else:
            self._push(tag, attrs)

    def _push(self, tag: str, attrs: dict) -> None:
        element, host = Element(tag, attrs), self._host()
        if len(self.open) >= MAX_DEPTH:
            _, shown, outside = self.deep[-1] if self.deep else (host, True, host)
            if tag == "summary" and self.open[-1].tag == "details":
                host = outside  # a closed one shows its summary
            inside, now = _visible(element, shown)
            goes_on = host
            if not inside or (tag == "details" and "open" not in attrs):
                goes_on = Element("", {})  # part of no tree
            elif tag in ("text", "foreignobject") and host.tag not in ("text", "foreignobject"):
                goes_on = element  # an svg shows the text of these only
            elif now != shown:
                goes_on = Element("span", {"style": f"visibility:{'visible' if now else 'hidden'}"})
                host.children.append(goes_on)
            self.deep.append((goes_on, now, host))
        host.children.append(element)
        self.places[tag].append(len(self.open))
        self.open.append(element)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        drawn = self._svg() and tag not in ENDS_SVG
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML, but ends an element of svg
        if (tag == "svg" or drawn) and self.open[-1].tag == tag:
            self._cut(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._host().children.append(Element("br", {}))
            return
        stops = frozenset() if tag in BARRIER | _set("tr thead tbody tfoot body html") else BARRIER
        at = self._last(frozenset([tag]))
        if at and at >= self._last(stops):
            self._cut(at)
        elif tag == "p":
            self._host().children.append(Element("p", {}))

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self._close_head()
        self._host().children.append(data)


def _width(text: str) -> int:
    """Columns that a text takes where it is shown: two for a wide character, none for a combining one."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) or unicodedata.category(c) in ("Mn", "Me", "Cf") else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class _Lines:
    """Lines of a block formatting context; white space collapses across inline elements."""

    def __init__(self):
        self.done: list[str] = []
        self.line: list[str] = []
        self.gap = False  # a space is due before the next word
        self.feed = 0  # newlines due before the next text
        self.indent = ""
        self.mark = ""

    def write(self, text: str) -> None:
        words = _space.split(text)
        if len(words) == 1 and not words[0]:
            return
        if not words[0] and self.line:
            self.gap = True
        middle = [w for w in words if w]
        if not middle:
            return
        self._begin()
        if self.gap and self.line:
            self.line.append(" ")
        self.line.append(" ".join(middle))
        self.gap = not words[-1]

    def _begin(self) -> None:
        if self.feed:
            self._flush()
            if self.feed > 1 and self.done and self.done[-1]:
                self.done.append("")
            self.feed = 0

    def _flush(self) -> None:
        if self.line:
            self.done.append(self.indent_of + "".join(self.line).rstrip())
            self.line = []
        self.gap = False

    @property
    def indent_of(self) -> str:
        if self.mark:
            out, self.mark = self.indent[: max(0, len(self.indent) - len(self.mark))] + self.mark, ""
            return out
        return self.indent

    def block(self, n: int) -> None:
        """The next text starts at least n line feeds on."""
        self._flush()
        self.feed = max(self.feed, n)

    def rule(self, text: str) -> None:
        self._begin()
        self._flush()
        self.done.append(self.indent + text)

    def pre(self, text: str) -> None:
        self._begin()
        for i, x in enumerate(text.expandtabs(8).split("\n")):
            if i and self.line:
                self._flush()
            elif i:
                self.done.append("")
            if x:
                self.line.append(x)

    def br(self) -> None:
        self._begin()
        if self.line:
            self._flush()
        elif self.done and self.done[-1]:
            self.done.append("")

    def end(self) -> list[str]:
        self._flush()
        while self.done and not self.done[-1].strip():
            self.done.pop()
        return self.done


def _visible(e: Element, shown: bool) -> tuple[bool, bool]:
    """(is in the layout, its text is visible)."""
    a = e.attrs
    if e.tag in HIDDEN or "hidden" in a or (e.tag == "dialog" and "open" not in a) or (e.tag == "input" and (a.get("type") or "").lower() == "hidden"):
        return False, False
    for name, value in _style.findall(a.get("style") or ""):
        if name.lower() == "display" and value.lower() == "none":
            return False, False
        if name.lower() == "visibility":
            shown = value.lower() not in ("hidden", "collapse")
    return True, shown


def _number(value: str | None, default: int) -> int:
    try:
        return int((value or "").strip())
    except ValueError:
        return default


def _table_rows(e: Element, shown: bool) -> Iterator[tuple[Element, bool]]:
    """Rows of a table in order of display: head, bodies, foot."""
    parts: dict[str, list] = {"thead": [], "tbody": [], "tfoot": []}
    for c in e.children:
        if isinstance(c, Element):
            inside, vis = _visible(c, shown)
            if inside and c.tag == "tr":
                parts["tbody"].append((c, vis))
            elif inside and c.tag in parts:
                for r in c.children:
                    if isinstance(r, Element) and r.tag == "tr":
                        ok, v = _visible(r, vis)
                        if ok:
                            parts[c.tag].append((r, v))
    return iter(parts["thead"] + parts["tbody"] + parts["tfoot"])


def _table(e: Element, out: _Lines, shown: bool) -> None:
    # What isn't a row (captions, misplaced text) comes first, as browsers put it before the table.
    for c in e.children:
        if not (isinstance(c, Element) and c.tag in ("tr", "thead", "tbody", "tfoot")):
            _render(c, out, shown)
        elif c.tag in ("thead", "tbody", "tfoot") and _visible(c, shown)[0]:
            for x in c.children:
                if not (isinstance(x, Element) and x.tag == "tr"):
                    _render(x, out, _visible(c, shown)[1])
    grid: list[list[tuple[int, bool, list[str]]]] = []  # per row: column, whether over one column only, lines
    below: list[tuple[int, int, int]] = []  # cells that go on in the next row: first column, end, rows left
    for row, vis in _table_rows(e, shown):
        cells: list[tuple[int, bool, list[str]]] = []
        taken, at, i = below, 0, 0
        below = [(lo, hi, n - 1) for lo, hi, n in taken if n > 1]
        for c in row.children:
            if isinstance(c, str) or c.tag not in ("td", "th"):
                if isinstance(c, Element) or c.strip():
                    _render(c, out, vis)
                continue
            inside, v = _visible(c, vis)
            if not inside:
                continue
            while i < len(taken) and taken[i][0] <= at:
                at, i = max(at, taken[i][1]), i + 1
            lines = _Lines()
            for x in c.children:
                _render(x, lines, v)
            wide = max(1, min(_number(c.attrs.get("colspan"), 1), MAX_COLSPAN))
            high = max(1, min(_number(c.attrs.get("rowspan"), 1), MAX_ROWSPAN))
            if high > 1:
                below.append((at, at + wide, high - 1))
            cells.append((at, wide == 1, lines.end()))
            at += wide
        below.sort()
        grid.append(cells)
    # Columns in which no cell begins take no room.
    widths: dict[int, int] = {}
    for cells in grid:
        for j, single, lines in cells:
            widths[j] = max([widths.get(j, 0), *(w for w in map(_width, lines) if single and w <= MAX_CELL)])
    used, starts = sorted(widths), [0]
    for j in used:
        starts.append(starts[-1] + widths[j] + 2)
    out.block(1)
    for cells in grid:
        for i in range(max([0, *(len(lines) for _, _, lines in cells)])):
            parts, at = [], 0
            for j, _, lines in cells:
                if i < len(lines) and lines[i]:
                    gap = starts[bisect_left(used, j)] - at
                    gap = max(gap, 2) if at else gap
                    parts += [" " * gap, lines[i]]
                    at += gap + _width(lines[i])
            if parts:
                out.rule("".join(parts).rstrip())
        out.block(1)


def _svg(e: Element, out: _Lines, shown: bool, text: bool = False) -> None:
    """What a drawing shows as text: its text elements, a word apart, and its foreign objects as blocks."""
    for c in e.children:
        if isinstance(c, str):
            if text and shown:
                out.write(c)
            continue
        visibility = (c.attrs.get("visibility") or "").strip().lower()
        inside, vis = _visible(c, visibility not in ("hidden", "collapse") if visibility else shown)
        if not inside or c.tag in SVG_HIDDEN or (c.attrs.get("display") or "").strip().lower() == "none":
            continue
        if c.tag == "foreignobject":
            out.block(1)
            for x in c.children:
                _render(x, out, vis)
            out.block(1)
            continue
        if c.tag == "text":
            out.write(" ")
        _svg(c, out, vis, text or c.tag == "text")
        if c.tag == "text":
            out.write(" ")


def _render(node: Element | str, out: _Lines, shown: bool, pre: bool = False) -> None:
    if isinstance(node, str):
        if shown:
            out.pre(node) if pre else out.write(node)
        return
    inside, shown = _visible(node, shown)
    if not inside:
        return
    tag = node.tag
    if tag == "br":
        out.br()
        return
    if tag == "svg":
        drawing = Element("g", {})
        drawing.children = [node]
        _svg(drawing, out, shown)
        return
    feeds = 2 if tag in MARGIN else 1 if tag in BLOCK else 0
    if tag in ("ul", "ol", "menu", "dl") and out.indent:
        feeds = 1  # a list within a list has no margin
    if feeds:
        out.block(feeds)
    if tag == "hr":
        return
    if tag == "table":
        _table(node, out, shown)
    elif tag in ("ul", "ol", "menu"):
        items = [c for c in node.children if isinstance(c, Element) and c.tag == "li" and _visible(c, shown)[0]]
        step = -1 if "reversed" in node.attrs else 1
        at = _number(node.attrs.get("start"), len(items) if step < 0 else 1)
        for c in node.children:
            if not (isinstance(c, Element) and c.tag == "li"):
                _render(c, out, shown)
                continue
            if not _visible(c, shown)[0]:
                continue
            at = _number(c.attrs.get("value"), at)
            mark = f"{at}. " if tag == "ol" else "- "
            at += step
            out.block(1)
            before = out.indent
            out.indent += " " * len(mark)
            out.mark = mark
            _render(c, out, shown)
            out.block(1)
            out.indent, out.mark = before, ""
    elif tag in ("blockquote", "dd"):
        before, out.indent = out.indent, out.indent + "  "
        for c in node.children:
            _render(c, out, shown, pre)
        out._flush()
        out.indent = before
    elif tag == "details" and "open" not in node.attrs:
        for c in node.children:
            if isinstance(c, Element) and c.tag == "summary":
                _render(c, out, shown)
                break
    else:
        pre = pre or tag in ("pre", "textarea", "listing", "xmp")
        for i, c in enumerate(node.children):
            if pre and i == 0 and isinstance(c, str) and c.startswith("\n"):
                c = c[1:]  # the line feed after <pre> isn't shown
            _render(c, out, shown, pre)
        if tag in ("td", "th"):
            out.write(" ")
    if feeds:
        out.block(feeds)


def render(html: str | None) -> str:
    """Visible text of a whole page; '' for a null or empty one."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    out = _Lines()
    _render(builder.root, out, True)
    return "\n".join(out.end())


def title(html: str | None) -> str:
    """Text of the first title element, white space collapsed; '' without one."""
    html = html or ""
    start = _title.search(html)
    opened = html.find(">", start.end()) if start else -1
    end = _title_end.search(html, opened) if opened >= 0 else None
    return _space.sub(" ", unescape(html[opened + 1 : end.start()])).strip() if end else ""


def extract_text(pages: DataFrame, *, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns in `keep`, `title` and `text`, one row per row of `pages`.

    Null and empty pages have empty texts; unbalanced or deeply nested markup loses no visible text and
    shows no hidden one; repeated rows each have their result; an empty table gives no rows. Other columns
    may have any name; of `keep`, title and text give way to the result's.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    keep = tuple(c for c in keep if c not in ("title", "text"))
    picked = pages.select(*[F.col(c) for c in keep], F.col(html_col).cast("string").alias("__html"))
    schema = StructType([*picked.schema.fields[:-1], StructField("title", StringType()), StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                html = batch.column(batch.num_columns - 1).to_pylist()
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(map(title, html), pa.string()), pa.array(map(render, html), pa.string())], names=[*keep, "title", "text"])

    return picked.mapInArrow(run, schema)
