"""Visible text of web pages, laid out as a browser without pictures would.

A tree builder opens and closes elements, those that HTML implies included;
elements that never show take all below them out, and so do closed details and
dialogs; invisible ones only blot out their text, and what is visible inside shows. Blocks
keep their spacing, lists their markers and depth, preformatted text its lines,
and the cells of a table stand in columns aligned by the width of their signs.
Rules of style sheets are not applied, only ``style`` and ``hidden`` of the elements.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

#: Fixed values of HTML: elements without an end, elements that never show, blocks.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                  "param", "source", "track", "wbr"))
UNSEEN = frozenset(("head", "title", "script", "style", "template", "noscript", "iframe", "object",
                    "audio", "video", "canvas", "datalist", "noframes", "annotation",
                    "annotation-xml", "rp"))
#: Of drawings only these show text, and these, which stand in drawings alone, never do.
SVG_TEXT = frozenset(("text", "foreignobject"))
SVG_UNSEEN = frozenset(("defs", "desc", "metadata", "symbol", "clippath", "mask", "pattern", "marker"))
#: These end a drawing or formula that was left open, unless they stand in its text.
BREAKS_OUT = frozenset((
    "b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em",
    "embed", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "i", "img", "li", "menu", "nobr",
    "ol", "p", "pre", "ruby", "s", "small", "span", "strong", "strike", "sub", "sup", "table", "tt",
    "u", "ul", "var"))
FOREIGN = frozenset(("svg", "math"))
FOREIGN_TEXT = frozenset(("foreignobject", "desc", "title", "mi", "mo", "mn", "ms", "mtext",
                          "annotation-xml"))
MARGIN = {tag: 1 for tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "pre",
                             "blockquote", "table", "figure", "hr", "fieldset")}
BLOCKS = frozenset((*MARGIN, "html", "body", "div", "article", "section", "nav", "header", "footer",
                    "main", "aside", "address", "li", "dt", "dd", "form", "figcaption", "details",
                    "summary", "caption", "tr", "option", "legend", "center", "hgroup", "search",
                    "dialog", "textarea"))
#: What the start of an element closes, and the elements beyond which nothing is closed.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "thead": ({"tbody", "caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tr"}, {"table"}),
}
#: An end tag looks no further out than these.
SCOPES = frozenset(("table", "td", "th", "caption"))
_HIDING = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_NUMBER = re.compile(r"\s*([-+]?[0-9]{1,9})")
_LISTS = re.compile(r"<(/?)(ol|ul|menu|li)\b([^>]*)", re.I)
#: Roman numerals, for markers.
ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"),
         (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))
_SPACES = re.compile(r"[ \t\n\f\r]+")
#: Indents and tables nested deeper than this stay, but as plain blocks: they no longer move text in.
DEEPEST = 512
FLAT = "flat"


class Flow:
    """Lines of one block context: the page, or a cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False  # a space is due before the next word
        self.gap = 0  # blank lines due before the next line
        self.indent: list[str] = []
        self.marker: str | None = None

    def words(self, text: str) -> None:
        text = _SPACES.sub(" ", text)
        if text[:1] == " " and self.now:
            self.space = True
        body = text.strip(" ")
        if body:
            if self.space:
                self.now.append(" ")
            self.now.append(body)
            self.space = text[-1:] == " "

    def raw(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self.now.append(first)
        for line in rest:
            self.line(keep=True)
            self.now.append(line)

    def line(self, keep: bool = False) -> None:
        """End the line that is open; an empty one only if ``keep``."""
        text = "".join(self.now)
        self.now, self.space = [], False
        if text or keep:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            lead = "".join(self.indent[:DEEPEST])
            if self.marker is not None:
                lead = "".join(self.indent[:min(len(self.indent) - 1, DEEPEST)]) + self.marker
                self.marker = None
            self.lines.append((lead + text).rstrip())

    def block(self, margin: int) -> None:
        self.line()
        self.gap = max(self.gap, margin)

    def put(self, lines: list[str]) -> None:
        """Finished lines, as they are."""
        self.line()
        for text in lines:
            self.now = [text]
            self.line(keep=True)

    def done(self) -> list[str]:
        self.line()
        return self.lines


def _span(given: dict, name: str, most: int) -> int | None:
    """A span as HTML reads it: 1 if it is no number; None for rows down to the last."""
    value = (given.get(name) or "").strip()
    number = int(value[:9]) if value.isascii() and value.isdigit() else 1
    if not number:
        return None if name == "rowspan" else 1
    return min(number, most)


def _number(text: str | None) -> int | None:
    found = _NUMBER.match(text or "")
    return int(found[1]) if found else None


def display_width(text: str) -> int:
    """Columns that ``text`` takes: wide signs two, marks on others none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 1 + (unicodedata.east_asian_width(c) in "WF")
               for c in text)


def numbered(number: int, kind: str) -> str:
    """The marker of a list's item, by the list's type; numbers that have no letters as digits."""
    if kind in ("a", "A") and number > 0:
        out = ""
        while number:
            number, letter = divmod(number - 1, 26)
            out = chr(97 + letter) + out
        return out.upper() if kind == "A" else out
    if kind in ("i", "I") and 0 < number < 4000:
        out = ""
        for value, sign in ROMAN:
            out += sign * (number // value)
            number %= value
        return out.upper() if kind == "I" else out
    return str(number)


def items_of_reversed(html: str) -> list[int]:
    """The number of items of each reversed list, in the order in which they begin."""
    found, open_lists = [], []
    for end, tag, given in _LISTS.findall(html):
        tag = tag.lower()
        if tag == "li":
            if not end and open_lists and open_lists[-1] is not None:
                found[open_lists[-1]] += 1
        elif not end:
            counts = tag == "ol" and re.search(r"(^|\s)reversed\b", given, re.I)
            open_lists.append(len(found) if counts else None)
            if counts:
                found.append(0)
        elif open_lists:
            open_lists.pop()
    return found


class Table:
    def __init__(self):
        self.rows: list[list[tuple]] = []  # cells: lines, columns, rows
        self.foot: list[list[tuple]] = []  # stands below all others
        self.now = self.rows

    def placed(self) -> list[list[tuple]]:
        """Rows of (column, columns, lines) on the grid that spans make."""
        busy: dict[int, int] = {}  # column -> first row in which it is free again
        out = []
        rows = self.rows + self.foot
        for at, row in enumerate(rows):
            column, here = 0, []
            for lines, columns, down in row:
                while busy.get(column, 0) > at:
                    column += 1
                here.append((column, columns, lines))
                if down != 1:
                    until = len(rows) if down is None else at + down
                    for c in range(column, column + columns):
                        busy[c] = max(until, busy.get(c, 0))
                column += columns
            out.append(here)
        return out

    def lines(self) -> list[str]:
        """Rows with columns as wide as their widest cell, two spaces apart.

        Columns in which no cell begins take no room. A cell over several
        columns widens the last one if it needs more than they have.
        """
        placed = self.placed()
        starts = sorted({column for row in placed for column, _, _ in row})
        cells = [[(bisect_left(starts, column), bisect_left(starts, column + columns), lines)
                  for column, columns, lines in row] for row in placed if row]
        widths = [0] * len(starts)
        for first, end, lines in sorted((c for row in cells for c in row),
                                        key=lambda c: (c[1] - c[0], c[0])):
            wide = max(map(display_width, lines), default=0)
            have = widths[first] if end == first + 1 else sum(widths[first:end]) + 2 * (end - first - 1)
            widths[end - 1] += max(0, wide - have)
        offsets = [0]
        for width in widths:
            offsets.append(offsets[-1] + width + 2)
        out = []
        for row in cells:
            for n in range(max(1, max(len(lines) for _, _, lines in row))):
                text = ""
                for first, _, lines in row:
                    if n < len(lines):
                        text += " " * (offsets[first] - display_width(text)) + lines[n]
                out.append(text.rstrip())
        return out


class Page(HTMLParser):
    """Builds the tree's path of open elements and lays text out on the way."""

    CDATA_CONTENT_ELEMENTS = ("script", "style", "textarea")

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple] = []  # tag, unseen, what its end needs, veiled around it, shut
        self.places: dict[str, list[int]] = {}  # tag -> where it stands in ``open``
        self.unseen = self.pre = 0
        self.veiled = False  # text is invisible here, but may be visible further in
        self.fresh = False  # a line end that comes now belongs to the tag before
        self.flows = [Flow()]
        self.tables: list[Table] = []
        self.flat = 0  # open tables beyond the deepest
        self.lists: list[list] = []
        self.reversed = iter(items_of_reversed(html) if "reversed" in html.lower() else ())
        self.feed(html)
        if not self.cdata_elem and re.match(r"<[a-zA-Z/!?]", self.rawdata):
            self.rawdata = ""  # a tag or comment that the page ends in
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.fresh = False
        closes, bounds = CLOSES.get(tag, ((), ()))
        if closes:
            self._close_through(closes, bounds)
        if tag in BREAKS_OUT:
            self._close_through(FOREIGN, FOREIGN_TEXT)
        if tag in BLOCKS and tag not in ("html", "body"):
            self._close_through({"p"}, SCOPES | {"button"})
        given = dict(attrs)
        folded = self._folded(tag)
        if tag in VOID:
            if not self.unseen and not folded:
                self._void(tag, given)
            return
        style = given.get("style") or ""
        hides = (tag in UNSEEN or (tag in SVG_UNSEEN and bool(self.places.get("svg"))) or "hidden" in given
                 or tag == "dialog" and "open" not in given or folded or bool(_HIDING.search(style)))
        if tag == "body":
            self._close_through({"head"}, ())
        around = self.veiled
        said = _VISIBILITY.findall(style)
        if said:
            self.veiled = said[-1].lower() != "visible"
        self.unseen += hides
        state = None if self.unseen else self._begin(tag, given)
        self.places.setdefault(tag, []).append(len(self.open))
        shut = [True] if tag == "details" and "open" not in given else None
        self.open.append((tag, hides, state, around, shut))
        self.fresh = tag in ("pre", "textarea")

    def _folded(self, tag: str) -> bool:
        """In closed details only the first summary shows."""
        shut = self.open[-1][4] if self.open else None
        if not shut:
            return False
        if tag == "summary" and shut[0]:
            shut[0] = False
            return False
        return True

    def _void(self, tag: str, given: dict) -> None:
        flow = self.flows[-1]
        if tag == "br":
            flow.line(keep=True)
        elif self.veiled:
            return
        elif tag == "hr":
            flow.block(1)
            flow.put(["---"])
            flow.block(1)
        elif tag == "img":
            flow.words(given.get("alt") or "")

    def _begin(self, tag: str, given: dict) -> object:
        flow = self.flows[-1]
        if tag in BLOCKS:
            flow.block(0 if tag in ("ul", "ol") and self.lists else MARGIN.get(tag, 0))
        if tag in ("ul", "ol", "menu"):
            step = -1 if tag == "ol" and "reversed" in given else 1
            items = next(self.reversed, 1) if step < 0 else 1
            start = _number(given.get("start"))
            self.lists.append([tag, items if start is None else start, step,
                               (given.get("type") or "").strip()])
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 1, 1, ""]
            value = _number(given.get("value"))
            if value is not None:
                kind[1] = value
            marker = f"{numbered(kind[1], kind[3])}. " if kind[0] == "ol" else "- "
            kind[1] += kind[2]
            flow.indent.append(" " * len(marker) if len(flow.indent) < DEEPEST else "")
            flow.marker = marker
        elif tag in ("blockquote", "dd"):
            flow.indent.append("  " if len(flow.indent) < DEEPEST else "")
        elif tag in ("pre", "textarea"):
            self.pre += 1
        elif tag == "table" and len(self.tables) >= DEEPEST:
            self.flat += 1
            return FLAT
        elif tag in ("td", "th") and self.flat:
            flow.block(0)
            return FLAT
        elif tag == "table":
            self.tables.append(Table())
        elif tag == "tfoot" and self.tables and not self.flat:
            self.tables[-1].now = self.tables[-1].foot
        elif tag == "tr" and self.tables and not self.flat:
            self.tables[-1].now.append([])
        elif tag in ("td", "th") and self.tables:
            table = self.tables[-1]
            if not table.now:
                table.now.append([])
            self.flows.append(Flow())
            return table, _span(given, "colspan", 1000), _span(given, "rowspan", 65534)
        elif tag in ("svg", "text"):
            self._apart(tag)
        return flow

    def _finish(self, tag: str, state: object) -> None:
        if isinstance(state, tuple):
            table, columns, rows = state
            table.now[-1].append((self.flows.pop().done(), columns, rows))
            return
        flow = self.flows[-1]
        if state is FLAT:
            self.flat -= tag == "table"
            flow.block(MARGIN.get(tag, 0))
            return
        if tag in BLOCKS:
            flow.block(0 if tag in ("ul", "ol") and len(self.lists) > 1 else MARGIN.get(tag, 0))
        if tag in ("ul", "ol", "menu"):
            self.lists.pop()
        elif tag == "li":
            flow.indent.pop()
            flow.marker = None
        elif tag in ("blockquote", "dd"):
            flow.indent.pop()
        elif tag in ("pre", "textarea"):
            self.pre -= 1
        elif tag == "tfoot" and self.tables and not self.flat:
            self.tables[-1].now = self.tables[-1].rows
        elif tag in ("svg", "text"):
            self._apart(tag)
        elif tag == "table":
            flow.put(self.tables.pop().lines())
            flow.block(1)

    def _apart(self, tag: str) -> None:
        """Texts of a drawing stand at places of their own."""
        if tag == "svg" or self.places.get("svg"):
            self.flows[-1].words(" ")

    def _close(self) -> None:
        tag, hides, state, around, _ = self.open.pop()
        self.places[tag].pop()
        if state is not None:
            self._finish(tag, state)
        self.unseen -= hides
        self.veiled = around

    def _close_through(self, tags, bounds) -> None:
        """Close up to the outermost of ``tags`` that no bound shields."""
        open_tags = [self.places[tag] for tag in tags if self.places.get(tag)]
        if not open_tags:
            return
        bound = self._innermost(bounds)
        last = min((places[at] for places in open_tags
                    if (at := bisect_right(places, bound)) < len(places)), default=None)
        if last is not None:
            while len(self.open) > last:
                self._close()

    def _innermost(self, tags) -> int:
        """Where the last open one of ``tags`` stands; -1 if there is none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=-1)

    def handle_endtag(self, tag: str) -> None:
        self.fresh = False
        at = self._innermost((tag,))
        if at < 0 or self._innermost(SCOPES) > at and tag not in (
                "table", "tr", "tbody", "thead", "tfoot", "body", "html"):
            return
        while len(self.open) > at:
            self._close()

    def handle_data(self, data: str) -> None:
        if self.cdata_elem == "textarea":
            data = entities.unescape(data)
        if self.fresh:
            data, self.fresh = re.sub(r"^\r?\n", "", data), False
        if self.unseen or self._innermost(("svg",)) > self._innermost(SVG_TEXT):
            return
        if self.open and (self.open[-1][4] or self.open[-1][0] in (
                "table", "tr", "tbody", "thead", "tfoot") and not data.strip()):
            return
        if self.veiled:
            data = " " if data[:1].isspace() or data[-1:].isspace() else ""
        (self.flows[-1].raw if self.pre else self.flows[-1].words)(data)

    def text(self) -> str:
        while self.open:
            self._close()
        return "\n".join(self.flows[0].done())


def visible_text(html: str | None) -> str:
    """The text of a page; empty for null. Any input has a result: there is no malformed page."""
    return Page(html or "").text()


def extract(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with its text in column ``name`` instead of the markup; other columns stay.

    A column ``name`` that is there already is replaced. A null page has the empty
    text, rows alike have equal texts, an empty table gives an empty one, and a page
    of any length is taken whole.
    """
    kept = [f for f in pages.schema.fields if f.name not in (html, name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([visible_text(v.as_py()) for v in batch[html]], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in kept), texts],
                                             names=[*(f.name for f in kept), name])

    return pages.mapInArrow(run, StructType([*kept, StructField(name, StringType())]))
