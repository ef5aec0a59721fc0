"""Visible text of HTML pages as a browser lays it out.

A tag scanner feeds a builder that keeps the stack of open elements, closes what a tag implies (a paragraph
before a block, list items, table cells and rows, the head before the body) and ignores stray end tags. A
renderer takes its open and close events: it drops what is not shown, collapses white space, keeps preformatted
lines, separates blocks, marks and indents list items, and aligns table cells in columns. Both work in one pass
without recursion, so nesting depth does not matter.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorepipe.llm import common

# Element sets of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes title textarea".split())
HEAD = frozenset("base basefont bgsound link meta title style script noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section summary table "
    "ul xmp caption tbody thead tfoot tr td th".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl blockquote figure pre listing table fieldset xmp".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li dd dt listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
)
SCOPE = frozenset("html table td th caption object template marquee applet".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu dir".split())
NEVER_SHOWN = frozenset("head script style template datalist audio video canvas iframe object noembed noframes rp title".split())

# What a start tag closes (the nearest open one of these) and where the search stops.
IMPLIED = {
    "li": (frozenset(["li"]), LISTS | SCOPE),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"]) | SCOPE),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"]) | SCOPE),
    "td": (frozenset(["td", "th", "caption"]), frozenset(["table", "html", "template"])),
    "th": (frozenset(["td", "th", "caption"]), frozenset(["table", "html", "template"])),
    "tr": (frozenset(["tr", "caption"]), frozenset(["table", "html", "template"])),
    **{t: (frozenset(["thead", "tbody", "tfoot", "tr", "caption"]), frozenset(["table", "html", "template"])) for t in ("thead", "tbody", "tfoot")},
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup", "html"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select", "datalist", "html"])),
}
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=(?!\s*["']))*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
BLANK = " \t\n\f\r"
BLANKS = re.compile(f"[{BLANK}]+")
WIDEST_ALIGNED = 80
"""Cells wider than this do not widen their column."""
MOST_INDENT = 64
"""Deeper lines are indented no further, so nesting cannot multiply the text."""
MOST_SPAN, MOST_SPANNED = 1000, 100_000
"""Empty cells that one spanning cell, and all those of a table, can add."""
LONG_NUMBER = re.compile(r"&#([0-9]{8,})(;?)")


def unescaped(text: str) -> str:
    """Character references resolved; numbers beyond all characters, however long, become U+FFFD."""

    def short(m: re.Match) -> str:
        digits = m[1].lstrip("0") or "0"
        return "\ufffd" if len(digits) > 7 else f"&#{digits}{m[2]}"

    return entities.unescape(LONG_NUMBER.sub(short, text)) if "&" in text else text


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescaped(m[2] or m[3] or m[4] or "") for m in reversed(list(ATTRIBUTE.finditer(source)))}


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attribute source): kinds are open, close, text and raw (the text of a raw element)."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        after = page[lt + 1 : lt + 2]
        if not (after.isascii() and after.isalpha()) and after not in ("/", "!", "?"):
            lt += 1
            yield "text", page[at:lt], ""
            at = lt
            continue
        if lt > at:
            yield "text", page[at:lt], ""
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2)
            at = n if end < 0 else end + 3
            continue
        m = TAG.match(page, lt)
        if not m:
            if after.isalpha() or (after == "/" and page[lt + 2 : lt + 3].isalpha()):
                return  # a tag that never ends swallows the rest
            end = page.find(">", lt)  # a declaration or an empty end tag
            at = n if end < 0 else end + 1
            continue
        name, at = m[2].lower(), m.end()
        if m[1]:
            yield "close", name, ""
            continue
        yield "open", name, m[3]
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            stop = end.start() if end else n
            yield "raw", page[at:stop], ""
            at = stop
        elif name == "plaintext":
            yield "raw", page[at:], ""
            return


def width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Writer:
    """Lines of one flow: a page or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # blank lines due before the next line
        self.space = False
        self.indent = ""
        self.mark: str | None = None

    def start(self) -> None:
        if not self.line:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            lead = self.indent[:MOST_INDENT]
            if self.mark is not None:
                lead = self.indent[: len(self.indent) - len(self.mark)][:MOST_INDENT] + self.mark
                self.mark = None
            self.line.append(lead)
            self.space = False

    def flow(self, text: str) -> None:
        words = [w for w in BLANKS.split(text) if w]
        if not words:
            self.space |= bool(text) and bool(self.line)
            return
        fresh = not self.line
        self.start()
        if not fresh and (self.space or text[0] in BLANK):
            self.line.append(" ")
        self.line.append(" ".join(words))
        self.space = text[-1] in BLANK

    def verbatim(self, text: str) -> None:
        for i, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                self.end_line(True)
            if part:
                self.start()
                self.line.append(part)

    def end_line(self, even_if_empty: bool = False) -> None:
        if not self.line and even_if_empty:
            self.start()
        if self.line:
            self.lines.append("".join(self.line).rstrip(BLANK))
            self.line = []
        self.space = False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def whole(self) -> list[str]:
        self.end_line()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


class Table:
    def __init__(self):
        self.rows: list[list[list[str]]] = []
        self.spanned = 0

    def cells(self, new_row: bool) -> list[list[str]]:
        if new_row or not self.rows:
            self.rows.append([])
        return self.rows[-1]

    def aligned(self) -> list[str]:
        rows = [r for r in self.rows if any(any(c) for c in r)]
        columns = max(map(len, rows), default=0)
        wide = [0] * columns
        for row in rows:
            for i, cell in enumerate(row):
                wide[i] = max([wide[i], *(w for w in map(width, cell) if w <= WIDEST_ALIGNED)])
        out = []
        for row in rows:
            for k in range(max(map(len, row))):
                parts = []
                for i, cell in enumerate(row):
                    part = cell[k] if k < len(cell) else ""
                    parts.append(part if i == len(row) - 1 else part + " " * max(0, wide[i] - width(part)))
                out.append("  ".join(parts).rstrip(BLANK))
        return out


class Renderer:
    def __init__(self):
        self.open: list[tuple] = []  # (tag, hidden, invisible, preformatted, what to restore)
        self.writers = [Writer()]
        self.tables: list[Table] = []
        self.counters: list[int | None] = []
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}  # where each name stands open, so that nothing is searched for

    def last(self, tags: frozenset) -> int:
        """Position of the innermost open element of these names, -1 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def pop(self) -> None:
        tag, hidden, _, _, kept = self.open.pop()
        self.places[self.names.pop()].pop()
        if hidden or tag not in BLOCKS:
            return
        w = self.writers[-1]
        if tag in ("td", "th", "caption") and kept is not None:
            lines = self.writers.pop().whole()
            if tag == "caption":
                self.tables[-1].rows.insert(0, [lines])
            else:  # its own place, whatever rows came since
                row, at = kept
                row[at] = lines
        elif tag == "table":
            lines = self.tables.pop().aligned()
            w.block(1 if w.lines else 0)
            for line in lines:
                w.start()
                w.line.append(line)
                w.end_line(True)
            w.block(1)
        elif tag == "li":
            w.end_line()
            w.indent, w.mark = w.indent[: len(w.indent) - kept], None
        elif tag in LISTS:
            self.counters.pop()
            w.block(0 if self.counters else 1)
        elif tag in ("blockquote", "dd"):
            w.block(1 if tag in SPACED else 0)
            w.indent = w.indent[:-4]
        else:
            w.block(1 if tag in SPACED else 0)

    def close_to(self, wanted: frozenset, stop: frozenset) -> bool:
        at = self.last(wanted)
        if at < 0 or at < self.last(stop):
            return False
        while len(self.names) > at:
            self.pop()
        return True

    def start_tag(self, tag: str, source: str) -> None:
        if tag in ("head", "html", "body") and self.places.get(tag):
            return
        if self.names and self.names[-1] == "head" and tag not in HEAD:
            self.pop()
        if tag in CLOSES_P:
            self.close_to(frozenset(["p"]), SCOPE | {"button"})
        if tag in HEADINGS and self.names and self.names[-1] in HEADINGS:
            self.pop()
        if tag in IMPLIED:
            self.close_to(*IMPLIED[tag])
        if tag in ("td", "th") and 0 <= self.last_table() > self.last(frozenset(["tr"])):
            self.start_tag("tr", "")
        given = attributes(source) if source else {}
        _, hidden, invisible, pre, _ = self.open[-1] if self.open else ("", False, False, False, None)
        style = re.sub(r"\s", "", given.get("style", "")).lower() if "style" in given else ""
        hidden = hidden or tag in NEVER_SHOWN or "hidden" in given or "display:none" in style or (tag == "dialog" and "open" not in given)
        if self.open and self.open[-1][0] == "details" and self.open[-1][4] == "shut" and tag != "summary":
            hidden = True
        if "visibility:" in style:
            invisible = "visibility:hidden" in style or "visibility:collapse" in style
        pre = pre or tag in ("pre", "listing", "xmp", "plaintext", "textarea")
        if "white-space:" in style:
            pre = "white-space:pre" in style
        w, kept = self.writers[-1], None
        if not hidden:
            if tag == "br":
                w.end_line(True)
            elif tag == "hr":
                w.block(0)
                w.start()
                w.line.append("---")
                w.block(0)
            elif tag in ("td", "th", "caption") and self.last_table() >= 0:
                if tag != "caption":
                    span = given.get("colspan", "1")
                    table = self.tables[-1]
                    row = table.cells(False)
                    spans = int(span) if re.fullmatch("[0-9]{1,6}", span) and 0 < int(span) <= MOST_SPAN else 1
                    more = min(spans - 1, MOST_SPANNED - table.spanned)
                    table.spanned += more
                    row += [[]] * more
                    row.append([])
                    kept = (row, len(row) - 1)
                else:
                    kept = "caption"
                self.writers.append(Writer())
            elif tag == "tr" and self.tables:
                self.tables[-1].cells(True)
            elif tag == "table":
                w.block(1)
                self.tables.append(Table())
            elif tag in LISTS:
                w.block(0 if self.counters else 1)
                first = given.get("start", "1")
                self.counters.append(None if tag != "ol" else int(first) if re.fullmatch("-?[0-9]{1,9}", first) else 1)
            elif tag == "li":
                w.block(0)
                mark = "* "
                if self.counters and self.counters[-1] is not None:
                    mark = f"{self.counters[-1]}. "
                    self.counters[-1] += 1
                w.mark, kept = mark, len(mark)
                w.indent += " " * kept
            elif tag in ("blockquote", "dd"):
                w.block(1 if tag in SPACED else 0)
                w.indent += "    "
            elif tag in BLOCKS:
                w.block(1 if tag in SPACED else 0)
        if tag == "details":
            kept = "open" if "open" in given else "shut"
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.names))
            self.open.append((tag, hidden, invisible, pre, kept))
            self.names.append(tag)

    def last_table(self) -> int:
        at = self.last(frozenset(["table"]))
        return -1 if at < 0 or self.open[at][1] else at

    def end_tag(self, tag: str) -> None:
        if tag == "br":
            return self.start_tag("br", "")
        if tag in ("body", "html") or tag in VOID:
            return None  # what follows still belongs to the page
        if tag in TABLE_PARTS:
            stop = frozenset(["html", "template"]) if tag == "table" else frozenset(["html", "table", "template"])
        elif tag in HEADINGS:
            self.close_to(HEADINGS, SCOPE)
            return None
        else:
            stop = SCOPE | (LISTS if tag == "li" else frozenset())
        self.close_to(frozenset([tag]), stop)
        return None

    def text(self, source: str) -> None:
        if self.names and self.names[-1] == "head" and source.strip(BLANK):
            self.pop()
        tag, hidden, invisible, pre, kept = self.open[-1] if self.open else ("", False, False, False, None)
        if hidden or invisible or (tag == "details" and kept == "shut"):
            return
        if tag in ("table", "thead", "tbody", "tfoot", "tr") and not source.strip(BLANK):
            return
        shown = unescaped(source)
        if pre:
            self.writers[-1].verbatim(shown)
        else:
            self.writers[-1].flow(shown)

    def raw(self, source: str) -> None:
        tag, hidden, invisible, _, _ = self.open[-1]
        if not hidden and not invisible:
            self.writers[-1].verbatim(unescaped(source) if tag == "textarea" else source)


def rendered(page: str | None) -> str:
    """All visible text of one page; lines are separated by newlines. Null and empty pages give the empty text."""
    r = Renderer()
    first_in_pre = False
    for kind, name, source in events(page or ""):
        if kind == "text":
            if first_in_pre and name.startswith("\n"):
                name = name[1:]
            first_in_pre = False
            if name:
                r.text(name)
            continue
        first_in_pre = kind == "open" and name in ("pre", "listing")
        if kind == "open":
            r.start_tag(name, source)
        elif kind == "close":
            r.end_tag(name)
        else:
            r.raw(name)
    while r.open:
        r.pop()
    return "\n".join(r.writers[0].whole())


def page_texts(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, text, n_chars, n_lines) of every row.

    Null and empty pages, and pages without visible text, give the empty text with no lines. Repeated rows and
    null ids give a row each; extra columns are ignored; an empty table gives no rows. Whole pages are rendered;
    a page is one task's work, so memory follows the largest page.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [rendered(h) for h in part.column(1).to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                lines = pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), sizes, lines], ["page_id", "text", "n_chars", "n_lines"])

    plain = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(html).cast("string").alias("html"))
    return plain.mapInArrow(common.lean(work), "page_id BIGINT, text STRING, n_chars BIGINT, n_lines BIGINT")
