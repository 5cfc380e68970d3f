"""Visible text of one page of HTML, laid out: blocks, lists and aligned tables.

``events`` turns markup into balanced opens, texts and closes, with the end
tags that HTML lets authors leave out; ``render`` lays them out. Nothing is
recursive, so depth of nesting does not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


# What the HTML standard says of its elements.
VOID = _names("area base br col embed hr img input link meta param source track wbr")
BLOCKS = _names("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
                "search section summary table tbody td tfoot th thead tr ul caption select")
HEADINGS = _names("h1 h2 h3 h4 h5 h6")
SPACED = HEADINGS | _names("p ul ol menu dl pre blockquote table figure")
CLOSES_P = _names("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt")
UNSEEN = _names("head script style template noscript iframe object audio video canvas datalist title noframes")
RAW = _names("script style iframe noframes textarea title xmp noembed")
HEAD_ONLY = _names("base link meta title style script noscript template")
LISTS = _names("ul ol menu dir")
SECTIONS = _names("thead tbody tfoot")
CELLS = _names("td th")
# An element left open ends at one of the first, searched no further than the second.
IMPLIED_END = {
    "li": (_names("li"), LISTS | CELLS), "dt": (_names("dt dd"), _names("dl td th")),
    "dd": (_names("dt dd"), _names("dl td th")), "option": (_names("option"), _names("select optgroup")),
    "optgroup": (_names("option optgroup"), _names("select")), "td": (CELLS, _names("table tr")),
    "th": (CELLS, _names("table tr")), "tr": (_names("tr caption"), _names("table")),
    "thead": (SECTIONS | _names("tr caption"), _names("table")),
    "tbody": (SECTIONS | _names("tr caption"), _names("table")),
    "tfoot": (SECTIONS | _names("tr caption"), _names("table")), "body": (_names("head"), _names("body")),
}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*>?"
    r"""|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<(?P<broken>[a-zA-Z][^\s/>]*)[^>]*>?", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_OFF = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)
_BLANKS = re.compile(r"[ \t\n\f\r]+")


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        value = value[1:-1] if value[:1] in ("'", '"') else value
        found.setdefault(name.lower(), unescape(value))
    return found


def events(html: str) -> Iterator[tuple[str, str, dict]]:
    """("open", tag, attributes), ("text", text, {}) and ("close", tag, {}), balanced."""
    stack: list[str] = []
    at, size = 0, len(html)

    def close_to(depth: int):
        while len(stack) > depth:
            yield "close", stack.pop(), {}

    def find(wanted, stop) -> int | None:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth] in wanted:
                return depth
            if stack[depth] in stop:
                return None
        return None

    while at < size:
        match = _TOKEN.search(html, at)
        begin = match.start() if match else size
        if begin > at:
            text = html[at:begin]
            if "head" in stack and stack[-1] == "head" and text.strip():
                yield from close_to(stack.index("head"))
            yield "text", unescape(text) if "&" in text else text, {}
        if not match:
            break
        at = match.end()
        tag = (match["open"] or match["broken"] or "").lower()
        if tag:
            if stack and stack[-1] == "head" and tag not in HEAD_ONLY and tag != "head":
                yield from close_to(len(stack) - 1)
            if tag in IMPLIED_END:
                wanted, stop = IMPLIED_END[tag]
                # The outermost of those left open inside the same container.
                depth = found = find(wanted, stop)
                while found is not None and found and (found := next(
                        (i for i in range(found - 1, -1, -1) if stack[i] in wanted or stack[i] in stop), None)) is not None:
                    if stack[found] in stop:
                        break
                    depth = found
                if depth is not None:
                    yield from close_to(depth)
            if tag in CLOSES_P and (depth := find({"p"}, _SCOPE)) is not None:
                yield from close_to(depth)
            if tag in HEADINGS and stack and stack[-1] in HEADINGS:
                yield from close_to(len(stack) - 1)
            if tag in CELLS or tag == "tr" or tag in SECTIONS:
                if find({"table"}, ()) is None:
                    continue  # no table to be part of
                if tag in CELLS and find({"tr"}, {"table"}) is None:
                    stack.append("tr")
                    yield "open", "tr", {}
            attributes = _attributes(match["attrs"]) if match["attrs"] and match["attrs"].strip(" /") else {}
            yield "open", tag, attributes
            if tag in VOID:
                yield "close", tag, {}
                continue
            stack.append(tag)
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(html, at)
                inside = html[at:end.start() if end else size]
                if tag == "textarea":
                    yield "text", unescape(inside), {}
                at = end.end() if end else size
                yield from close_to(len(stack) - 1)
        elif match["close"]:
            tag = match["close"].lower()
            if tag == "br":
                yield "open", "br", {}
                yield "close", "br", {}
                continue
            if tag in ("body", "html"):
                continue  # what follows them still belongs to the body
            stop = {"table"} if tag in CELLS or tag == "tr" or tag in SECTIONS else \
                () if tag == "table" else _SCOPE if tag in BLOCKS else BLOCKS
            depth = find({tag}, stop)
            if depth is not None:
                yield from close_to(depth)
        elif match[0].startswith("<![CDATA["):
            yield "text", match[0][9:-3], {}
    yield from close_to(0)


_SCOPE = _names("table td th caption template button object")


class Flow:
    """Text that grows by runs and breaks; breaks next to each other count once, the largest."""

    def __init__(self):
        self.parts: list[str] = []
        self.breaks, self.blank = 0, False
        self.indent: list[str] = []
        self.marker = ""

    def block(self, lines: int) -> None:
        self.breaks, self.blank = max(self.breaks, lines), False

    def _begin(self) -> None:
        if self.breaks or not self.parts:
            if self.parts:
                self.parts.append("\n" * self.breaks)
            if self.marker:
                self.parts.append("".join(self.indent[:-1]) + self.marker)
                self.marker = ""
            else:
                self.parts.append("".join(self.indent))
            self.breaks = 0
        elif self.blank:
            self.parts.append(" ")
        self.blank = False

    def text(self, text: str) -> None:
        words = _BLANKS.sub(" ", text)
        if words.strip(" ") == "":
            self.blank = self.blank or (bool(words) and not self.breaks)
            return
        if words[0] == " " and not self.breaks:
            self.blank = True
        self._begin()
        self.parts.append(words.strip(" "))
        self.blank = words[-1] == " "

    def line_break(self) -> None:
        self.breaks, self.blank = self.breaks + 1 if self.parts else 0, False

    def lines(self, text: str) -> None:
        """Text whose own lines stay as they are."""
        for i, line in enumerate(text.split("\n")):
            if i:
                self.line_break()
            if line:
                self._begin()
                self.parts.append(line)

    def result(self) -> str:
        return "\n".join(line.rstrip(" ") for line in "".join(self.parts).split("\n")).strip("\n")


def _span(value: str | None) -> int:
    """The columns of a cell. HTML itself allows 1,000 at most; anything but ASCII digits counts as one column."""
    if not value or not (value.isascii() and value.isdigit()):
        return 1
    digits = value.lstrip("0")
    return 1000 if len(digits) > 4 else max(1, min(int(digits or 0), 1000))


def aligned(rows: list[list[tuple[str, int]]]) -> str:
    """Rows of (text, columns spanned) with every column as wide as its widest single cell."""
    widths: dict[int, int] = {}
    for row in rows:
        column = 0
        for text, span in row:
            if span == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, text.split("\n"))))
            column += span
    out = []
    for row in rows:
        cells = [(text.split("\n"), span) for text, span in row]
        for k in range(max((len(lines) for lines, _ in cells), default=0)):
            column, line = 0, ""
            for lines, span in cells:
                width = sum(widths.get(c, 0) for c in range(column, column + span)) + 2 * (span - 1)
                line += (lines[k] if k < len(lines) else "").ljust(width) + "  "
                column += span
            out.append(line.rstrip(" "))
    return "\n".join(out)


def render(html: str) -> str:
    """The visible text of a page."""
    flows = [Flow()]
    tables: list[list] = []
    counters: list[int | None] = []
    hidden, pre = 0, 0
    open_tags: list[tuple[str, bool]] = []
    for kind, name, attributes in events(html):
        flow = flows[-1]
        if kind == "text":
            if not hidden and (not open_tags or open_tags[-1][0] not in ("table", "tr", "thead", "tbody", "tfoot")
                               or name.strip()):
                flow.lines(name) if pre else flow.text(name)
        elif kind == "open":
            off = name in UNSEEN or "hidden" in attributes or bool(_OFF.search(attributes.get("style", ""))) \
                or (name == "dialog" and "open" not in attributes)
            open_tags.append((name, off))
            hidden += off
            if hidden:
                continue
            if name in BLOCKS:
                # Lists in lists and in cells follow their item closely.
                flow.block(2 if name in SPACED and not (name in LISTS and counters) else 1)
            if name == "br":
                flow.line_break()
            elif name in LISTS:
                start = attributes.get("start", "1")
                counters.append(int(start) if name == "ol" and re.fullmatch(r"-?\d{1,9}", start)
                                else 1 if name == "ol" else None)
            elif name == "li":
                number = counters[-1] if counters else None
                flow.marker = "- " if number is None else f"{number}. "
                if number is not None:
                    counters[-1] = number + 1
                flow.indent.append(" " * len(flow.marker))
            elif name in ("dd", "blockquote"):
                flow.indent.append("    ")
            elif name in ("pre", "textarea", "xmp", "listing"):
                pre += 1
            elif name == "table":
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in CELLS and tables:
                flows.append(Flow())
                open_tags[-1] = (name, off)
                tables[-1][-1].append(("", _span(attributes.get("colspan"))))
            elif name == "img" and attributes.get("alt", "").strip():
                flow.text(attributes["alt"])
        else:
            _, off = open_tags.pop()
            if hidden:
                hidden -= off
                continue
            if name in CELLS and tables:
                text = flows.pop().result()
                tables[-1][-1][-1] = (text, tables[-1][-1][-1][1])
                continue
            if name == "table" and tables:
                flow.block(2)
                flow.lines(aligned(tables.pop()))
            elif name in LISTS and counters:
                counters.pop()
            elif name == "li":
                flow.indent.pop()
                flow.marker = ""
            elif name in ("dd", "blockquote"):
                flow.indent.pop()
            elif name in ("pre", "textarea", "xmp", "listing"):
                pre -= 1
            if name in BLOCKS:
                flow.block(2 if name in SPACED and not (name in LISTS and counters) else 1)
    return flows[0].result()
