"""Visible text of HTML pages, laid out.

A tree builder adds the end tags HTML leaves out; a renderer walks the tree and emits what a
reader sees: blocks on lines of their own, paragraphs and headings apart by an empty line,
list items with marks and indents, table rows as lines of aligned cells, preformatted text as it stands.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset(
    "head script style template noscript iframe noembed noframes title meta link base object audio video canvas datalist param source track "
    "desc metadata defs annotation annotation-xml".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre figure table hr fieldset".split())
TABLE_PARTS = frozenset("caption colgroup thead tbody tfoot tr td th".split())
# Start tag: open elements it ends, and the elements beyond which it does not look.
ENDS_P = BLOCK - frozenset("body html li dd dt legend option optgroup select summary".split())
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
#: What an open head may hold; any other start tag, or text, ends it.
IN_HEAD = frozenset("html head title meta link base basefont bgsound script style template noscript noframes".split())
#: Elements nested deeper are not opened; their text goes to the innermost open one, if it is visible.
MAX_DEPTH = 200

START = re.compile(r"<([a-zA-Z][^\s/>]*)")
END = re.compile(r"</([a-zA-Z][^\s/>]*)")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"[ \t\n\r\f]+")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)


class Node:
    __slots__ = ("tag", "fields", "children")

    def __init__(self, tag: str, fields: dict[str, str]):
        self.tag, self.fields = tag, fields
        self.children: list[Node | str] = []


class _Tags:
    """Ends of tags in a page, each found in one forward pass: what a search has shown not to lie ahead is not searched
    for again, so any number of unclosed tags and quotes costs one pass more, not one each."""

    def __init__(self, page: str):
        self.page = page
        self.open_quotes: set[int] = set()  # quotes from which no end was found
        self.missing: dict[str, int] = {}  # what does not occur from a place on
        self.stop = (0, -1)  # no quote or end from the first place up to the second

    def find(self, text: str, at: int) -> int:
        if at >= self.missing.get(text, len(self.page) + 1):
            return -1
        found = self.page.find(text, at)
        if found < 0:
            self.missing[text] = at
        return found

    def _next_stop(self, at: int) -> int:
        begin, end = self.stop
        if not begin <= at <= end:
            match = STOP.search(self.page, at)
            self.stop = at, match.start() if match else len(self.page)
        return self.stop[1]

    def end(self, at: int) -> int:
        """The place of the ``>`` that ends a start tag whose name ends at ``at``; -1 without one."""
        seen = []
        while True:
            at = self._next_stop(at)
            if at == len(self.page) or at in self.open_quotes:
                break
            if self.page[at] == ">":
                return at
            seen.append(at)
            close = self.find(self.page[at], at + 1)
            if close < 0:
                break
            at = close + 1
        self.open_quotes.update(seen)
        return -1


class _Deep:
    """Elements beyond ``MAX_DEPTH``, which are counted but not opened."""

    def __init__(self) -> None:
        self.tags: list[tuple[str, bool]] = []
        self.counts: Counter[str] = Counter()
        self.hidden = 0

    def start(self, node: Node) -> None:
        shown = VISIBILITY.search(node.fields.get("style", ""))
        hides = not _seen(node) or (shown is not None and shown[1].lower() != "visible")
        self.tags.append((node.tag, hides))
        self.counts[node.tag] += 1
        self.hidden += hides

    def end(self, tag: str) -> bool:
        """End the innermost element of this tag and those in it; False without one."""
        if not self.counts[tag]:
            return False
        while True:
            ended, hides = self.tags.pop()
            self.counts[ended] -= 1
            self.hidden -= hides
            if ended == tag:
                return True


def parse(page: str) -> Node:
    """The tree of a page.  Never fails: stray ends are ignored, open elements end with their parent.  Time grows with
    the length of the page, whatever is unclosed in it."""
    root = Node("html", {})
    stack, deep, tags = [root], _Deep(), _Tags(page)
    at, size = 0, len(page)

    def text(begin: int, end: int) -> None:
        if stack[-1].tag == "head" and page[begin:end].strip(" \t\n\r\f"):
            stack.pop()
        if not deep.hidden:
            stack[-1].children.append(html.unescape(page[begin:end]))

    while at < size:
        if page[at] != "<":
            end = tags.find("<", at)
            text(at, end if end >= 0 else size)
            at = end if end >= 0 else size
            continue
        if page.startswith("<!--", at):
            end = tags.find("-->", at + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page[at + 1 : at + 2] in ("!", "?"):
            end = tags.find(">", at + 2)
            if end >= 0:
                at = end + 1
                continue
        elif match := END.match(page, at):
            end = tags.find(">", match.end())
            if end >= 0:
                tag, before = match[1].lower(), len(stack)
                if not deep.end(tag):
                    _end(stack, tag)
                    if len(stack) < before:
                        deep = _Deep()
                at = end + 1
                continue
        elif match := START.match(page, at):
            end = tags.end(match.end())
            if end >= 0:
                node = Node(match[1].lower(), _fields(page[match.end() : end]))
                at = end + 1
                if deep.tags:
                    if not deep.hidden:
                        stack[-1].children.append(node)
                else:
                    _start(stack, node)
                if node.tag in VOID:
                    continue
                if node.tag in RAW:
                    begin, (stop, at) = at, _raw_end(page, node.tag, at, tags)
                    body = page[begin:stop]
                    node.children.append(html.unescape(body) if node.tag in ("title", "textarea") else body)
                elif deep.tags or len(stack) >= MAX_DEPTH:
                    deep.start(node)
                else:
                    stack.append(node)
                    if node.tag == "pre":  # a line break right behind it is none of its text
                        at += page.startswith("\n", at) + 2 * page.startswith("\r\n", at)
                continue
        text(at, at + 1)
        at += 1
    return root


def _fields(inside: str) -> dict[str, str]:
    fields: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(inside):
        fields.setdefault(name.lower(), html.unescape(a or b or c))
    return fields


def _raw_end(page: str, tag: str, at: int, tags: _Tags) -> tuple[int, int]:
    """Where the text of a raw element ends, and where what follows it begins."""
    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
    end = tags.find(">", close.end()) if close else -1
    return (close.start(), end + 1) if end >= 0 else (len(page), len(page))


def _start(stack: list[Node], node: Node) -> None:
    tag = node.tag
    ends, beyond = IMPLIED.get(tag, (None, None))
    if ends:
        _close(stack, ends, beyond)
    if tag in ENDS_P:
        _close(stack, {"p"}, {"td", "th", "caption", "button", "object", "table"})
    if tag in ("body", "html") and len(stack) > 0:
        for opened in stack:
            if opened.tag == tag:
                opened.fields.update({k: v for k, v in node.fields.items() if k not in opened.fields})
                node.children = opened.children  # the tags merge
                return
    if stack[-1].tag == "head" and tag not in IN_HEAD:
        stack.pop()
    if tag == "body" and any(opened.tag == "head" for opened in stack):
        _close(stack, {"head"}, set())
    stack[-1].children.append(node)


def _close(stack: list[Node], ends: set[str], beyond: set[str]) -> None:
    """End the outermost open element of ``ends`` that no element of ``beyond`` shields."""
    found = 0
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in beyond:
            break
        if stack[k].tag in ends:
            found = k
    if found:
        del stack[found:]


def _end(stack: list[Node], tag: str) -> None:
    if tag in ("br", "p") and (tag == "br" or all(n.tag != "p" for n in stack)):
        stack[-1].children.append(Node(tag, {}))
        return
    shield = {"table"} if tag not in ("table", "body", "html") else set()
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        if stack[k].tag in shield or (stack[k].tag in ("td", "th") and tag not in TABLE_PARTS | {"table", "body", "html"}):
            return


class _Text:
    """Lines under construction.  ``gap`` is the number of line ends owed before the next text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = 0
        self.keep = False  # spaces at the ends of the line under construction stay
        self.prefix, self.mark = "", None

    def add(self, text: str) -> None:
        pieces = SPACE.sub(" ", text)
        if pieces.startswith(" "):
            self.space = True
            pieces = pieces[1:]
        if not pieces:
            return
        self._open()
        if self.space and self.parts:
            self.parts.append(" ")
        self.space = pieces.endswith(" ")
        self.parts.append(pieces[:-1] if self.space else pieces)

    def add_line(self, line: str) -> None:
        """A finished line, spaces kept."""
        self.end(1)
        self.add_raw(line)
        self.end(1)

    def add_raw(self, text: str) -> None:
        self._open()
        self.parts.append(text)
        self.keep = True

    def _open(self) -> None:
        if not self.parts:
            if self.lines and self.gap > 1:
                self.lines.append("")
            self.gap = 0
            self.space = False

    def end(self, gap: int) -> None:
        if self.parts:
            line = "".join(self.parts)
            head = self.prefix
            if self.mark is not None:
                head, self.mark = self.mark, None
            self.lines.append(head + (line if self.keep else line.strip(" ")))
            self.parts = []
        self.keep = False
        self.space = False
        self.gap = max(self.gap, gap)


def _seen(node: Node) -> bool:
    fields = node.fields
    if node.tag in UNSEEN or "hidden" in fields:
        return False
    if node.tag == "input" and fields.get("type", "").lower() == "hidden":
        return False
    if node.tag == "dialog" and "open" not in fields:
        return False
    return not HIDDEN_STYLE.search(fields.get("style", ""))


def _render(node: Node, out: _Text, visible: bool, depth: int, pre: bool) -> None:
    for child in node.children:
        if isinstance(child, str):
            if not visible:
                continue
            if pre:
                for k, line in enumerate(child.replace("\r\n", "\n").split("\n")):
                    if k:
                        out.end(1)
                    out.add_raw(line)
            else:
                out.add(child)
            continue
        if not _seen(child):
            continue
        tag = child.tag
        shown = VISIBILITY.search(child.fields.get("style", ""))
        seen = visible if shown is None else shown[1].lower() == "visible"
        if tag == "br":
            if seen:
                out.end(1) if out.parts else out.lines and out.lines.append("")
            continue
        if tag == "hr":
            out.end(2)
            continue
        if tag == "textarea":
            if seen:
                out.add(" " + "".join(c for c in child.children if isinstance(c, str)) + " ")
            continue
        if tag == "input":
            if seen and child.fields.get("type", "text").lower() in ("submit", "button", "reset", "text"):
                out.add(" " + child.fields.get("value", "") + " ")
            continue
        if tag == "table":
            out.end(2)
            for line in _table(child, seen, depth + 1):
                out.add_line(line)
            out.end(2)
            continue
        block = tag in BLOCK or tag in TABLE_PARTS
        if not block:
            _render(child, out, seen, depth + 1, pre)
            continue
        nested_list = tag in ("ul", "ol", "dl") and out.prefix
        gap = 2 if tag in SPACED and not nested_list else 1
        out.end(gap)
        prefix, mark = out.prefix, out.mark
        if tag in ("ul", "ol", "menu", "dir"):
            _list(child, out, seen, depth + 1)
        elif tag == "details" and "open" not in child.fields:
            shut = Node("div", {})
            shut.children = [c for c in child.children if isinstance(c, Node) and c.tag == "summary"][:1]
            _render(shut, out, seen, depth + 1, pre)
        else:
            if tag in ("blockquote", "dd"):
                out.prefix += "    "
            _render(child, out, seen, depth + 1, pre or tag == "pre")
        out.end(gap)
        out.prefix = prefix
        del mark


def _list(node: Node, out: _Text, visible: bool, depth: int) -> None:
    numbered = node.tag == "ol"
    start = node.fields.get("start", "")
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    loose = Node("div", {})
    prefix = out.prefix
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li":
            if not _seen(child):
                continue
            value = child.fields.get("value", "")
            number = int(value) if numbered and re.fullmatch(r"-?\d{1,9}", value) else number
            bullet = f"{number}. " if numbered else "- "
            number += 1
            shown = VISIBILITY.search(child.fields.get("style", ""))
            seen = visible if shown is None else shown[1].lower() == "visible"
            out.end(1)
            out.mark, out.prefix = prefix + bullet, prefix + " " * len(bullet)
            _render(child, out, seen, depth + 1, False)
            out.end(1)
            out.mark, out.prefix = None, prefix
        else:
            loose.children = [child]
            _render(loose, out, visible, depth + 1, False)
    out.prefix = prefix


def _table(node: Node, visible: bool, depth: int) -> list[str]:
    """Caption, then rows as lines; columns are as wide as their widest cell, two spaces apart."""
    caption: list[str] = []
    rows: list[tuple[Node, bool]] = []
    stray = Node("div", {})

    def gather(part: Node, shown: bool) -> None:
        for child in part.children:
            if isinstance(child, str):
                stray.children.append(child)
            elif not _seen(child):
                continue
            elif child.tag in ("thead", "tbody", "tfoot"):
                gather(child, _visible(child, shown))
            elif child.tag == "tr":
                rows.append((child, _visible(child, shown)))
            elif child.tag in ("td", "th"):
                lone = Node("tr", {})
                lone.children.append(child)
                rows.append((lone, shown))
            elif child.tag == "caption":
                caption.extend(_lines(child, _visible(child, shown), depth))
            elif child.tag != "colgroup":
                stray.children.append(child)

    gather(node, visible)
    grid: list[list[list[str]]] = []
    spans: list[int] = []  # rows a cell above still reaches down, by column
    for row, shown in rows:
        line: list[list[str]] = []
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                stray.children.append(cell)
                continue
            if not _seen(cell):
                continue
            while len(line) < len(spans) and spans[len(line)] > 0:
                line.append([])
            across, down = (_span(cell, name) for name in ("colspan", "rowspan"))
            first = len(line)
            line.append(_lines(cell, _visible(cell, shown), depth))
            line.extend([] for _ in range(across - 1))
            spans.extend(0 for _ in range(len(line) - len(spans)))
            for k in range(first, len(line)):
                spans[k] = down
        spans = [max(0, s - 1) for s in spans]
        grid.append(line)
    width: list[int] = []
    for line in grid:
        for k, cell in enumerate(line):
            if k == len(width):
                width.append(0)
            width[k] = max(width[k], max(map(len, cell), default=0))
    out = _lines(stray, visible, depth) + caption
    for line in grid:
        for h in range(max(map(len, line), default=0)):
            text = "  ".join((cell[h] if h < len(cell) else "").ljust(width[k]) for k, cell in enumerate(line))
            out.append(text.rstrip(" "))
    return out


def _span(cell: Node, name: str) -> int:
    text = cell.fields.get(name, "")
    return min(max(int(text), 1), 1000) if re.fullmatch(r"\d{1,6}", text) else 1


def _visible(node: Node, visible: bool) -> bool:
    shown = VISIBILITY.search(node.fields.get("style", ""))
    return visible if shown is None else shown[1].lower() == "visible"


def _lines(node: Node, visible: bool, depth: int) -> list[str]:
    out = _Text()
    _render(node, out, visible, depth, False)
    out.end(0)
    return [line for line in out.lines if line.strip(" ")]


def render(page: str | None) -> str | None:
    """Visible text of a page; null stays null, a page without text gives an empty one."""
    if page is None:
        return None
    out = _Text()
    _render(parse(page), out, True, 0, False)
    out.end(0)
    return "\n".join(out.lines).strip("\n")


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [render(page) for page in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["page_id"], pa.array(texts, pa.string())], names=["page_id", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, text`` of every page.

    ``pages`` needs ``page_id, html``; other columns are ignored.  Null html gives a null text, empty html an empty one;
    repeated rows are rendered each; no rows give no rows.  One pass without a shuffle; a task holds a batch of pages.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "html").mapInArrow(_pages, f"page_id {kind}, text string")
