"""Visible text of web pages, laid out as a reader would see it.

A page becomes a tree: tags that HTML lets an author leave out are implied, stray end tags are ignored, and raw
text elements end only at their own end tag.  What a browser would not show is left out; formulas stand as the text
of their signs, without annotations, and of drawings the labels are taken.  The tree is then laid
out: block elements stand on lines of their own, those with a margin between blank lines, lists have markers and
indents, preformatted text keeps its white space and the cells of a table line up in columns.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import chunks

# Element names by how they are parsed and laid out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
UNSEEN = frozenset(
    "head script style title template noscript iframe noembed noframes datalist object audio video canvas"
    " annotation annotation-xml mphantom".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre xmp dl figure hr fieldset table menu ul ol details".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside nav header footer main address center form li dt dd figcaption"
    " summary legend caption tr option optgroup hgroup search dialog dir".split()
)
CLOSES_P = (BLOCK - frozenset("html body li dt dd tr caption option optgroup legend".split())) | {"li", "dt", "dd"}
# Start tag -> (open elements that it ends, elements beyond which none is looked for).
_TABLE = frozenset(["table"])
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table td th".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "dd": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), _TABLE),
    "th": (frozenset(["td", "th"]), _TABLE),
    "tr": (frozenset(["td", "th", "tr", "caption", "colgroup"]), _TABLE),
    "thead": (frozenset("td th tr thead tbody tfoot caption colgroup".split()), _TABLE),
    "tbody": (frozenset("td th tr thead tbody tfoot caption colgroup".split()), _TABLE),
    "tfoot": (frozenset("td th tr thead tbody tfoot caption colgroup".split()), _TABLE),
}
SCOPE = frozenset("html table td th caption template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_PARTS = frozenset("title base link meta style script noscript template head html".split())
FOREIGN = frozenset(["svg", "math"])
# Elements that hold HTML inside a formula or a drawing, and those that end the formula or drawing elsewhere.
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta"
    " nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Parts of a drawing that are not drawn where they stand.
UNDRAWN = frozenset("defs symbol clippath mask marker pattern metadata desc lineargradient radialgradient filter".split())
#: Pages with elements nested deeper than this are laid out with a higher recursion limit.
DEPTH = 200

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WANTED = re.compile(r"hidden|style|type|open|start|value|reversed|span|selected", re.I)
_GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)|content-visibility\s*:\s*hidden", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []


def attributes(text: str) -> dict[str, str]:
    """The attributes of a start tag; of repeated ones the first counts."""
    out: dict[str, str] = {}
    if _WANTED.search(text):
        for name, value in _ATTRIBUTE.findall(text):
            if value[:1] in ("'", '"'):
                value = value[1:-1]
            out.setdefault(name.lower(), unescape(value))
    return out


class Builder:
    """The open elements, and the rules for start tags, end tags and text."""

    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]
        self.head: Node | None = None
        self.deepest = 1
        self.foreign = False  # whether a formula or drawing has begun

    def close(self, ends: frozenset, beyond: frozenset) -> None:
        """End the open elements of ``ends`` that stand before any of ``beyond``, with all inside them."""
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in beyond:
                return
            if tag in ends:
                del self.open[k:]

    def push(self, tag: str, attributes: dict[str, str]) -> None:
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        self.open.append(node)
        self.deepest = max(self.deepest, len(self.open))

    def leave_foreign(self) -> None:
        """End the formula or drawing that is open, unless HTML may stand here."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in HOLDS_HTML:
                return
            if self.open[k].tag in FOREIGN:
                del self.open[k:]
                return

    def start(self, tag: str, text: str) -> None:
        if tag in ("html", "body", "head"):
            if tag == "head" and self.head is None and len(self.open) == 1:
                self.push("head", {})
                self.head = self.open[-1]
            elif tag == "body":
                self.end("head")
                if _GONE.search(text) or "hidden" in attributes(text):
                    self.root.attributes |= attributes(text)
            return
        if self.open[-1].tag == "head" and tag not in HEAD_PARTS:
            self.open.pop()
        if self.foreign and tag in BREAKOUT:
            self.leave_foreign()
        self.foreign |= tag in FOREIGN
        if tag in CLOSES_P:
            self.close(frozenset(["p"]), SCOPE | {"button"})
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        if tag in IMPLIED_END:
            self.close(*IMPLIED_END[tag])
            here = self.open[-1].tag
            if tag in ("td", "th") and here in ("table", "thead", "tbody", "tfoot"):
                self.push("tr", {})
        found = attributes(text)
        empty = self.foreign and text.endswith("/") and (tag in FOREIGN or any(n.tag in FOREIGN for n in self.open))
        if tag in VOID or empty:
            self.open[-1].children.append(Node(tag, found))
        else:
            self.push(tag, found)

    def end(self, tag: str) -> None:
        if tag == "p" and not any(n.tag == "p" for n in self.open):
            self.open[-1].children.append(Node("p", {}))
            return
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
            return
        if tag in ("html", "body"):
            return
        same = HEADINGS if tag in HEADINGS else (tag,)
        for k in range(len(self.open) - 1, 0, -1):
            here = self.open[k].tag
            if here in same:
                del self.open[k:]
                return
            if here in SCOPE and tag not in ("table", "tr", "thead", "tbody", "tfoot"):
                return
            if here == "table" and tag != "table":
                return

    def text(self, text: str) -> None:
        if text:
            if self.open[-1].tag == "head":
                if not text.strip(" \t\n\r\f"):
                    return
                self.open.pop()
            self.open[-1].children.append(text)


def parse(html: str) -> tuple[Node, int]:
    """The tree of a page, and how deep its elements are nested."""
    builder, at, n = Builder(), 0, len(html)
    search = _TOKEN.search
    while at < n:
        found = search(html, at)
        if not found:
            builder.text(unescape(html[at:]))
            break
        if found.start() > at:
            builder.text(unescape(html[at : found.start()]))
        at = found.end()
        slash, tag, rest = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            builder.end(tag)
            continue
        builder.start(tag, rest)
        if tag in ("pre", "textarea") and html.startswith(("\n", "\r\n"), at):
            at = html.index("\n", at) + 1
        if tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at) if tag != "plaintext" else None
            end = stop.start() if stop else n
            if tag in ("textarea", "title", "xmp", "plaintext") and end > at:
                raw = html[at:end]
                builder.open[-1].children.append(raw if tag in ("xmp", "plaintext") else unescape(raw))
            at = end
    return builder.root, builder.deepest


def unseen(node: Node) -> bool:
    """Whether a browser shows nothing of an element."""
    if node.tag in UNSEEN:
        return True
    a = node.attributes
    if not a:
        return node.tag == "dialog"
    if "hidden" in a or ("style" in a and _GONE.search(a["style"])):
        return True
    return node.tag == "dialog" and "open" not in a


class Layout:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # the line at work
        self.indent = [""]  # of this and nested blocks
        self.marker = ""  # a list marker that waits for its line
        self.blank: str | None = None  # the indent of a blank line that is due before the next
        self.space = False  # white space is due before the next text

    def add(self, text: str) -> None:
        """Inline text, its white space made one space."""
        words = _SPACE.sub(" ", text)
        if words == " ":
            self.space = True
            return
        if words.startswith(" "):
            self.space = True
            words = words[1:]
        if self.parts and self.space:
            self.parts.append(" ")
        self.space = words.endswith(" ")
        self.parts.append(words[:-1] if self.space else words)

    def keep(self, text: str) -> None:
        """Preformatted text."""
        first, *rest = text.replace("\r\n", "\n").expandtabs(8).split("\n")
        if first:
            self.parts.append(first)
        for line in rest:
            self.end_line(True)
            if line:
                self.parts.append(line)

    def end_line(self, always: bool = False) -> None:
        """Put the line at work down, if it holds text or is asked for."""
        if self.parts or always:
            if self.blank is not None and self.lines and self.lines[-1].strip(" >"):
                self.lines.append(self.blank.rstrip())
            self.blank = None
            indent = "".join(self.indent)
            if self.marker:
                indent = self.marker + indent[len(self.marker) :]
                self.marker = ""
            self.lines.append((indent + "".join(self.parts)).replace("\xa0", " ").rstrip())
            self.parts = []
        self.space = False

    def gap(self) -> None:
        """A blank line before what follows, inset as the outermost block that asks for it."""
        self.end_line()
        indent = "".join(self.indent)
        self.blank = indent if self.blank is None else min(self.blank, indent, key=len)

    def item(self, marker: str) -> None:
        """The next line begins with a list marker, after those of lists around that wait too."""
        self.marker = (self.marker or "".join(self.indent)) + marker
        self.indent.append(" " * len(marker))


def _number(text: str | None, default: int) -> int:
    found = re.match(r"\s*([-+]?\d{1,9})", text or "")
    return int(found[1]) if found else default


def lay_out(node: Node, out: Layout, kept: bool = False, depth: int = 0) -> None:
    """Write an element's visible text."""
    for child in node.children:
        if isinstance(child, str):
            (out.keep if kept else out.add)(child)
            continue
        tag = child.tag
        if unseen(child):
            continue
        if tag == "br":
            out.end_line(True)
        elif tag == "hr":
            out.gap()
        elif tag == "input":
            if child.attributes.get("type", "").lower() in ("submit", "button", "reset") and child.attributes.get("value"):
                out.add(f" {child.attributes['value']} ")
        elif tag == "svg":
            _labels(child, out, depth)
        elif tag in ("ul", "ol", "menu", "dir"):
            _list(child, out, depth)
        elif tag == "table":
            out.gap()
            for line in table_lines(child):
                out.parts = [line]
                out.end_line(True)
            out.gap()
        elif tag == "details" and "open" not in child.attributes:
            summaries = [c for c in child.children if isinstance(c, Node) and c.tag == "summary"][:1]
            out.gap()
            for summary in summaries:
                lay_out(summary, out, kept, depth)
            out.gap()
        elif tag in BLOCK:
            edge = out.gap if tag in SPACED else out.end_line
            edge()
            inset = {"blockquote": "> ", "dd": "    "}.get(tag, "")
            out.indent.append(inset)
            lay_out(child, out, kept or tag in ("pre", "xmp"), depth)
            out.end_line()
            out.indent.pop()
            edge()
        else:
            lay_out(child, out, kept or tag in ("textarea", "plaintext"), depth)


def _labels(node: Node, out: Layout, depth: int) -> None:
    """The labels of a drawing, with spaces between them."""
    for child in node.children:
        if isinstance(child, str) or unseen(child) or child.tag in UNDRAWN:
            continue
        if child.tag in ("text", "foreignobject"):
            out.add(" ")
            lay_out(child, out, False, depth)
            out.add(" ")
        else:
            _labels(child, out, depth)


def _list(node: Node, out: Layout, depth: int) -> None:
    """Items with bullets or numbers; a nested list keeps to its item, without blank lines."""
    (out.end_line if depth else out.gap)()
    items = [c for c in node.children if isinstance(c, Node) and c.tag == "li"]
    step = -1 if "reversed" in node.attributes else 1
    number = _number(node.attributes.get("start"), len(items) if step < 0 else 1)
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li":
            if unseen(child):
                continue
            if node.tag == "ol":
                number = _number(child.attributes.get("value"), number)
                marker = f"{number}. "
                number += step
            else:
                marker = "- "
            out.end_line()
            out.item(marker)
            before = len(out.lines)
            lay_out(child, out, False, depth + 1)
            out.end_line()
            if out.marker and len(out.lines) == before:
                out.marker = ""
            out.indent.pop()
        else:
            holder = Node("div", {})
            holder.children = [child]
            lay_out(holder, out, False, depth + 1)
    (out.end_line if depth else out.gap)()


def table_lines(table: Node) -> list[str]:
    """The rows of a table as lines, its columns aligned; cells may span columns and rows."""
    captions: list[str] = []
    rows: list[list[Node]] = []

    def collect(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str):
                if child.strip():  # text between cells stands before the table
                    captions.append(_SPACE.sub(" ", child).strip())
            elif unseen(child):
                continue
            elif child.tag == "tr":
                rows.append([c for c in child.children if isinstance(c, Node) and c.tag in ("td", "th") and not unseen(c)])
                loose = Node("div", {})
                loose.children = [c for c in child.children if isinstance(c, str) or c.tag not in ("td", "th")]
                captions.extend(page_lines(loose))
            elif child.tag in ("thead", "tbody", "tfoot"):
                collect(child)
            elif child.tag not in ("colgroup", "col"):
                holder = Node("div", {})
                holder.children = [child]
                captions.extend(page_lines(holder))

    collect(table)
    grid: list[list[tuple[list[str], int] | None]] = []  # per row: what begins in each column, and its span
    taken: dict[int, int] = {}  # column -> rows it is still covered from above
    for row in rows:
        line: list[tuple[list[str], int] | None] = []
        fresh: dict[int, int] = {}
        for cell in row:
            while taken.get(len(line), 0) > 0:
                line.append(None)
            wide = min(max(_number(cell.attributes.get("colspan"), 1), 1), 1000)
            tall = min(max(_number(cell.attributes.get("rowspan"), 1), 1), 65534)
            for k in range(wide):
                fresh[len(line) + k] = tall
            line.append((page_lines(cell), wide))
            line += [None] * (wide - 1)
        taken = {c: t - 1 for c, t in taken.items() if t > 1}
        for c, t in fresh.items():
            if t > 1:
                taken[c] = t - 1
        grid.append(line)
    columns = max(map(len, grid), default=0)
    widths = [0] * columns
    for line in grid:
        for c, cell in enumerate(line):
            if cell and cell[1] == 1:
                widths[c] = max(widths[c], max(map(len, cell[0]), default=0))
    for line in grid:  # a wide cell widens the last of its columns
        for c, cell in enumerate(line):
            if cell and cell[1] > 1:
                have = sum(widths[c : c + cell[1]]) + 3 * (cell[1] - 1)
                widths[c + cell[1] - 1] += max(0, max(map(len, cell[0]), default=0) - have)
    out = captions
    for line in grid:
        if not any(cell and cell[0] for cell in line):
            continue
        for k in range(max(len(cell[0]) for cell in line if cell)):
            parts, c = [], 0
            while c < len(line):
                cell = line[c]
                wide = cell[1] if cell else 1
                room = sum(widths[c : c + wide]) + 3 * (wide - 1)
                text = cell[0][k] if cell and k < len(cell[0]) else ""
                parts.append(text.ljust(room))
                c += wide
            out.append(" | ".join(parts).rstrip(" ") if len(parts) == 1 else " | ".join(parts).rstrip())
    return out


def page_lines(node: Node) -> list[str]:
    """The lines of one element, without blank ones at either end."""
    out = Layout()
    lay_out(node, out)
    out.end_line()
    lines = out.lines
    first, last = 0, len(lines)
    while first < last and not lines[first].strip():
        first += 1
    while last > first and not lines[last - 1].strip():
        last -= 1
    return lines[first:last]


def visible_text(html: str | None) -> str:
    """The visible text of a page; a null or empty page has none."""
    if not html:
        return ""
    root, deepest = parse(html)
    if unseen(root):
        return ""
    limit = sys.getrecursionlimit()
    try:
        if deepest > DEPTH:
            sys.setrecursionlimit(limit + 8 * deepest)
        return "\n".join(page_lines(root))
    finally:
        sys.setrecursionlimit(limit)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: its id, the visible ``text``, ``n_chars`` and ``n_lines`` (blank lines included).

    A null or empty page has an empty text, no characters and no lines.  Text without any tag is itself, its white
    space made single spaces.  Repeated rows are laid out each; other columns are not read; an empty table
    gives no rows.  Elements count at any depth.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = [visible_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
                ],
                names=[id_col, "text", "n_chars", "n_lines"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, text string, n_chars long, n_lines long")
