"""Layout-aware rendering of HTML to text.

A tokenizer that takes any input feeds a tree builder, which knows the tags that
are implied (a new paragraph, list item, option, row or cell closes the one that is
open; a block closes a paragraph; what can't stand in a head closes it) and those
without content.  The renderer leaves out what a browser doesn't show (scripts,
styles, templates, fallbacks, ``hidden``, ``display:none``, ``visibility:hidden``;
by attribute or by a rule of the page's style sheets whose selector is a tag, a
class, an id or a tag with one of these) and emits everything else, options,
button captions and the text of drawings included: blocks on their own lines,
paragraphs and headings set off by an empty line, list items with their bullet or
number, indented by depth, preformatted text as it is, and table cells in aligned
columns.

Rules of layout, which keep a page's text in proportion to the page:

* A table that holds a table is a frame for layout: its cells follow each other as
  blocks.  All other tables are aligned.
* Before a cell stand at most ``PADDING`` columns of padding, and a cell of more
  than that doesn't widen its column: what comes after it in its row moves right.
* Indentation stops growing at ``INDENT`` columns.

Time is in proportion to the size of the page, whatever it holds.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html import unescape as _html_unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import batched, set_aside

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title meta link base iframe noembed noframes object audio video canvas datalist param source track rp".split())
#: Blocks, and the number of empty lines around each.
BLOCKS = dict.fromkeys("address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form header hgroup html legend li main menu nav ol optgroup option search section summary table tbody td tfoot th thead tr ul caption pre".split(), 0)
BLOCKS |= dict.fromkeys("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl hr figure".split(), 1)
_IN_HEAD = frozenset("title meta link style script base template noscript head body html".split())
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: tag: (open tags that it closes, tags that stop the search for them)
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
_STOPS = ("table", "td", "th", "caption", "body", "html", "article", "section", "div")
#: End tags that reach out of a cell.
_OF_TABLES = frozenset("tr tbody thead tfoot table body html td th".split())
#: Types of ``input`` whose value is shown.
_SHOWS_VALUE = frozenset(("", "text", "search", "url", "tel", "email", "number", "button", "submit", "reset", "date", "month", "week", "time", "datetime-local"))
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ATTR = re.compile(r"[\s/]*+(?:([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|(?![\"'])([^\s>]*+)|(?P<open>)))?+)?+")
_END_OF = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in RAW}
_STYLED = re.compile(r"<style[\s>/]", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")
_INTEGER = re.compile(r"[ \t\n\r\f]*+([+-]?)0*([0-9]++)")
_LONG_NUMBER = re.compile(r"&#(?:[xX]0*([0-9a-fA-F]++)|0*([0-9]++));?")
_DECLARED = re.compile(r"(?:^|;)\s*+(display|visibility)\s*+:\s*+([a-z-]++)\s*+(!\s*+important)?", re.I)
_SELECTOR = re.compile(r"([a-zA-Z][\w-]*+)?+([.#](?:[\w-]|[^\x00-\x7f])++)?+$")

PADDING = 160
INDENT = 160
_NOTHING: dict = {}


class Node:
    """An element: a tag, attributes and children (nodes and strings)."""

    __slots__ = ("tag", "attrs", "kids", "frame")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []
        self.frame = False  # a table that holds a table


def unescape(s: str) -> str:
    """Character references replaced; numbers of any length are taken."""
    if "&" not in s:
        return s
    if "&#" in s:
        s = _LONG_NUMBER.sub(lambda m: f"&#x{m[1]};" if m[1] and len(m[1]) < 9 else f"&#{m[2]};" if m[2] and len(m[2]) < 9 else "&#0;", s)
    return _html_unescape(s)


class _Stack:
    """The open elements.  Where each tag stands in it is kept by tag, so that no
    question about it takes a walk."""

    def __init__(self, root: Node):
        self.open = [root]
        self.at: dict[str, list[int]] = {}

    def push(self, n: Node) -> None:
        self.at.setdefault(n.tag, []).append(len(self.open))
        if n.tag == "table" and len(self.at["table"]) > 1:
            self.open[self.at["table"][-2]].frame = True
        self.open.append(n)

    def close(self, until: int) -> None:
        while len(self.open) > until:
            self.at[self.open.pop().tag].pop()

    def last(self, *tags: str) -> int:
        """The place of the innermost of the tags, 0 where none is open."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def outermost(self, tags, above: int) -> int:
        """The place of the outermost of the tags that stands above a place."""
        found = []
        for t in tags:
            at = self.at.get(t)
            if at and at[-1] > above:
                found.append(at[bisect_right(at, above)])
        return min(found, default=0)


def _attributes(html: str, at: int) -> tuple[dict[str, str], int, bool]:
    """(attributes, the place after the tag, whether it closes itself); the place is
    -1 where the page ends in the tag."""
    attrs: dict[str, str] = {}
    while True:
        m = _ATTR.match(html, at)
        if m["open"] is not None:  # a quote that isn't closed
            return attrs, -1, False
        at = m.end()
        if m[1]:
            attrs.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
            continue
        if at >= len(html):
            return attrs, -1, False
        if html[at] == ">":
            return attrs, at + 1, html[at - 1] == "/"


def parse(html: str) -> Node:
    """The tree of a page or a piece of one; nothing in it is an error.  A tag that
    isn't closed when the page ends is dropped."""
    root = Node("#root", {})
    stack = _Stack(root)
    top = stack.open
    at, size = 0, len(html)
    while 0 <= at < size:
        lt = html.find("<", at)
        if lt != at:
            s = unescape(html[at : lt if lt >= 0 else size])
            if top[-1].tag == "head" and not s.isspace():
                stack.close(len(top) - 1)
            top[-1].kids.append(s)
            if lt < 0:
                break
        m = _NAME.match(html, lt)
        if m is None:
            if html.startswith("<!--", lt):
                at = html.find("-->", lt + 2)
                at = at + 3 if at >= 0 else size
            elif html.startswith("<![CDATA[", lt):
                end = html.find("]]>", lt)
                top[-1].kids.append(html[lt + 9 : end if end >= 0 else size])
                at = end + 3 if end >= 0 else size
            elif html[lt + 1 : lt + 2] in ("!", "?", "/") and lt + 1 < size:
                at = html.find(">", lt) + 1 or size
            else:  # a bare "<"
                top[-1].kids.append("<")
                at = lt + 1
            continue
        at = m.end()
        tag = m[2].lower()
        attrs = _NOTHING
        closes_itself = False
        if html[at : at + 1] == ">":
            at += 1
        else:
            attrs, at, closes_itself = _attributes(html, at)
            if at < 0:
                break
        if m[1]:
            if tag == "p" and not stack.at.get("p"):
                top[-1].kids.append(Node("p", {}))
            if tag == "br":
                top[-1].kids.append(Node("br", {}))
                continue
            i = stack.last(tag)
            if i and (tag in _OF_TABLES or i >= stack.last("td", "th", "table")):
                stack.close(i)  # else an end tag in a cell, which closes nothing outside of it
            continue
        if top[-1].tag == "head" and tag not in _IN_HEAD:
            stack.close(len(top) - 1)
        if tag in _ENDS_P:
            i = stack.last("p")
            if i and i > stack.last(*_STOPS):
                stack.close(i)
            if tag in _HEADINGS and top[-1].tag in _HEADINGS:
                stack.close(len(top) - 1)
        if tag in _CLOSES:
            ends, stops = _CLOSES[tag]
            i = stack.outermost(ends, stack.last(*stops))
            if i:
                stack.close(i)
        if tag in ("html", "body") and (where := stack.at.get(tag)):
            same = top[where[0]]
            same.attrs = attrs | same.attrs
            continue
        node = Node(tag, attrs)
        top[-1].kids.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = _END_OF[tag].search(html, at)
            body = html[at : end.start() if end else size]
            node.kids.append(unescape(body) if tag in ("textarea", "title") else body)
            at = end.end() if end else size
            continue
        if not closes_itself or not stack.at.get("svg") and tag != "svg":
            stack.push(node)
    return root


class _Sheet:
    """The rules of a page's style sheets that hide or show: for each property, by
    selector, whether it hides and how it ranks."""

    def __init__(self, root: Node, styled: bool):
        self.rules: dict[tuple[str, str], dict[str, tuple[tuple[bool, int, int], bool]]] = {}
        order = 0
        work = [root] if styled else []
        while work:
            n = work.pop()
            if n.tag == "style":
                for s in n.kids:
                    order = self._read(s, order)
            elif n.tag not in ("script", "textarea", "title"):
                work += [k for k in reversed(n.kids) if isinstance(k, Node)]

    def _read(self, css: str, order: int) -> int:
        at, parts = 0, []
        while (i := css.find("/*", at)) >= 0:
            parts.append(css[at:i])
            at = css.find("*/", i + 2) + 2
            if at < 2:
                at = len(css)
        css = "".join([*parts, css[at:]])
        at = 0
        while (i := css.find("{", at)) >= 0:
            head = css[at:i].rpartition(";")[2].strip()
            if head.startswith("@"):  # rules within are conditional: skip to the end of the block
                depth, j = 1, i + 1
                for m in re.compile(r"[{}]").finditer(css, i + 1):
                    depth += 1 if m[0] == "{" else -1
                    j = m.end()
                    if not depth:
                        break
                at = j if not depth else len(css)
                continue
            j = css.find("}", i)
            at = j + 1 if j >= 0 else len(css)
            declared = _declared(css[i + 1 : j if j >= 0 else len(css)])
            if not declared:
                continue
            for selector in head.split(","):
                m = _SELECTOR.fullmatch(selector.strip())
                if m is None or not m[0]:
                    continue
                order += 1
                own = self.rules.setdefault(((m[1] or "").lower(), m[2] or ""), {})
                weight = (100 if m[2] and m[2][0] == "#" else 10 if m[2] else 0) + bool(m[1])
                for what, (hides, important) in declared.items():
                    rank = (important, weight, order)
                    if what not in own or own[what][0] < rank:
                        own[what] = (rank, hides)
        return order

    def of(self, n: Node) -> dict[str, bool]:
        """What is declared for an element, of ``display`` and ``visibility``:
        whether it hides."""
        if not self.rules and "style" not in n.attrs:
            return _NOTHING
        best: dict[str, tuple[tuple[bool, int, int], bool]] = {}
        if self.rules:
            marks = ["", *("." + c for c in set(n.attrs.get("class", "").split()))]
            if n.attrs.get("id"):
                marks.append("#" + n.attrs["id"])
            for mark in marks:
                for tag in ("", n.tag):
                    for what, x in self.rules.get((tag, mark), {}).items():
                        if what not in best or best[what][0] < x[0]:
                            best[what] = x
        style = n.attrs.get("style")
        if style:
            for what, (hides, important) in _declared(style).items():
                x = ((important, 1000, 0), hides)
                if what not in best or best[what][0] < x[0]:
                    best[what] = x
        return {what: hides for what, (_, hides) in best.items()}


def _declared(style: str) -> dict[str, tuple[bool, bool]]:
    """Of ``display`` and ``visibility``: (whether it hides, whether important)."""
    out: dict[str, tuple[bool, bool]] = {}
    low = style.lower()
    if "display" in low or "visibility" in low:
        for m in _DECLARED.finditer(style):
            what, value = m[1].lower(), m[2].lower()
            if m[3] or not out.get(what, (False, False))[1]:
                out[what] = (value == "none" if what == "display" else value in ("hidden", "collapse"), bool(m[3]))
    return out


class _Out:
    """Lines under construction: text is collapsed and blocks begin new lines."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.blank = False
        self.prefix = ""
        self.levels = 0

    def text(self, s: str) -> None:
        words = _SPACE.sub(" ", s)
        if words == " " or not words:
            self.space |= bool(words)
            return
        if words[0] == " " or self.space:
            words = (" " if self.line else "") + words.lstrip(" ")
        self.space = words[-1] == " "
        self._put(words.rstrip(" "))

    def _put(self, s: str) -> None:
        if not self.line:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            room = min(INDENT, 2 * self.levels)
            self.line.append(" " * max(0, room - len(self.prefix)) + self.prefix)
            self.prefix = ""
            s = s.lstrip(" ")
        self.line.append(s)

    def exact(self, s: str) -> None:
        for i, part in enumerate(s.split("\n")):
            if i:
                self.brk()
            if part:
                self._put("")
                self.line.append(part)

    def brk(self) -> None:
        """A forced line end."""
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        elif self.lines:
            self.lines.append("")
        self.space = False

    def block(self, empty: int) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.space = False
        self.blank |= empty > 0

    def done(self) -> list[str]:
        self.block(0)
        while self.lines and not self.lines[-1].strip():
            self.lines.pop()
        return self.lines


def _width(s: str) -> int:
    return len(s) if s.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def _number(x: str | None, default: int, least: int, most: int) -> int:
    """The integer that an attribute begins with, as browsers read it."""
    m = _INTEGER.match(x) if x and x.isascii() else None
    if m is None:
        return default
    n = int(m[2][:12]) if len(m[2]) <= 12 else 10**12
    return max(least, min(-n if m[1] == "-" else n, most))


class _Gaps:
    """The columns of a row that no cell from above hangs into: sorted, disjoint
    intervals, the last without an end."""

    def __init__(self) -> None:
        self.begin, self.end = [0], [1 << 60]
        self.held: list[tuple[int, int, int]] = []  # (first row that it leaves free, begin, end)

    def take(self, row: int, begin: int, end: int) -> None:
        i = bisect_right(self.begin, begin) - 1
        b, e = self.begin[i], self.end[i]
        now = [(x, y) for x, y in ((b, begin), (end, e)) if x < y]
        self.begin[i : i + 1], self.end[i : i + 1] = [x for x, _ in now], [y for _, y in now]
        heapq.heappush(self.held, (row, begin, end))

    def release(self, row: int) -> None:
        while self.held and self.held[0][0] <= row:
            _, b, e = heapq.heappop(self.held)
            i = bisect_left(self.begin, b)
            left, right = i > 0 and self.end[i - 1] == b, i < len(self.begin) and self.begin[i] == e
            if left:
                self.end[i - 1] = self.end.pop(i) if right else e
                if right:
                    self.begin.pop(i)
            elif right:
                self.begin[i] = b
            else:
                self.begin.insert(i, b)
                self.end.insert(i, e)


class _Page:
    """One page's rendering."""

    def __init__(self, html: str):
        self.root = parse(html)
        self.sheet = _Sheet(self.root, _STYLED.search(html) is not None)

    def text(self) -> str:
        return "\n".join(self.render(self.root))

    def unseen(self, n: Node, declared: dict[str, bool]) -> bool:
        """Whether a node and all in it take no part in the rendering."""
        if n.tag in UNSEEN or n.attrs.get("hidden", "until-found").lower() != "until-found" or n.tag == "dialog" and "open" not in n.attrs:
            return not ("hidden" in n.attrs and n.tag not in UNSEEN and declared.get("display") is False)
        return declared.get("display", False)

    def table(self, node: Node, hidden: bool) -> list[str]:
        """The rows of a table without tables in it, cells padded to the width of
        their columns."""
        captions: list[str] = []
        rows: list[tuple[list, bool, int]] = []  # (cells, whether it is hidden, number of its group)
        group = 0

        work: list[tuple[Node | str, bool, bool]] = [(k, hidden, False) for k in reversed(node.kids)]
        while work:
            k, unseen, new = work.pop()
            if new:
                group += 1
            if isinstance(k, str):
                if k.strip() and not unseen:
                    captions.append(_SPACE.sub(" ", k).strip())
                continue
            declared = self.sheet.of(k)
            if self.unseen(k, declared):
                continue
            unseen = declared.get("visibility", unseen)
            if k.tag == "tr":
                rows.append((k.kids, unseen, group))
            elif k.tag in ("td", "th"):
                rows.append(([k], unseen, group))
            elif k.tag in ("thead", "tbody", "tfoot", "form"):
                kids = [(x, unseen, False) for x in reversed(k.kids)]
                if kids and k.tag != "form":
                    group += 1
                    work.append((Node("col", {}), False, True))  # what follows is another group
                work += kids
            elif k.tag not in ("col", "colgroup"):
                captions += [x for x in self.render(k, unseen) if x.strip()]
        ends = {g: r + 1 for r, (_, _, g) in enumerate(rows)}
        gaps = _Gaps()
        laid: list[list[tuple[int, bool, list[str]]]] = []
        for r, (kids, unseen, g) in enumerate(rows):
            gaps.release(r)
            own, hang = [], []
            i = c = 0
            for cell in kids:
                declared = self.sheet.of(cell) if isinstance(cell, Node) else {}
                if isinstance(cell, str) and not cell.strip() or isinstance(cell, Node) and self.unseen(cell, declared):
                    continue
                while c >= gaps.end[i]:
                    i += 1
                c = max(c, gaps.begin[i])
                attrs = cell.attrs if isinstance(cell, Node) else {}
                wide, tall = _number(attrs.get("colspan"), 1, 1, 1000), _number(attrs.get("rowspan"), 1, 0, 65534)
                wide = min(wide, gaps.end[i] - c)
                until = ends[g] if tall == 0 else min(r + tall, ends[g])
                lines = self.render(cell, declared.get("visibility", unseen)) if isinstance(cell, Node) else [] if unseen else [_SPACE.sub(" ", cell).strip()]
                own.append((c, wide > 1, lines))
                if until > r + 1:
                    hang.append((until, c, c + wide))
                c += wide
            for x in hang:
                gaps.take(*x)
            laid.append(own)
        width: dict[int, int] = {}
        for own in laid:
            for c, spans, lines in own:
                most = max(map(_width, lines), default=0)
                width[c] = max(width.get(c, 0), 0 if spans else min(most, PADDING))
        starts, at = {}, 0
        for c in sorted(width):
            starts[c] = at
            at += width[c] + 3
        out = captions
        for own in laid:
            live, i = own, 0
            while live:
                line, room, many = [], 0, 0
                for c, _, lines in live:
                    parted = many or c
                    gap = min(max(0, starts[c] - room - (3 if parted else 0)), PADDING)
                    line.append(" " * gap)
                    room += gap
                    if parted:
                        line.append(" | ")
                        room += 3
                    x = lines[i] if i < len(lines) else ""
                    line.append(x)
                    room += _width(x)
                    many += 1
                if i or any(lines for _, _, lines in live):
                    out.append("".join(line).rstrip())
                i += 1
                live = [x for x in live if len(x[2]) > i]
        return out

    def render(self, node: Node, hidden: bool = False) -> list[str]:
        """The lines of one node.  An explicit stack, as pages may be nested deeply."""
        out = _Out()
        lists: list[list] = []
        quotes = drawing = shown = 0
        work: list[tuple] = [("in", node, hidden, False)]
        first = True
        while work:
            what, n, unseen, pre = work.pop()
            if what == "out":
                if n.tag in ("ul", "ol", "menu") and lists:
                    lists.pop()
                elif n.tag in ("blockquote", "dd"):
                    quotes -= 1
                elif n.tag == "q":
                    if not unseen:
                        out.text('"')
                elif n.tag == "svg":
                    drawing -= 1
                elif n.tag in ("text", "foreignobject") and drawing:
                    shown -= 1
                out.levels = 2 * len(lists) + quotes
                if n.tag in BLOCKS:
                    out.block(0 if n.tag in ("ul", "ol") and lists else BLOCKS[n.tag])
                continue
            if isinstance(n, str):
                if not unseen and (not drawing or shown):
                    out.exact(n) if pre else out.text(n)
                continue
            declared = self.sheet.of(n) if not first else {}
            if not first and self.unseen(n, declared):
                continue
            unseen = declared.get("visibility", unseen)
            tag = n.tag
            if drawing and tag in ("desc", "defs", "metadata", "symbol"):
                continue
            if tag == "br":
                out.brk()
                continue
            if tag == "hr":
                out.block(1)
                continue
            if tag == "img" or tag == "input":
                kind = n.attrs.get("type", "").strip().lower()
                s = n.attrs.get("alt") if tag == "img" or kind == "image" else n.attrs.get("value") if kind in _SHOWS_VALUE else None
                if s and not unseen:
                    out.text(s)
                continue
            if tag == "table" and not first and not n.frame:
                out.block(1)
                for x in self.table(n, unseen):
                    if x.strip():
                        out._put("")
                        out.line.append(x)
                    out.block(0)
                out.block(1)
                continue
            if tag in BLOCKS:
                inner = tag in ("ul", "ol") and lists
                out.block(0 if inner else BLOCKS[tag])
            if tag in ("ul", "ol", "menu"):
                lists.append([tag, _number(n.attrs.get("start"), 1, -(2**31), 2**31 - 1)])
            elif tag == "li":
                if lists and lists[-1][0] == "ol":
                    value = _number(n.attrs.get("value"), lists[-1][1], -(2**31), 2**31 - 1)
                    lists[-1][1] = value + 1
                    out.prefix = f"{value}. "
                else:
                    out.prefix = "- "
            elif tag in ("blockquote", "dd"):
                quotes += 1
            elif tag in ("td", "th"):
                out.space = True
            elif tag == "q" and not unseen:
                out.text('"')
            elif tag == "optgroup" and n.attrs.get("label") and not unseen:
                out.text(n.attrs["label"])
                out.block(0)
            elif tag == "svg":
                drawing += 1
            elif tag in ("text", "foreignobject") and drawing:
                shown += 1
            out.levels = 2 * (len(lists) or tag == "li") + quotes
            first = False
            work.append(("out", n, unseen, pre))
            pre = pre or tag in ("pre", "textarea", "xmp")
            work += [("in", k, unseen, pre) for k in reversed(n.kids)]
        return out.done()


def render(html: str) -> str:
    """The visible text of a page."""
    return _Page(html).text()


def title(root: Node) -> str:
    """The text of the first ``title``."""
    work = [root]
    while work:
        n = work.pop()
        if isinstance(n, Node):
            if n.tag == "title":
                return _SPACE.sub(" ", "".join(k for k in n.kids if isinstance(k, str))).strip()
            work += reversed(n.kids)
    return ""


def extract(pages: DataFrame, html: str = "html", keep_html: bool = False) -> DataFrame:
    """``pages`` with ``title`` and ``text`` in the place of the source.

    NULL and empty pages, and pages that show nothing, have ''.  Each row stands
    for itself, so repeated rows give the same text and an empty table an empty
    one.  Very long pages take time in proportion to their length.  Columns of the
    input named ``title`` or ``text`` are kept as ``input_title`` and
    ``input_text`` (with more of ``input_`` where the input has those too).
    """
    pages, renamed = set_aside(pages, "title", "text")
    html = renamed.get(html, html)
    at = pages.columns.index(html)
    stay = [i for i in range(len(pages.columns)) if keep_html or i != at]
    schema = T.StructType([*(pages.schema.fields[i] for i in stay), T.StructField("title", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            titles, texts = [], []
            for x in b.column(at):
                page = _Page(x.as_py() or "")
                titles.append(title(page.root))
                texts.append(page.text())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in stay), pa.array(titles, pa.string()), pa.array(texts, pa.string())], schema.names)

    return pages.transform(batched).mapInArrow(run, schema)
