"""Candidates that are assembled line by line: captions, body headings and
reference entries.

What a line belongs to depends on what was taken before it, so a document's lines
stand behind each other in one task, and everything in it is plain Python on a
document.  A document's size bounds what a task holds.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.udf import arrow_schema, batched


def rx(pattern: str) -> re.Pattern:
    """A pattern of the column functions as one of Python's."""
    m = re.match(r"\(\?(\w+)\)", pattern)
    return re.compile(pattern[m.end() :] if m else pattern, re.I if m and "i" in m[1] else 0)


def _any(*parts: str, number: bool = False, begin: str = r"^\s*", end: str = r"\b") -> re.Pattern:
    return re.compile(begin + (r"(?:[\dIVXivx]+(?:\.\d+)*[.)]?\s+)?" if number else "") + "(?:" + "|".join(parts) + ")" + end, re.I)


FIGURE, TABLE, REFERENCES, REFERENCE_STOP, ENTRY = (rx(p) for p in (T.FIGURE_LABEL, T.TABLE_LABEL, T.REFERENCE_HEADING, T.REFERENCE_STOP, T.REFERENCE_ENTRY))
ABSTRACT, KEYWORDS = rx(T.ABSTRACT_HEADING), rx(T.KEYWORD_MARKER)
_ACK, _CONTRIB, _COMPETING = "(?:draft\\s+)?acknowledge?ments?", r"author\s+contributions?", r"competing\s+interests?"
_FULL = r"\s*:?\s*$"
_MAJOR = ("aims?", "background", "conclusions?", "discussion", "introduction", r"materials\s+and\s+methods", "methods?", "overview", "results?")
KNOWN = _any(*_MAJOR, "acknowledge?ments?", "analys[ei]s", "models?", "limitations", "funding", r"data\s+availability", _CONTRIB, _COMPETING, r"supporting\s+information", r"supplementary\s+(?:data|information|material)", r"plain\s+language\s+summary", number=True)
MAJOR = _any(*_MAJOR, r"results?\s+and\s+discussion", r"supporting\s+information", number=True, end=_FULL)
START = _any("background", "introduction", "overview", "rationale", number=True, end=_FULL)
INTRODUCTION = _any("introducci[oó]n", "introdução", "introduction", number=True, end=_FULL)
NUMBERED = re.compile(r"^\s*(?:[IVX]+|\d+(?:\.\d+){0,3})[.)]?\s+[A-ZÁÉÍÓÚÃÕÇÑ][^\n]{2,180}$")
PROCEDURE = re.compile(r"^\s*\d+[.)]\s+[^:]{2,90}:\s+\S")
REJECT = _any(
    r"source\s+data", r"grant\s+information", r"competing\s+interests?:", r"reviewer\s+(?:expertise|report)", "references?", r"fig\.\s*\d", r"figure\s+s?\d", r"table\s+s?\d",
    "laboratory", "department", "institute", "university", "e-?mail", "correspondence", r"last\s+updated", r"open\s+research\s+europe", "accepted", "received", "submitted", "license", "preprint", "copyright", "https?://", "doi",
    begin=r"\b",
)
PANEL = re.compile(r"^\s*[A-Z](?:[,/][A-Z])?[).:]\s+\S")
BACK = _any(r"extended\s+data\s+figures?", r"supplementary\s+figures?", r"figure\s+legends?", r"figures?\s+(?:and\s+)?figure\s+legends?", end=r"\s*$")
STOP = _any("declarations?", "funding", _ACK, _CONTRIB, _COMPETING, end=_FULL)
BACK_HEADING = _any("funding", _ACK, _CONTRIB, _COMPETING)
PROSE = _any(r"the\s+theme\s+of", r"(?:the\s+)?(?:fif|six|seven|eigh|nin|ten|four)th\s+theme", r"(?:the\s+)?(?:first|second|third)\s+theme")
OPEN_END = _any(*"a an and are as at be been being between by did do does for from in into is of on or the through to using via was were with within without".split()[::-1], begin=r"\b", end=r"\s*$")
_ALPHA = re.compile(r"[^\W\d_]+")
_SHORT = {"no", "not applicable", "partly", "view", "yes"}


def ws(s: str | None) -> str:
    return " ".join((s or "").split())


def words(s: str) -> int:
    return len(re.findall(r"\w+", s))


def is_caption(s: str) -> bool:
    return bool(FIGURE.match(s) or TABLE.match(s))


def is_page_marker(s: str) -> bool:
    return bool(re.fullmatch(r"page\s+\d+|(?:page\s*)?\d+\s+(?:/|of)\s+\d+", s.strip(), re.I))


def is_heading(s: str) -> bool:
    """A phrase that could be a heading, by its length."""
    s = s.strip().rstrip(":").strip()
    return 2 <= len(s) <= 200 and not is_caption(s) and not re.sub("[.,]", "", s).strip().isdigit() and 1 <= len(s.split()) <= 20


def has_initial(s: str) -> bool:
    """Whether a phrase begins as headings do."""
    if re.match(r"^\s*[∆Δα-ωΑ-Ω]", s):
        return True
    return bool(_ALPHA.search(s)) and any(c.isupper() for c in s)


def is_phrase(s: str, period: bool = False, question: bool = False) -> bool:
    """1 to 18 words with a heading's initial and punctuation."""
    s = ws(s).strip(":")
    if not s or s.casefold() in _SHORT or not 1 <= words(s) <= 18 or not has_initial(s):
        return False
    ends = {",", ";", "!"} | ({"?"} if not question else set()) | ({"."} if not period else set())
    return s[-1] not in ends and len(re.findall("[.;]", s)) <= 1


def fragment(text: str) -> str:
    """The heading at the begin of a line that goes on with text."""
    s = ws(text)
    if m := re.match(r"^(.{2,120}?):\s+\S", s):
        head, tail = m[1].strip(), s[m.end() - 1 :].strip()
        known = KNOWN.match(head)
        if known and known.end() == len(head) or BACK_HEADING.match(head):
            whole = words(s) <= 18 and is_phrase(tail, period=True) and tail[-1:] not in (".", "?", "!")
            return s.rstrip(".").strip() if whole else head
    if m := re.match(r"^(.{2,160}?)\.\s+\S", s):
        head, tail = m[1].strip(), s[m.end() - 1 :].strip()
        if re.fullmatch(r"(?:(?:evaluation|phase)\s+)?\d+", head, re.I):
            return s
        if is_phrase(head, period=True):
            whole = words(s) <= 18 and words(tail) <= 10 and "," not in tail and is_phrase(tail, period=True)
            return s.rstrip(".").strip() if whole else head
    return s.rstrip(".").strip()


def continuation(text: str) -> str:
    """The part of a line that may belong to the heading before it."""
    text = ws(text)
    head = text.split(".", 1)[0].strip()
    return head + "." if "." in text and (re.fullmatch(r"\d+/\d+", head) or 0 < words(head) <= 8) else text


def join_heading(left: str, right: str) -> str:
    left, right = ws(left), ws(right)
    if left.endswith("-"):
        return ws(left[:-1] + continuation(right))
    return ws(f"{left} {continuation(right) if re.match(r'^\d+/\d+[.]', right) else right}")


def goes_on(now: str, following: str) -> bool:
    """Whether a line reads as the continuation of a heading."""
    now, following = ws(now), ws(following)
    if not now or not following:
        return False
    is_open, n = bool(OPEN_END.search(now)), words(following)
    if following[-1] in ".!?" and not (is_open and following[-1] == "?" and n <= 8):
        return False
    if is_caption(following) or REJECT.search(following) or PANEL.match(following) or not 1 <= n <= 10:
        return False
    alpha = _ALPHA.search(following)
    return bool(is_open or re.match(r"(?:and|or)\b", following, re.I) or alpha and alpha[0][0].islower() and words(now) >= 4)


@dataclass
class Line:
    """A layout line, NULLs replaced."""

    pos: int
    text: str
    page: int = 0
    x: float = 0.0
    y: float = 0.0
    h: float = 0.0
    size: float = 0.0
    bold: bool = False
    row: dict = field(default_factory=dict)

    @classmethod
    def of(cls, r: dict) -> Line:
        f = lambda k: 0.0 if r.get(k) is None or r[k] != r[k] else float(r[k])
        return cls(int(r["pos"]), ws(r.get("text")), int(f("page")), f("x"), f("y"), f("h"), f("font_size"), bool(r.get("bold") or False), r)

    @property
    def y_scale(self) -> float:
        h = float(self.row.get("page_h") or 0)
        return h / 792.0 if h >= 100 else 1.0

    def has(self, name: str) -> str:
        return str(self.row.get(name) or "").lower()


class Document:
    """The lines of one document in order, and what is known about each."""

    def __init__(self, rows: list[dict]):
        self.lines = sorted((Line.of(r) for r in rows), key=lambda n: n.pos)
        self.pages: dict[int, list[int]] = {}
        for i, n in enumerate(self.lines):
            self.pages.setdefault(n.page, []).append(i)

    def below(self, i: int, tolerance: float = 24.0) -> int | None:
        """The nearest lower line of the column."""
        a, order = self.lines[i], self.downwards[self.lines[i].page]
        for k in range(bisect_right(order, (a.y, len(self.lines))), len(order)):
            if abs(self.lines[order[k][1]].x - a.x) <= tolerance:
                return order[k][1]
        return None

    @cached_property
    def downwards(self) -> dict[int, list[tuple[float, int]]]:
        """The lines of each page by their height, then in order."""
        return {p: sorted((self.lines[i].y, i) for i in own) for p, own in self.pages.items()}

    @cached_property
    def beside(self) -> list[int]:
        """How many texts stand at each line's height, margin numbers apart."""
        buckets: dict[tuple[int, int], list[Line]] = {}
        for n in self.lines:
            buckets.setdefault((n.page, round(n.y / 1.5)), []).append(n)
        number = re.compile(r"\d{1,4}")
        out = []
        for n in self.lines:
            near = (o for d in (-1, 0, 1) for o in buckets.get((n.page, round(n.y / 1.5) + d), ()))
            out.append(sum(1 for o in near if o is not n and abs(o.y - n.y) <= 1.5 and o.text and not (o.x < n.x - 10 and number.fullmatch(o.text))))
        return out

    @cached_property
    def gaps(self) -> list[tuple[float, float]]:
        """The space before and after each line in its column; 0 where none is."""
        out = [(0.0, 0.0)] * len(self.lines)
        number = re.compile(r"\d{1,4}")
        for own in self.pages.values():
            order = sorted(own, key=lambda i: (self.lines[i].y, self.lines[i].x, i))

            def first(a: Line, rest: range) -> float:
                for k in rest:
                    o = self.lines[order[k]]  # noqa: B023
                    if abs(o.y - a.y) >= 0.5 and not (o.x < a.x - 10 and number.fullmatch(o.text)) and abs(o.x - a.x) <= 90:
                        return abs(o.y - a.y)
                return 0.0

            for k, i in enumerate(order):
                out[i] = first(self.lines[i], range(k - 1, -1, -1)), first(self.lines[i], range(k + 1, len(order)))
        return out

    @cached_property
    def usual_gap(self) -> float:
        """The upper median of the gaps to the next line of the column."""
        gaps = []
        for own in self.pages.values():
            order = sorted((self.lines[i] for i in own if self.lines[i].y > 0 and self.lines[i].x > 0), key=lambda n: (n.x, n.y))
            for k, n in enumerate(order):
                gap = 0.0
                for j in range(k + 1, len(order)):
                    o = order[j]
                    if o.x - n.x > 24:
                        break
                    if o.y > n.y:
                        gap = o.y - n.y
                        break
                gaps += [gap] if 6 <= gap <= 45 else []
        return sorted(gaps)[len(gaps) // 2] if gaps else 0.0

    @cached_property
    def body_size(self) -> float:
        """The most frequent font size of running text."""
        sizes = Counter(round(n.size, 1) for n in self.lines if not n.bold and words(n.text) >= 4 and n.size > 0)
        if sizes:
            return max(sizes, key=sizes.get)
        some = sorted(n.size for n in self.lines if n.size > 0 and words(n.text) >= 3)
        return some[len(some) // 2] if some else 0.0

    # captions

    def captions(self, kind: str, most: int, most_lines: int = 18) -> list[tuple[str, Line]]:
        """Captions: the line with the label and those below it, until the caption
        is complete and something else begins."""
        label = FIGURE if kind == "figure" else TABLE
        taken: set[int] = set()
        found: dict[str, tuple[str, Line]] = {}
        for i, n in enumerate(self.lines):
            if i in taken or not label.match(n.text):
                continue
            own = [i]
            while len(own) < most_lines:
                j = self.below(own[-1], 42.0)
                if j is None or j in taken or not (o := self.lines[j]).text or is_caption(o.text):
                    break
                last = self.lines[own[-1]]
                if self._ends_caption(kind, j, n, [self.lines[k].text for k in own]) or o.y - last.y > max(24.0, 2.6 * last.h):
                    break
                own.append(j)
            caption = ws(" ".join(self.lines[k].text for k in own))
            if 10 <= len(caption) <= 5000 and label.match(caption) and caption.casefold() not in found:
                found[caption.casefold()] = caption, n
                taken.update(own)
                if len(found) >= most:
                    break
        return list(found.values())

    def _ends_caption(self, kind: str, j: int, start: Line, parts: list[str]) -> bool:
        done = ws(" ".join(parts))
        if words(done) < 5 or not re.search(r"[.!?)]\s*$", done):
            return False
        o = self.lines[j]
        n, beside = words(o.text), self.beside[j]
        if beside >= 2 or n <= 10 and o.size >= start.size + 1 and is_heading(o.text):
            return True
        if kind == "figure":
            return bool(PANEL.match(o.text)) and n <= 12
        return n <= 8 and len(o.text) <= 90 and o.text[-1:] not in (".", "!", "?") and (o.bold or o.size < start.size - 0.25 or beside >= 1)

    # body headings

    @cached_property
    def body_start(self) -> int:
        for i, n in enumerate(self.lines):
            if INTRODUCTION.match(n.text):
                return i
        return next((i for i, n in enumerate(self.lines) if n.page >= 1 and START.match(n.text)), 0)

    def _is_candidate(self, i: int, spacing: bool, relaxed: bool) -> bool:
        n = self.lines[i]
        s = fragment(n.text).strip(":")
        if not 2 <= len(s) <= 220 or s.casefold() in _SHORT or is_caption(s) or ABSTRACT.match(s) or KEYWORDS.search(s):
            return False
        if REJECT.search(s) or any(p.match(s) for p in (BACK_HEADING, PANEL, PROSE)) or re.fullmatch(r"[\d\W]+", s) or not 1 <= words(s) <= 22:
            return False
        before, after = self.gaps[i]
        at_top = before == 0 and n.y <= 125 * n.y_scale
        usual = (self.usual_gap if spacing else 0.0) or max(n.h, 8.0) * 1.2
        apart = (before >= max(18.0, 1.6 * usual) or at_top) and after >= max(8.0, 0.75 * usual)
        body, n_words = self.body_size, words(s)
        small, large, larger = (bool(body) and t for t in (n.size < body - 1.5, n.size >= body + 0.5, n.size >= body + 0.15))
        if m := KNOWN.match(s):
            tail = s[m.end() :].strip()
            return not tail or tail[0] in ":;.-–—(" or has_initial(tail) and words(tail) <= 16
        if PROCEDURE.match(s):
            return False
        if NUMBERED.match(s) and n_words <= 18:
            return not (small and not (relaxed and apart)) and (n.bold or large or apart)
        if self.beside[i] >= 2:
            return False
        phrase = is_phrase(s, period=True, question=True)
        if small and not (relaxed and apart and phrase):
            return False
        if not (n.bold or large):
            plain = is_phrase(s, question=True)
            return relaxed and n_words <= 18 and apart and phrase or larger and plain or n_words <= 10 and apart and plain
        if n.bold and not large and body and n.size <= body + 0.15 and not (apart or before >= 18 or at_top):
            return False
        return phrase and n_words <= 18 and (n.bold or s[-1] not in ".,") and len(re.findall("[.;]", s)) <= 2

    def _merges(self, text: str, i: int, j: int, candidate: Callable[[int], bool]) -> bool:
        a, b = self.lines[i], self.lines[j]
        if abs(a.x - b.x) > 24 or not 0 < b.y - a.y <= max(30.0, 2.8 * a.h) or words(text) + words(b.text) > 30:
            return False
        if text.rstrip().endswith("-"):
            if self.body_size and b.size < self.body_size - 0.2 and not (a.bold and b.bold):
                return False
            more = continuation(b.text)
            return words(more) <= 12 and more[-1:] not in ("?", "!")
        if a.bold and b.bold and re.match(r"\d+/\d+\b", b.text):
            return True
        if a.bold != b.bold or abs(a.size - b.size) > 0.2 or MAJOR.match(ws(text).strip(":")):
            return False
        return goes_on(text, b.text) or candidate(j) or a.bold and words(b.text) <= 8 and b.text[-1:] not in (".", "?", "!")

    def _priority(self, n: Line) -> float:
        """How much a line's style differs from the body's."""
        s = 2.0 * n.bold + bool(n.row.get("italic"))
        for name, weight in (("color", 1.5), ("family", 1.0), ("type", 0.5)):
            own, usual = n.has(f"font_{name}"), n.has(f"doc_body_{name}")
            s += weight * bool(own and usual and own != usual and not (name == "color" and own in ("#000000", "000000")))
        s += 1.5 * bool(self.body_size and n.size >= self.body_size + 0.5)
        return s + bool(n.row.get("is_block_first_line") and 1 <= int(n.row.get("block_line_count") or 0) <= 3)

    def _before_back(self) -> list[int]:
        """The lines from the body's start to references or back matter."""
        out = []
        for i in range(self.body_start, len(self.lines)):
            t = self.lines[i].text
            if t and (REFERENCES.match(t) or BACK.match(t) or STOP.match(t)):
                break
            out += [i] if t else []
        return out

    def headings(self, most: int = 500, spacing: bool = True, relaxed: bool = False) -> list[tuple[str, Line, int, int]]:
        """(heading, its line, first and last index), continuation lines joined."""
        known: dict[int, bool] = {}

        def candidate(i: int) -> bool:
            if i not in known:
                known[i] = self._is_candidate(i, spacing, relaxed)
            return known[i]

        taken: set[int] = set()
        out: list[tuple[str, Line, int, int]] = []
        seen: set[str] = set()
        body = self._before_back()
        for i in body:
            n = self.lines[i]
            if i in taken or not candidate(i):
                continue
            if self.gaps[i][0] == 0 and n.y <= 125 and not n.bold and not KNOWN.match(n.text) and not NUMBERED.match(n.text):
                earlier = next((o.text for k in range(i - 1, -1, -1) if (o := self.lines[k]).text and not is_page_marker(o.text)), "")
                if earlier and earlier[-1] not in ".?!:;":
                    continue  # a sentence goes on over the page's end
            text, own = n.text, [i]
            while (j := self.below(own[-1])) is not None and j not in taken and j >= self.body_start and self._merges(text, own[-1], j, candidate):
                text = join_heading(text, self.lines[j].text)
                own.append(j)
            taken.update(own)
            text = fragment(text)
            if text and text.casefold() not in seen:
                seen.add(text.casefold())
                out.append((text, n, i, own[-1]))
                if len(out) >= most:
                    return out
        budget = min(5, (max(self.pages, default=0) + 1) // 4)
        extra = []
        for i in body:
            t = self.lines[i].text
            if i not in taken and 2 <= words(t) <= 14 and not REJECT.search(t) and not is_caption(t) and self.gaps[i][0] > 0 and (s := self._priority(self.lines[i])) >= 4:
                extra.append((-s, i, fragment(t)))
        for _, i, t in sorted(extra):
            if budget and t and t.casefold() not in seen:
                seen.add(t.casefold())
                out.append((t, self.lines[i], i, i))
                budget -= 1
        return out

    def following(self, i: int, taken: set[int], most_lines: int = 3, most: int = 420) -> str:
        """The text after a heading, as context."""
        parts: list[str] = []
        for j in range(i + 1, min(len(self.lines), i + 12)):
            t = self.lines[j].text
            if j in taken or t and (STOP.match(t) or BACK.match(t) or PROCEDURE.match(t) or is_caption(t)):
                break
            if t and not is_page_marker(t):
                parts.append(t)
                if len(parts) >= most_lines or sum(map(len, parts)) + len(parts) >= most:
                    break
        return ws(" ".join(parts))[:most]

    # references

    def reference_lines(self) -> list[Line]:
        """The lines of the first reference section, page by page, the left column
        before the right."""
        at = next((i for i, n in enumerate(self.lines) if REFERENCES.match(n.text)), None)
        pages: dict[int, list[Line]] = {}
        for n in self.lines[at + 1 :] if at is not None else []:
            if not n.text or is_page_marker(n.text) or REFERENCES.match(n.text):
                continue
            if REFERENCE_STOP.match(n.text):
                break
            pages.setdefault(n.page, []).append(n)
        out = []
        for _, own in sorted(pages.items()):
            xs = sorted(n.x for n in own)
            gap, split = max(((b - a, (a + b) / 2) for a, b in zip(xs, xs[1:])), key=lambda g: g[0], default=(0.0, 0.0))
            left = sum(x <= split for x in xs)
            two = len(own) >= 6 and gap >= 80 and left >= 3 and len(own) - left >= 3
            out += sorted(own, key=lambda n: (two and n.x > split, n.y, n.x))
        return out

    def references(self, most: int = 500, most_lines: int = 10, most_chars: int = 2200) -> list[tuple[str, Line]]:
        """Entries: cut where one begins, or where it gets too long."""
        groups: list[list[Line]] = []
        full = True
        for n in self.reference_lines():
            if full or ENTRY.match(n.text):
                groups.append([])
            groups[-1].append(n)
            full = len(groups[-1]) >= most_lines or sum(len(o.text) + 1 for o in groups[-1]) >= most_chars
        found: dict[str, tuple[str, Line]] = {}
        for g in groups:
            text = ws(" ".join(n.text for n in g))
            if words(text) >= 6:
                found.setdefault(text.casefold(), (text, g[0]))
        return list(found.values())[:most]


OUT = "kind string, n int, text string, page int, x double, y double, font_size double, bold boolean, following string"


def candidates_of(doc: Document, relaxed: bool = False) -> list[dict]:
    """All candidates of a document, numbered within their kind."""
    out = []
    for kind, most in (("figure", 300), ("table", 250)):
        out += [(kind, t, n, "") for t, n in doc.captions(kind, most)]
    heads = doc.headings(relaxed=relaxed)
    taken = {k for _, _, a, b in heads for k in range(a, b + 1)}
    out += [("heading", t, n, doc.following(b, taken)) for t, n, _, b in heads]
    out += [("reference", t, n, "") for t, n in doc.references()]
    count: Counter = Counter()
    rows = []
    for kind, text, n, after in out:
        count[kind] += 1
        rows.append({"kind": kind, "n": count[kind], "text": text, "page": n.page, "x": n.x, "y": n.y, "font_size": n.size, "bold": n.bold, "following": after})
    return rows


#: Candidates that are sent to Spark at a time.
ROWS_AT_ONCE = 2_000


def assemble(lines: DataFrame, relaxed: bool = False) -> DataFrame:
    """(record_id, kind, n, text, …): captions, headings and references of each
    document, from its layout lines.

    The lines are sorted by document and streamed, as a call for each group would
    take longer than what is done in it.
    """
    names, kind = [c.split()[0] for c in OUT.split(", ")], f"{OUT}, record_id {dict(lines.dtypes)['record_id']}"
    schema = arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[dict] = []
        out: list[dict] = []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], schema.field(c).type) for c in (*names, "record_id")], schema=schema)

        def close() -> None:
            record = own[0]["record_id"]
            out.extend(r | {"record_id": record} for r in candidates_of(Document(own), relaxed))

        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            for row in (dict(zip(b.schema.names, v)) for v in zip(*columns)):
                if own and own[0]["record_id"] != row["record_id"]:
                    close()
                    own = []
                    if len(out) >= ROWS_AT_ONCE:
                        yield made()
                        out = []
                own.append(row)
        if own:
            close()
        if out:
            yield made()

    return batched(lines.repartition("record_id").sortWithinPartitions("record_id")).mapInArrow(run, kind)


def evidence(candidates: DataFrame, kind: str, most: int) -> DataFrame:
    """(record_id, text): the numbered candidates as a prompt, up to the budget."""
    from .candidates import within_budget

    place = F.format_string("[%d] page=%d y=%.1f x=%.1f", "n", F.col("page") + 1, "y", "x")
    entry: Column = F.concat(place, F.lit(" | "), F.col("text"))
    if kind == "heading":
        head = F.concat(place, F.format_string(" font=%.1f bold=%d | candidate: %s", "font_size", F.col("bold").cast("int"), "text"))
        entry = F.when(F.col("following") != "", F.concat(head, F.lit("\n    following_text: "), F.col("following"))).otherwise(head)
    df = candidates.where(F.col("kind") == kind).select("record_id", "n", entry.alias("e"))
    kept = within_budget(df, ["record_id"], F.length("e") + 1, most + 1, "n")
    return kept.groupBy("record_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "e"))), lambda s: s["e"]), "\n").alias("text"))


def token_set_ratio(a: str, b: str) -> float:
    """100 times the best similarity of the sorted common words with and without
    what only one side has; similarity is 2 * LCS / length."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_a, only_b = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not only_a or not only_b):
        return 100.0
    base, s, t = " ".join(both), " ".join(both + only_a), " ".join(both + only_b)
    best = _indel(s, t)
    if both:
        best = max(best, _indel(base, s), _indel(base, t))
    return 100.0 * best


def _indel(a: str, b: str) -> float:
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def table_label(text: str) -> str:
    m = re.match(r"^\s*((?:tabela|tabla|table|tab)\s*\.?\s*(?:s\s*)?(?:\d+[A-Za-z]?|[IVX]+))", text, re.I)
    return re.sub(r"\s+", "", m[1].casefold().replace(".", "")) if m else ""


def distinct_content(values: list[str], tables: bool = False) -> list[str]:
    """Values but for those that equal one before, contain or are contained in it,
    or have about the same words.  Tables of other labels are never the same."""
    out: list[tuple[str, str]] = []
    for v in values:
        k = ws(v).lower()
        rivals = [o for _, o in out if not (tables and table_label(k) and table_label(o) and table_label(k) != table_label(o))]
        if k and not any(k in o or o in k or token_set_ratio(k, o) >= 90 for o in rivals):
            out.append((v.strip() if tables else v, k))
    return [v for v, _ in out]
