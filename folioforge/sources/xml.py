"""Readers of XML documents: layout (ALTO), parser output (TEI) and gold records
(OAI-DC and JATS).  Trees have no column expressions, so each reader is a pandas
UDF from the document's text to a struct or rows; a document that isn't well formed
gives NULL (or, for abstracts and content, empty values)."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.udf import arrow_schema, batched, pandas_udf

_LANG = "{http://www.w3.org/XML/1998/namespace}lang"
_WORD = re.compile(r"\w+")


def name(e: ET.Element) -> str:
    """A tag without its namespace."""
    return e.tag.rsplit("}", 1)[-1] if isinstance(e.tag, str) else ""


def find(e: ET.Element, *names: str) -> Iterator[ET.Element]:
    """The element itself and what is below it, of the names, in order."""
    return (x for x in e.iter() if name(x) in names)


def first(e: ET.Element | None, *names: str) -> ET.Element | None:
    return None if e is None else next(find(e, *names), None)


def inner(e: ET.Element | None) -> str:
    """All text below an element, its pieces stripped and joined by spaces."""
    return "" if e is None else " ".join(p for t in e.itertext() if (p := t.strip()))


def texts(e: ET.Element, *names: str) -> list[str]:
    return [t for x in find(e, *names) if (t := inner(x))]


def child(e: ET.Element, tag: str) -> ET.Element | None:
    return next((x for x in e if name(x) == tag), None)


def words(s: str) -> int:
    return len(_WORD.findall(s))


def squeeze(s: str | None) -> str:
    return " ".join((s or "").split())


def distinct(values: list[str]) -> list[str]:
    out: dict[str, str] = {}
    for v in values:
        if key := squeeze(v).casefold():
            out.setdefault(key, v)
    return list(out.values())


# OAI-DC

_DC = "{http://purl.org/dc/elements/1.1/}"
_SCALARS = "title abstract publisher date language rights".split()
HEADER = "title string, titles array<string>, authors array<string>, abstract string, abstracts array<string>, keywords array<string>, keywords_groups map<string,array<string>>, publisher string, date string, language string, identifiers array<string>, relations array<string>, rights string, types array<string>, formats array<string>"
CONTENT = "body_sections array<string>, figure_captions array<string>, table_captions array<string>, reference_dois array<string>, reference_titles array<string>"
JATS = f"{HEADER}, {CONTENT}, reference_records array<struct<doi:string,title:string>>, formula_count int"


def is_placeholder(s: str) -> bool:
    return re.sub("[^a-z0-9]+", "", s.lower()) in ("na", "nada", "nan", "none", "null")


def oai_dc(xml: str) -> dict:
    """A gold record of Dublin Core elements, placeholders dropped."""
    root = ET.fromstring(xml)

    def values(tag: str) -> list[tuple[str, str]]:
        found = ((x.get(_LANG) or x.get("lang") or "unknown", (x.text or "").strip()) for x in root.iter(_DC + tag) if x is not root)
        return [(lang, t) for lang, t in found if t and not is_placeholder(t)]

    many = {k: [t for _, t in values(k)] for k in "title creator description subject publisher date language identifier relation rights type format".split()}
    one = lambda k: many[k][0] if many[k] else ""
    groups: dict[str, list[str]] = {}
    for lang, t in values("subject"):
        groups.setdefault(lang, []).append(t)
    out = {k: one(k) for k in ("title", "publisher", "date", "language", "rights")}
    out |= {"titles": many["title"], "authors": many["creator"], "abstract": one("description"), "abstracts": many["description"], "keywords": many["subject"], "keywords_groups": groups}
    return out | {f"{k}s": many[k] for k in ("identifier", "relation", "type", "format")}


# JATS


def jats(xml: str) -> dict:
    """A gold record of an article: header fields of its first ``article-meta``, and
    the content of body and back."""
    root = ET.fromstring(xml)
    meta = first(root, "article-meta")
    meta = root if meta is None else meta
    titles, abstracts = texts(meta, "article-title", "trans-title"), texts(meta, "abstract", "trans-abstract")
    authors = []
    for c in find(meta, "contrib"):
        if (c.get("contrib-type", "author") or "author").lower() == "author" and (n := first(c, "name")) is not None:
            parts = {name(x): inner(x) for x in n}
            if parts.get("surname"):
                authors.append(f"{parts.get('given-names', '')} {parts['surname']}".strip())
    keywords, groups = [], {}
    for g in find(meta, "kwd-group"):
        if own := texts(g, "kwd"):
            groups.setdefault(g.get(_LANG) or g.get("lang") or "unknown", []).extend(own)
            keywords += own
    doi = next((inner(x) for x in find(meta, "article-id") if x.get("pub-id-type") == "doi"), "")
    sections = [t for s in find(body, "sec") if (t := inner(child(s, "title")))] if (body := first(root, "body")) is not None else []

    def captions(tag: str) -> list[str]:
        out = []
        for x in find(root, tag):
            parts = {name(k): inner(k) for k in x}
            out.append(" ".join(p for p in (parts.get("label"), parts.get("caption")) if p))
        return [c for c in out if c]

    records = []
    for r in find(root, "ref"):
        d = next((t for x in find(r, "pub-id") if (x.get("pub-id-type") or "").lower() == "doi" and (t := inner(x))), "")
        t = next(iter(texts(r, "article-title") or texts(r, "source")), "")
        if d or t:
            records.append({"doi": d, "title": t})
    out = dict.fromkeys(("date", "rights"), "") | {k: [] for k in ("relations", "types", "formats")}
    out |= {"title": titles[0] if titles else "", "titles": titles, "authors": authors, "abstract": abstracts[0] if abstracts else "", "abstracts": abstracts}
    out |= {"keywords": keywords or texts(meta, "kwd"), "keywords_groups": groups, "publisher": inner(first(meta, "publisher-name")), "language": root.get(_LANG, ""), "identifiers": [doi] if doi else []}
    out |= {"body_sections": sections, "figure_captions": captions("fig"), "table_captions": captions("table-wrap"), "reference_dois": [r["doi"] for r in records if r["doi"]], "reference_titles": [r["title"] for r in records if r["title"]], "reference_records": records}
    return out | {"formula_count": sum(1 for _ in find(root, "disp-formula", "inline-formula"))}


# TEI

TEI_HEADER = "title string, authors array<string>, abstract string, keywords array<string>, identifiers array<string>, language string"
TEI_CONTENT = f"{CONTENT}, formula_count int"


def _rx(*parts: str, begin: str = r"^\s*", end: str = "") -> re.Pattern:
    return re.compile(begin + "(?:" + "|".join(parts) + ")" + end, re.I)


_LABELS = ("resumen", "resumo", "abstract")
_INTRO = ("introduc(?:tion|cion|ao)",)
_METHOD, _RESULT, _AIM = ("metodos?", "methods?"), ("resultados", "results?"), ("background", "objeti(?:ve|vo)")
_HEAD = _rx(*_LABELS, end=r"\s*:?\s*$")
_HEAD_TAIL = re.compile(r"^\s*(?:resumen|resumo|abstract)\b\s*[:.-]?\s*(.*)$", re.I)
_GOES_ON = _rx("conclus(?:ao|oes|ions?:?)", end=r"\s*:?\s*$")
_STOP = _rx(*_INTRO, "metodologia", *_METHOD, *_RESULT, "discussao", "discusi?on", "discussion", "referencias", "references?", end=r"\b")
_STRUCTURED = _rx(*_AIM, *_INTRO, *_RESULT, *_METHOD, "metodo", end=r"\s*[:.]")
_STRUCTURED_HEAD = _rx("summary", *_AIM, *_INTRO, *_RESULT, *_METHOD, "metodolog[ií]a", "conclus(?:iones|oes|ões|ions?)", end=r"\b")
_STRUCTURED_START = _rx("summary", *_AIM, *_INTRO, end=r"\b")
_KEYWORDS = _rx("descriptors?", "descritores?", r"palabras\s+claves?", r"palavras[-\s]+chave", "key-?words?", begin=r"\b", end=r"\s*[:.]?\s*")
_DISCLOSURE = _rx("declar(?:am|e)", "funding", r"fontes?\s+de\s+financiamento", r"conflicts?\s+of\s+interest", r"conflitos?\s+de\s+interesse", begin=r"\b", end=r"\b")
_SUMMARY = re.compile(r"\b(?:abstract|summary)\b\s*[:.]?\s+(.+)$", re.I)
_BLEED = re.compile(r"\s+(?:below\s+we\s+describe|a\s+seguir|as\s+shown\s+in\s+fig(?:ure)?|conforme\s+demonstrado\s+na\s+figura)\b.*$", re.I)
_EDGE = " ;.:-"


def _head(e: ET.Element) -> str:
    return inner(child(e, "head"))


def _head_tail(head: str) -> str:
    """What follows the label in a heading."""
    m = _HEAD_TAIL.match(head)
    return m[1].strip(_EDGE) if m else ""


def split_keywords(text: str) -> tuple[str, list[str]]:
    """A text without its keyword line, and the keywords.  A summary that follows
    them belongs to the text."""
    text = squeeze(text)
    m = _KEYWORDS.search(text)
    if not m:
        return text, []
    before, tail = text[: m.start()].strip(" ;:-"), text[m.end() :].strip()
    if s := _SUMMARY.search(tail):
        before = f"{before} {tail[s.start() :].strip(_EDGE)}".strip()
        tail = tail[: s.start()].strip()
    return before, [k for p in re.split(r"\s*[;,]\s*|\.\s+", tail) if (k := p.strip(_EDGE))]


def _div(e: ET.Element) -> tuple[str, list[str]]:
    """The text and keywords of a division."""
    parts = [split_keywords(inner(p)) for p in e if name(p) == "p"]
    found, keys = [t for t, _ in parts if t], [k for _, ks in parts for k in ks]
    if not found:
        text, more = split_keywords(inner(e))
        head = _head(e)
        text = text[len(head) :].strip(_EDGE) if head and text.startswith(head) else text
        found, keys = [text] if text else [], keys + more
    return " ".join(found).strip(), keys


def _container(e: ET.Element) -> tuple[list[str], list[str]]:
    """The abstracts in an ``abstract`` element: one for each language heading."""
    divs = [x for x in e if name(x) == "div"]
    if not divs:
        text, keys = split_keywords(inner(e))
        return [text] if text else [], keys
    read = [(_head(d), *_div(d)) for d in divs]
    keys: list[str] = []
    if not any(_HEAD.match(h) or _head_tail(h) for h, _, _ in read):
        text = squeeze(" ".join(b for _, b, _ in read if b))
        return [text] if text else [], [k for _, _, ks in read for k in ks]
    groups: list[list[str]] = [[]]
    for head, body, own in read:
        keys += own
        now = groups[-1]
        if _STOP.match(head):
            break
        if _HEAD.match(head) or _head_tail(head):
            groups.append([p for p in (_head_tail(head), body) if p])
        elif (_GOES_ON.match(head) or not head) and now and not _STRUCTURED.match(body):
            now += [body] if body else []
        elif _STRUCTURED.match(body):
            now.append(body)
        else:
            groups.append([])
    return [t for g in groups if (t := " ".join(g).strip())], keys


def _structured(body: ET.Element | None) -> list[str]:
    """Abstracts that the parser took for the body's first sections."""
    out: list[str] = []
    now: list[str] = []

    def flush() -> None:
        text = " ".join(now).strip()
        if 40 <= words(text) <= 700 and not _DISCLOSURE.search(text):
            out.append(text)
        now.clear()

    for d in find(body, "div") if body is not None else ():
        head = _head(d)
        if not _STRUCTURED_HEAD.match(head):
            flush()
            if out:
                break
            continue
        text = " ".join(p for p in (head.rstrip(" :."), _div(d)[0]) if p).strip()
        if not text:
            continue
        if now and _STRUCTURED_START.match(head):
            m = _SUMMARY.search(" ".join(now))
            carry = m[1].strip() if m and words(m[1]) >= 20 else ""
            flush()
            now += [carry] if carry else []
        now.append(text)
    flush()
    return out


def _lead(body: ET.Element | None) -> list[str]:
    """The body's first division that could be an abstract."""
    for d in find(body, "div") if body is not None else ():
        if _STOP.match(_head(d)) or _DISCLOSURE.search(_head(d)):
            continue
        parts: list[str] = []
        for p in d:
            if name(p) == "p":
                if text := split_keywords(inner(p))[0]:
                    parts.append(text)
                if words(" ".join(parts)) >= 40 or len(parts) >= 2:
                    break
        text = " ".join(parts).strip()
        cut = _BLEED.sub("", text, count=1).strip(" ;,.:-")
        text = cut if _BLEED.search(text) and words(cut) >= 40 else text
        if 40 <= words(text) <= 350 and not _DISCLOSURE.search(text):
            return [text]
    return []


def tei_abstracts_of(root: ET.Element) -> list[str]:
    found, content = [], False
    for a in find(root, "abstract"):
        content |= bool(inner(a))
        found += _container(a)[0]
    for d in find(root, "div"):
        head = _head(d)
        if _HEAD.match(head) or _head_tail(head):
            found.append(" ".join(p for p in (_head_tail(head), _div(d)[0]) if p))
    if not content:
        body = first(root, "body")
        found += _structured(body)
        found += _lead(body) if not any(squeeze(f) for f in found) else []
    return distinct([squeeze(f) for f in found])


def tei_abstracts(xml: str) -> list[str]:
    try:
        return tei_abstracts_of(ET.fromstring(xml))
    except ET.ParseError:
        return []


def tei_header(xml: str) -> dict:
    """The header fields of parser output."""
    root = ET.fromstring(xml)
    head = first(root, "teiHeader")
    head = root if head is None else head
    abstract = next((t for a in find(head, "abstract") if (t := squeeze(inner(a))) and not _DISCLOSURE.search(t)), "")
    if not abstract:
        every = tei_abstracts_of(root)
        abstract = next((a for a in every if not _DISCLOSURE.search(a)), every[0] if every else "")
    authors = [t for a in find(head, "author") for t in texts(a, "persName")]
    return {"title": next(iter(texts(head, "title")), ""), "authors": authors, "abstract": abstract, "keywords": texts(head, "term"), "identifiers": texts(head, "idno"), "language": head.get(_LANG, "")}


_DOI = re.compile(r"\b10\.\d{4,9}/[^\s)\]>;,\"']+", re.I)


def tei_content(xml: str) -> dict:
    """Section heads, captions, references and formulas of parser output."""
    out: dict = {k.split()[0]: [] for k in CONTENT.split(", ")} | {"formula_count": 0}
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return out
    body = first(root, "body")
    if body is not None:
        out["body_sections"] = [t for d in find(body, "div") if (t := _head(d))]
    for f in find(root, "figure"):
        caption = " ".join(p for p in (_head(f), inner(child(f, "figDesc"))) if p)
        if caption:
            out["table_captions" if (f.get("type") or "").lower() == "table" else "figure_captions"].append(caption)
    own = {id(b) for s in find(root, "sourceDesc") for b in find(s, "biblStruct")}
    for b in find(root, "biblStruct"):
        if id(b) in own:
            continue
        doi = next((t for x in find(b, "idno") if (x.get("type") or "").lower() == "doi" and (t := inner(x))), "")
        for text in [x.get("target") or "" for x in find(b, "ptr")] + [inner(b)]:
            if not doi and (m := _DOI.search(text)):
                doi = m[0].rstrip(".,;:)")
        if doi:
            out["reference_dois"].append(doi)
        if title := next((t for x in find(b, "title") if (x.get("level") or "").lower() == "a" and (t := inner(x))), ""):
            out["reference_titles"].append(title)
    return out | {"formula_count": sum(1 for _ in find(root, "formula"))}


def header_text(xml: Column, most: int = 12_000) -> Column:
    """The header element of parser output as text, or the text's beginning: a
    prompt has a limit."""
    lo, hi = F.locate("<teiHeader", xml), F.locate("</teiHeader>", xml)
    return F.substr(F.when((lo > 0) & (hi > 0), F.substr(xml, lo, hi + len("</teiHeader>") - lo)).otherwise(xml), F.lit(1), F.lit(most))


# ALTO

_FONT = ("font_family", "font_type", "font_color")
STRING = "struct<content:string,font_size:double,is_superscript:boolean,is_bold:boolean,is_italic:boolean,font_family:string,font_type:string,font_color:string>"
LINE = (
    "pos int, text string, x double, y double, w double, h double, font_size double, bold boolean, italic boolean, font_family string, font_type string, font_color string, "
    "style_refs array<string>, page int, page_w double, page_h double, block_id string, block_hpos double, block_vpos double, block_w double, block_h double, block_line_count int, "
    f"is_block_first_line boolean, block_col int, strings array<{STRING}>, doc_body_family string, doc_body_type string, doc_body_color string"
)


def _float(e: ET.Element, *names: str) -> list[float]:
    """Attributes as numbers; all 0 if one isn't a number."""
    try:
        return [float(e.get(n) or 0) for n in names]
    except ValueError:
        return [0.0] * len(names)


def _heaviest(pairs: Iterable[tuple[object, int]]) -> object | None:
    """The value of the greatest total weight, the first seen in a tie."""
    total: dict = {}
    for v, w in pairs:
        if v:
            total[v] = total.get(v, 0) + w
    return max(total, key=total.get) if total else None


def _below(root: ET.Element) -> Callable[[ET.Element, str], Iterator[ET.Element]]:
    """:func:`find` by one name in a tree, by its only tag where it has one."""
    tags: dict[str, list[str]] = {}
    for t in {e.tag for e in root.iter() if isinstance(e.tag, str)}:
        tags.setdefault(t.rsplit("}", 1)[-1], []).append(t)

    def below(e: ET.Element, local: str) -> Iterator[ET.Element]:
        own = tags.get(local, ())
        return e.iter(own[0]) if len(own) == 1 else find(e, local) if own else iter(())

    return below


_MERGED = ("font_size", *_FONT)
_FACE = ("is_superscript", "is_bold", "is_italic")


def alto_lines(xml: str, strings: bool = True) -> list[dict]:
    """The layout lines of a document in reading order; their ``strings`` if they are
    asked for, as a list for each of the struct's fields."""
    root = ET.fromstring(xml)
    below = _below(root)
    styles = {}
    for s in below(root, "TextStyle"):
        face = (s.get("FONTSTYLE") or "").lower()
        styles[s.get("ID")] = {"font_size": _float(s, "FONTSIZE")[0], **{f"is_{k}": k in face for k in ("superscript", "bold", "italic")}, **{k: (s.get(k.replace("_", "").upper()) or "").strip().lower() for k in _FONT}}
    named: dict[str, tuple] = {}  # by the attribute: its references, what they make together

    def style(refs: str) -> tuple:
        own = refs.split()
        known = [styles[r] for r in own if r in styles]
        merged = {k: next((x[k] for x in known if x[k]), None) for k in _MERGED} | {k: any(x[k] for x in known) for k in _FACE}
        named[refs] = own, merged
        return named[refs]

    local: dict[object, bool] = {}  # tags by whether they are a String's
    out = []
    for p, pg in enumerate(below(root, "Page")):
        page_w, page_h = _float(pg, "WIDTH")[0], _float(pg, "HEIGHT")[0]
        for n, block in enumerate(below(pg, "TextBlock")):
            box = dict(zip(("block_hpos", "block_vpos", "block_w", "block_h"), _float(block, "HPOS", "VPOS", "WIDTH", "HEIGHT")))
            inside = list(below(block, "TextLine"))
            block_col = int(box["block_hpos"] >= (page_w / 2 if page_w > 0 else 306.0))
            for i, line in enumerate(inside):
                contents: list[str] = []
                by: list[str] = []  # the style attribute of each string
                refs: set[str] = set()
                for s in line:
                    tag = s.tag
                    if tag not in local:
                        local[tag] = name(s) == "String"
                    if local[tag]:
                        ref = s.get("STYLEREFS") or ""
                        refs.add(ref)
                        if content := (s.get("CONTENT") or "").strip():
                            contents.append(content)
                            by.append(ref)
                if not contents:
                    continue
                made = {r: named.get(r) or style(r) for r in refs}
                plain = [not made[r][1]["is_superscript"] for r in by] if len(refs) > 1 else None
                some = plain is not None and any(plain) and not all(plain)
                body = [c for c, b in zip(contents, plain) if b] if some else contents
                weight: dict[str, int] = {}  # the characters of each style, in order
                for c, r in zip(body, (r for r, b in zip(by, plain) if b) if some else by):
                    weight[r] = weight.get(r, 0) + len(c)
                parts, total = [(made[r][1], w) for r, w in weight.items()], sum(weight.values())
                share = lambda k: sum(w for s, w in parts if s[k]) * 2 > total  # noqa: B023, E731
                x, y, w, h = _float(line, "HPOS", "VPOS", "WIDTH", "HEIGHT")
                row = {
                    "text": " ".join(body), "x": x, "y": y, "w": w, "h": h,
                    "font_size": _heaviest((round((s["font_size"] or 0) * 10) / 10, w) for s, w in parts) or 0.0, "bold": share("is_bold"), "italic": share("is_italic"),
                    **{k: _heaviest((s[k], w) for s, w in parts) or "" for k in _FONT}, "style_refs": sorted({k for r in refs for k in made[r][0]}), "page": p, "page_w": page_w, "page_h": page_h,
                    "block_id": block.get("ID", f"p{p}_b{n}"), **box, "block_line_count": len(inside), "is_block_first_line": i == 0, "block_col": block_col,
                }
                if strings:
                    row["strings"] = contents, [made[r][1] for r in by]
                out.append(row)
    out.sort(key=lambda r: (r["page"], r["block_col"], r["block_vpos"], r["y"], r["x"]))
    body = [r for r in out if len(r["text"]) >= 30 and not r["bold"]]
    usual = {f"doc_body_{k[5:]}": _heaviest((r[k], len(r["text"])) for r in body) or "" for k in _FONT}
    return [{"pos": i, **r, **usual} for i, r in enumerate(out)]


# as columns


def _try(f: Callable[[str], object], x: str | None) -> object:
    if x is None:
        return None
    try:
        return f(x)
    except ET.ParseError:
        return None


def _struct_udf(f: Callable[[str], dict], schema: str) -> Callable[[Column], Column]:
    names = [c.split()[0] for c in re.sub("<[^ ]*>", "", schema).split(", ")]

    def run(xml: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([{n: (r or {}).get(n) for n in names} for r in (_try(f, x) for x in xml)], columns=names)

    kind = ",".join(f"{n}:{t}" for n, t in (c.split(" ", 1) for c in schema.split(", ")))
    return pandas_udf(f"struct<{kind}>")(run)


read_oai_dc = _struct_udf(oai_dc, HEADER)
read_jats = _struct_udf(jats, JATS)
read_tei_header = _struct_udf(tei_header, TEI_HEADER)
read_tei_content = _struct_udf(tei_content, TEI_CONTENT)


@pandas_udf("array<string>")
def read_tei_abstracts(xml: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else tei_abstracts(x) for x in xml])


#: Layout lines that are sent to Spark at a time.
LINES_AT_ONCE = 2_000


def _strings(rows: list[dict], kind: pa.ListType) -> pa.Array:
    """The strings of lines, made column by column."""
    flat = [m for r in rows for m in r["strings"][1]]
    ends = np.cumsum([0, *(len(r["strings"][0]) for r in rows)])
    fields = [pa.array([c for r in rows for c in r["strings"][0]] if f.name == "content" else [m[f.name] for m in flat], f.type) for f in kind.value_type]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(kind.value_type)), type=kind)


def read_alto(documents: DataFrame, xml: str = "xml", columns: Sequence[str] | None = None) -> DataFrame:
    """(record_id, line columns): the layout lines of documents (record_id, xml), with
    the ``columns`` that are wanted, by default all.  Spark can't tell a Python
    function what isn't used, and a line's strings are most of its size."""
    every = dict(c.split(" ", 1) for c in re.split(r", (?=\w+ )", LINE))
    wanted = [c for c in every if columns is None or c in columns]
    kind = ", ".join([*(f"{c} {every[c]}" for c in wanted), f"record_id {dict(documents.dtypes)['record_id']}"])
    schema = arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, at = [], []

            def made() -> pa.RecordBatch:
                own = [_strings(rows, schema.field(c).type) if c == "strings" else pa.array([r[c] for r in rows], schema.field(c).type) for c in wanted]  # noqa: B023
                return pa.RecordBatch.from_arrays([*own, b.column(0).take(pa.array(at, pa.int32())).cast(schema.field("record_id").type)], schema=schema)  # noqa: B023

            for i in range(b.num_rows):
                found = _try(lambda x: alto_lines(x, "strings" in wanted), b.column(1)[i].as_py()) or []
                rows += found
                at += [i] * len(found)
                if len(rows) >= LINES_AT_ONCE:
                    yield made()
                    rows, at = [], []
            if rows:
                yield made()

    return batched(documents.select("record_id", xml)).mapInArrow(run, kind)


def read_gold(corpus: Column, xml: Column) -> Column:
    """The gold record by corpus: Dublin Core for the preprint server's corpus
    (``*_preprints``), JATS for all others."""
    dc = read_oai_dc(F.when(corpus.endswith("_preprints"), xml))
    full = read_jats(F.when(~corpus.endswith("_preprints"), xml))
    names = [c.split()[0] for c in re.sub("<[^ ]*>", "", HEADER).split(", ")]
    return F.struct(*(F.coalesce(dc[n], full[n]).alias(n) for n in names), *(full[n].alias(n) for n in [c.split(":")[0].split()[0] for c in re.sub("<[^ ]*>", "", JATS).split(", ")] if n not in names))
