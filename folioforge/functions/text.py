"""Scalar text functions and predicates, as native column expressions.

Text is never NULL here: a NULL counts as ''.  White space is Unicode's, with the
separators U+001C to U+001F.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\s\x1c-\x1f]"
_UPPER = "A-ZÁÃÇÉÍÑÓÕÚ"

STOP_WORDS = {
    "en": "a an and are as at be by for from in is it of on or that the this to was were which with",
    "pt": "a ao aos as com como da das de do dos e em na nas no nos o para por que se um uma às",
    "es": "a al como con de del el en la las los para por que se un una y",
}
STOP_WORDS["pt"] = " ".join(w for w in STOP_WORDS["pt"].split() if w != "as")
STOP_WORDS = {k: v.split() for k, v in STOP_WORDS.items()}


def alternatives(*choices: str) -> str:
    """A non-capturing group."""
    return "(?:" + "|".join(choices) + ")"


_SUMMARY = alternatives("abstract", "resumen", "resumo")
_NUMBERED = r"^\s*(?:[\dIVXivx]+(?:\.\d+)*[.)]?\s+)?"
ABSTRACT_HEADING = rf"(?iuU){_NUMBERED}{_SUMMARY}\s*[.:]?\s*$"
ABSTRACT_START = rf"(?iuU){_NUMBERED}{_SUMMARY}\b"
DISCLAIMER = "(?iuU)" + alternatives(
    "submitted", "scielo", "presentado", "preprint", "deposit", "declaram", "responsab",
    r"condi[cç](?:iones|[cç]ões|[aã]o)", r"condi[cç]iones",
    r"conflicts?\s+of\s+interest", r"conflitos?\s+de\s+interesse", r"conflictos?\s+de\s+inter[eé]s", r"potenciais\s+conflitos",
    r"funding\s*(?:information|sources?|statement)?\s*:", r"financiam(?:i?e)?nto\s*:", r"f(?:ue|o)ntes?\s+de\s+financiam(?:i?e)?nto",
)
NEXT_SECTION = (
    rf"(?iuU){_NUMBERED}"
    + alternatives(
        "highlights", "significance", _SUMMARY, "funding", "financiamento", "acknowledg", "agradec", r"author\s+summary", r"plain\s+language\s+summary",
        "keywords?", r"palabras\s+clave", "palavras-chave", "references", "referencias", "referências", "discussion", "discusión", "discussão", "introduction", "introduccion", "introdução",
    )
    + r"(?!\w)"
)
KEYWORD_MARKER = r"(?iuU)\b" + alternatives("descriptors?", "descritores?", r"palabras\s+clave", r"palavras[-\s]+chave", "keywords?") + r"\b"
SUSPECT_KEYWORD = r"(?iuU)\b" + alternatives(
    "resources", "investigation", "conceptualization", "financiamento", "funding", r"formal\s+analysis", r"data\s+curation", r"plain\s+language\s+summary",
    r"author\s+roles?", r"author'?s?\s+contributions?", r"writing[-\s]+(?:review|original\s+draft)", r"conflito\s+de\s+interesses?", r"conflicts?\s+of\s+interest",
) + r"\b"
_LABEL_NUMBER = r"\s*\.?\s*(?:s\s*)?(?:\d+[A-Za-z]?|[IVX]+)"
FIGURE_LABEL = r"(?iuU)^\s*" + alternatives("esquema", "figura", "figure", "fig") + _LABEL_NUMBER + r"\b"
TABLE_LABEL = r"(?iuU)^\s*" + alternatives("tabela", "tabla", "table", "tab") + _LABEL_NUMBER + r"\s*(?:[.:;\-–—]|$)"
REFERENCE_HEADING = r"(?iuU)^\s*" + alternatives("literature cited", "bibliography", "referências", "referencias", "references") + r"\s*[:.]?\s*$"
SECTION_ANCHOR = r"(?iuU)^\s*" + alternatives(r"literature\s+cited", "bibliography", "referências", "referencias", "references", "acknowledge?ments?") + r"\s*[:.]?\s*$"
REFERENCE_STOP = r"(?iuU)^\s*" + alternatives(r"supporting\s+information", r"supplementary\s+material", "acknowledgements?", "appendix") + r"\s*[:.]?\s*$"
_NAME = rf"[{_UPPER}][A-Za-zÀ-ÖØ-öø-ÿ'’`-]"
REFERENCE_ENTRY = r"(?uU)^\s*" + alternatives(
    rf"{_NAME}{{1,40}}\s+[A-Z]{{1,5}}(?:\s+(?:Sr|Jr|I{{2,3}}))?[,:]\s+\S",
    rf"{_NAME}{{1,40}},\s+(?:{_NAME}+|[A-Z]\.)",
    r"\d{1,3}[.)]\s+",
    r"\[\s*\d+\s*\]",
)
DOI = r"(?i)10\.\d{4,9}/[^\s<>\"'\\)]+"
ORCID = r"(?i)^\s*(?:orcid[:\s]*|https?://orcid\.org/)?\d{4}-\d{4}-\d{4}-\d{3}[\dX]\s*$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def text_of(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def strip(x: Column) -> Column:
    """Without white space at the ends, as Python's ``strip``."""
    return F.regexp_replace(text_of(x), rf"(?U)^{WS}+|{WS}+$", "")


def norm_ws(x: Column) -> Column:
    """White space collapsed to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text_of(x), rf"(?U){WS}+", " "))


def word_count(x: Column) -> Column:
    return F.regexp_count(text_of(x), F.lit(r"(?U)\w+"))


def fold_case(x: Column) -> Column:
    """Case folding; of the characters that fold to more than one, ``ß`` is done."""
    return F.replace(F.lower(x), F.lit("ß"), F.lit("ss"))


def support_key(x: Column) -> Column:
    """The key by which selections and duplicates are compared."""
    return fold_case(norm_ws(x))


def support_tokens(key: Column) -> Column:
    """The words of a key but for numbers."""
    return F.filter(F.regexp_extract_all(key, F.lit(r"(?U)(\w+)"), 1), lambda t: ~t.rlike(r"(?U)^\d+$"))


def sentence_chunks(x: Column) -> Column:
    """Sentences: cut where a capital follows a full stop and white space."""
    parts = F.filter(F.transform(F.split(text_of(x), rf"(?U)(?<=[.!?])\s+(?=[{_UPPER}])"), strip), lambda p: p != "")
    return F.when(F.size(parts) > 1, parts).otherwise(F.array(norm_ws(x)))


def is_boilerplate(x: Column) -> Column:
    """Deposit, funding and conflict statements that pass for an abstract."""

    def of(n: Column) -> Column:
        labelled = n.rlike(rf"(?iuU)^\s*{_SUMMARY}\b") & (word_count(n) >= 40)
        return (n != "") & ~labelled & n.rlike(DISCLAIMER)

    return let(norm_ws(x), of)


def language_tokens(x: Column) -> Column:
    return F.transform(F.regexp_extract_all(text_of(x), F.lit(r"([a-zA-ZáéíóúãõçñÁÉÍÓÚÃÕÇÑ]+)"), 1), F.lower)


def language_hits(x: Column) -> Column:
    """Stop-word hits of each language, as a struct."""

    def of(tokens: Column) -> Column:
        hits = lambda w: F.size(F.filter(tokens, lambda t: t.isin(list(w))))  # noqa: E731  # a lambda of two arguments would get the index
        return F.struct(*(hits(w).alias(k) for k, w in STOP_WORDS.items()))

    return let(language_tokens(x), of)


def language_scores(x: Column) -> Column:
    """The hits as a map."""
    return let(language_hits(x), lambda h: F.create_map(*(c for k in STOP_WORDS for c in (F.lit(k), h[k]))))


def detected(hits: Column) -> Column:
    """The language of most hits, ``en`` before ``pt`` before ``es`` in a tie."""
    best = F.greatest(*(hits[k] for k in STOP_WORDS))
    out = F.lit("unknown")
    for k in reversed(STOP_WORDS):
        out = F.when((hits[k] == best) & (best > 0), k).otherwise(out)
    return out


def detect_language(x: Column) -> Column:
    return let(language_hits(x), detected)


def mixed(hits: Column) -> Column:
    """Whether the second language has half the hits of the first, and three."""
    return let(F.sort_array(F.array(*(hits[k] for k in STOP_WORDS)), asc=False), lambda s: (s[0] > 0) & (s[1] >= 3) & (s[1] / F.greatest(s[0], F.lit(1)) >= 0.5))


def is_mixed_language(x: Column) -> Column:
    return let(language_hits(x), mixed)


def language_segments(lines: Column) -> Column:
    """Of a text's lines, the languages that are found in them, the first first,
    without ``unknown``."""
    return F.filter(F.array_distinct(F.transform(lines, detect_language)), lambda k: k != "unknown")


def canonical_language(x: Column) -> Column:
    of = lambda v: F.when(v.isin("pt", "por"), "pt").when(v.isin("en", "eng"), "en").when(v.isin("es", "spa"), "es").when(v == "", "unknown").otherwise(v)
    return let(F.lower(strip(x)), of)


#: How abstracts begin.  A word ends where no letter of any script follows.
ENGLISH_START = r"(?iuU)^\s*(?:an|a|in|we|this|the|abstract)\b"
#: The same where words are of ASCII letters, as in SQL: ``Année`` begins with ``Ann``.
ENGLISH_START_ASCII = r"(?i)^\s*(?:an|a|in|we|this|the|abstract)(?![A-Za-z0-9_])"


def score_abstract(x: Column, start: str = ENGLISH_START, blank: float = float("-inf")) -> Column:
    """How much a text looks like a whole abstract, by how it starts and its length;
    ``blank`` for blanks."""
    one = lambda c, v: F.when(c, F.lit(v)).otherwise(F.lit(0.0))
    score = one(is_boilerplate(x), -5.0)
    score = score + one(text_of(x).rlike(start), 2.0) + one(text_of(x).rlike(r"(?iuU)^\s*(?:resumen|resumo)[:\s]"), -1.0)
    score = score + let(word_count(x), lambda n: F.least(n / F.lit(200.0), F.lit(1.0)) + one(n.between(50, 500), 1.0) + one(n < 30, -2.0) + one(n > 800, -1.0))
    return F.when(strip(x) == "", F.lit(blank)).otherwise(score)


def dehyphenate(x: Column) -> Column:
    """Words rejoined that a line end has divided."""
    return F.regexp_replace(text_of(x), rf"(?U)(?<=\w)-{WS}+(?=\w)", "")


def is_orcid(x: Column) -> Column:
    return text_of(x).rlike(ORCID)


def is_citation_doi(x: Column) -> Column:
    """Not the DOI of a review report."""
    return ~text_of(x).rlike(r"(?i)\.r\d+$")


def is_deposit_doi(x: Column) -> Column:
    return text_of(x).rlike(r"(?i)/zenodo\.")


def is_figure_caption(x: Column) -> Column:
    return let(strip(x), lambda s: F.length(s).between(10, 5000) & s.rlike(FIGURE_LABEL))


def is_table_caption(x: Column) -> Column:
    return let(strip(x), lambda s: F.length(s).between(10, 5000) & s.rlike(TABLE_LABEL))


def caption_is_complete(x: Column) -> Column:
    return let(norm_ws(x), lambda c: (word_count(c) >= 5) & c.rlike(r"[.!?)]\s*$"))


def is_caption_label(s: Column) -> Column:
    return s.rlike(FIGURE_LABEL) | s.rlike(TABLE_LABEL)


def space_words(s: Column) -> Column:
    """Number of words between white space."""
    return F.regexp_count(s, F.lit(rf"(?U)[^\s\x1c-\x1f]+"))


def is_section_heading(x: Column) -> Column:

    def of(s: Column) -> Column:
        digits = strip(F.translate(s, ".,", "")).rlike(r"(?U)^\d+$")
        return F.length(s).between(2, 200) & ~is_caption_label(s) & ~digits & space_words(s).between(1, 20)

    return let(strip(F.regexp_replace(strip(x), ":+$", "")), of)


def is_reference_title(x: Column) -> Column:
    return let(strip(x), lambda s: F.length(s).between(10, 400) & ~is_caption_label(s) & space_words(s).between(3, 60))


def is_reference_entry_start(x: Column) -> Column:
    return text_of(x).rlike(REFERENCE_ENTRY)


def clean_headings(x: Column) -> Column:
    """Headings cut where a section number is embedded, punctuation stripped."""
    n = norm_ws(x)
    parts = F.split(n, rf"\s+(?=\d+(?:\.\d+)+[.)]?\s+[{_UPPER}])")
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, "^[ ;:-]+|[ ;:-]+$", "")), lambda p: p != "")


def strip_heading_number(x: Column) -> Column:
    tail = lambda n: F.regexp_extract(n, r"^\s*(?:\d+(?:\.\d+)*|[IVXivx]+)[.)]?\s+(.+)$", 1)
    return let(norm_ws(x), lambda n: let(tail(n), lambda t: F.when(t != "", F.trim(t)).otherwise(n)))


def has_heading_initial(x: Column) -> Column:
    """A Greek letter, or the first letter or word a capital one."""
    first = lambda s: F.regexp_extract(s, r"(?U)([^\W\d_]+)", 1)
    return let(norm_ws(x), lambda s: s.rlike(r"^[Ͱ-Ͽ]") | first(s).rlike(r"\p{Lu}"))


def is_page_marker(x: Column) -> Column:
    return norm_ws(x).rlike(r"(?i)^(?:page\s+\d+(?:\s+of\s+\d+)?|\d+\s+of\s+\d+|\d+\s*/\s*\d+)$")


def strip_mojibake(x: Column) -> Column:
    """UTF-8 that was read as Latin-1, replaced by ``?``."""
    return F.regexp_replace(text_of(x), "Â[·°]|â€[œ™]|Ã[ñ³´¡ª¨©]|ï¿½", "?")


#: What normal text doesn't have, and the same but for spaces; ``[^a-z0-9']`` takes
#: Java's matcher twenty times as long on a long text.
ABNORMAL, ABNORMAL_WORD = r"[\x00-\x1f!-&(-/:-`{-\x{10ffff}]", r"[\x00-&(-/:-`{-\x{10ffff}]"


def normalize_text(x: Column) -> Column:
    """Lower-case ASCII letters, digits, apostrophes and single spaces."""

    def of(v: Column) -> Column:
        lowered = F.lower(strip(strip_mojibake(v)))
        return F.when(~v.rlike(ABNORMAL_WORD), v).otherwise(F.regexp_replace(F.regexp_replace(lowered, rf"(?U){WS}+", " "), f"{ABNORMAL}+", ""))

    return let(text_of(x), of)  # most words are normal as they are


def all_normal(values: Column) -> Column:
    """Whether :func:`normalize_text` would leave all of an array as they are, asked
    once of the whole array; NULLs count as such."""
    return ~F.array_join(values, "").rlike(ABNORMAL_WORD)


def normalize_tokens(x: Column) -> Column:
    return F.transform(F.regexp_extract_all(text_of(x), F.lit("([A-Za-z0-9]+)"), 1), F.lower)


PARTICLES = ["da", "das", "de", "del", "do", "dos", "e", "la", "los", "y"]


def author_tokens(x: Column) -> Column:
    return F.filter(normalize_tokens(x), lambda t: ~t.isin(PARTICLES))


def scalar_match(gold: Column, predicted: Column) -> Column:
    return let(normalize_text(gold), lambda g: F.when(g == "", None).otherwise((g == normalize_text(predicted)).cast("int")))


def normalize_identifier(x: Column) -> Column:
    n = strip(F.replace(F.lower(strip(x)), F.lit("doi:"), F.lit("")))
    return let(n, lambda v: F.when(v.startswith("10."), F.regexp_replace(v, rf"(?U){WS}+", "")).otherwise(v))


def edit_sim(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance / longer length; two empty texts are equal."""

    def of(x: Column) -> Column:
        longer = F.greatest(F.length(x["a"]), F.length(x["b"]))
        whole = x["a"].startswith(x["b"]) | x["b"].startswith(x["a"]) | x["a"].endswith(x["b"]) | x["b"].endswith(x["a"])
        far = F.when(whole, F.abs(F.length(x["a"]) - F.length(x["b"]))).otherwise(F.levenshtein(x["a"], x["b"]))
        return F.when(x["a"] == x["b"], F.lit(1.0)).otherwise(1 - far / longer)

    return let(F.struct(text_of(a).alias("a"), text_of(b).alias("b")), of)


def most_sim(a: Column, b: Column) -> Column:
    """What the edit similarity is at most, by the lengths."""
    longer = F.greatest(F.length(a), F.length(b), F.lit(1))
    return 1 - F.abs(F.length(a) - F.length(b)) / longer


def normalized_edit_sim(a: Column, b: Column) -> Column:
    return edit_sim(normalize_text(a), normalize_text(b))


def max_edit_sim(predicted: Column, golds: Column) -> Column:
    return F.array_max(F.transform(golds, lambda g: edit_sim(predicted, g)))


_ALIASES = {"eng": "en eng", "por": "pt por pt-br ptbr po", "spa": "es spa sp", "fra": "fr fra", "deu": "de deu ger", "ita": "it ita"}


def language_match(gold: Column, predicted: Column) -> Column:
    """1 or 0 by language, whatever the code; NULL without a gold language."""
    table = F.create_map(*(F.lit(c) for k, names in _ALIASES.items() for n in names.split() for c in (n, k)))
    code = lambda x: let(normalize_text(x), lambda v: F.coalesce(F.try_element_at(table, v), v))
    return F.when(text_of(gold) == "", None).otherwise(let(code(predicted), lambda p: F.when(p == "", 0).otherwise((code(gold) == p).cast("int"))))


def caption_match(gold: Column, predicted: Column) -> Column:
    """Similar, or the shorter (12 characters or more) begins the longer and has
    at least two fifths of its length."""
    return let(F.struct(normalize_text(gold).alias("g"), normalize_text(predicted).alias("p")), lambda x: normal_captions_match(x["g"], x["p"]))


def normal_captions_match(g: Column, p: Column) -> Column:
    """The same of normalised captions.  The lengths bound the similarity, so most
    pairs need no edit distance."""
    short, long = F.least(F.length(g), F.length(p)), F.greatest(F.length(g), F.length(p))
    begins = (F.length(g) <= F.length(p)) & p.startswith(g) | (F.length(p) < F.length(g)) & g.startswith(p)
    begun = (short >= 12) & (short / F.greatest(long, F.lit(1)) >= 0.4) & begins
    return F.when(begun, F.lit(True)).when(most_sim(g, p) < 0.75, F.lit(False)).otherwise(edit_sim(g, p) >= 0.75)


def normalize_reference_title(x: Column) -> Column:
    tail = alternatives("abgerufen", "accessed", r"available\s+at", "cited", "consultad[ao]", "disponible", "disponivel", "extraido", "obtenido", "opgehaald", "recuperado", "retrieved", "url:?")
    v = F.regexp_replace(strip(x), rf"(?iuU)\.\s*{tail}\b.*$", "")
    v = F.regexp_replace(v, r"(?iU)\.\s*[a-z]\d+(?:[-/]\d+)?\s*$", "")
    return F.trim(F.regexp_replace(norm_ws(v), r"\.+$", ""))


def shorten(x: Column, most: int = 160) -> Column:
    """At most so many characters, the last three of them dots if any is cut."""
    n = F.replace(strip(x), F.lit("\n"), F.lit(" "))
    return F.when(F.length(n) <= most, n).otherwise(F.concat(F.substring(n, 1, most - 3), F.lit("...")))


def token_set(x: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text_of(x)), F.lit("([a-z0-9]+)"), 1))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets as arrays; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def safe_list(x: Column) -> Column:
    """An array of strings, trimmed, without blanks; NULL is none."""
    return F.filter(F.transform(F.coalesce(x, F.array().cast("array<string>")), strip), lambda v: v != "")


def safe_filename(x: Column) -> Column:
    return F.regexp_replace(text_of(x), "[^A-Za-z0-9._-]+", "_")


def preprint_identifiers(record_id: Column, url: str = "https://preprints.scielo.org/index.php/scielo/preprint/view/", doi: str = "10.1590/SciELOPreprints.") -> Column:
    """Landing URL and DOI of a record whose id ends in ``preprint_<number>``."""
    n = F.regexp_extract(text_of(record_id), r"preprint_(\d+)$", 1)
    return F.when(n == "", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit(url), n), F.concat(F.lit(doi), n)))


def canonical_model(x: Column) -> Column:
    return F.regexp_replace(F.lower(text_of(x)), "[-_./]+", "")


def finite(x: Column) -> Column:
    """NULL for what isn't a finite number."""
    return F.when(F.isnan(x) | x.isin(float("inf"), float("-inf")), None).otherwise(x)
