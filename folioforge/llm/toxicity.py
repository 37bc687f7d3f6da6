"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding maps accents, fullwidth letters, Cyrillic and Greek look-alikes and
digits or signs that stand for letters to ``a``-``z``, removes zero-width
characters and lower-cases, so that ``ѕtuр1d`` is ``stupid``.  Words with accented
letters are matched a second time with the accents kept, for terms that only
differ from clean words in them.  One automaton holds the terms and the exception
phrases; a term counts where it stands as a word (or begins one, for a stem) and
no exception phrase covers it.  The score is the sum of the weights for each 100
words, over the number of words and ``SMOOTH`` more, so that one chance hit in a
line of text doesn't pass for a high rate.

The lexicon is a list from a file (``lexicon.tsv``: English, French, Spanish and
German, all matched in every text) joined by stems learned from labelled documents:
a bounded, hash-ordered sample of labels (``max_rows``) gives the stems that toxic
documents use many times as often as others.  A learned stem weighs as much as the
logarithm of how many times; the scale of the weights is fitted to the threshold.
"""

from __future__ import annotations

import math
import os
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, set_aside, written

#: A document is toxic from this score (weight for each 100 words) on.
THRESHOLD = 0.25
#: Rows of the labels that the learned terms are fitted on, at most.
MAX_LABELLED_ROWS = 8192
#: Words added to a document's length.
SMOOTH = 40

#: The fixed lexicon: language, kind, weight and term by line.
LEXICON = os.path.join(os.path.dirname(__file__), "lexicon.tsv")


_LOOKS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ғ": "f", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ı": "i", "ſ": "s", "ɡ": "g", "ɑ": "a", "ⅼ": "l",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e",
}


def _fold_char(c: str) -> str:
    """The folding of one character: lower-case ASCII letters, '' or ' '."""
    out = []
    for x in unicodedata.normalize("NFKD", c):
        if unicodedata.combining(x) or unicodedata.category(x) == "Cf":
            continue
        for y in unicodedata.normalize("NFKD", _LOOKS.get(x.lower(), x.lower())):
            y = _LOOKS.get(y, y)
            out.append("".join(z if "a" <= z <= "z" else " " for z in y))
    return "".join(out)


class _Folding(dict):
    """A table for ``str.translate`` that is filled as characters are met."""

    def __missing__(self, code: int) -> str:
        self[code] = out = _fold_char(chr(code))
        return out


class _Keeping(dict):
    """The same but for accented Latin letters, which stay, in lower case."""

    def __missing__(self, code: int) -> str:
        c = unicodedata.normalize("NFC", chr(code).lower())
        parts = unicodedata.normalize("NFD", c)
        self[code] = out = c if len(c) == 1 and len(parts) > 1 and "a" <= parts[0] <= "z" else _TABLE[code]
        return out


_TABLE = _Folding()
_ACCENTS = _Keeping()


def fold(text: str) -> str:
    """``text`` in lower-case ASCII letters; what isn't a letter is a space."""
    return text.translate(_TABLE)


def accented(text: str) -> list[str]:
    """The words that have accented letters, folded but for those."""
    return [] if text.isascii() else [w for w in unicodedata.normalize("NFC", text).translate(_ACCENTS).split() if not w.isascii()]


@dataclass(frozen=True)
class Lexicon:
    """Weights of words, weights of stems (matched at the start of a word; those
    with accented letters only where the text has them) and phrases in which
    terms don't count.  All are folded."""

    words: dict[str, float]
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()

    def automaton(self) -> ahocorasick.Automaton | None:
        a, entries = ahocorasick.Automaton(), {}
        for kind, terms in (("stem", self.stems), ("word", self.words), ("except", dict.fromkeys(self.exceptions, 0.0))):
            for term, weight in terms.items():
                folded = " ".join(fold(term).split()) if term.isascii() or kind != "stem" else " ".join(accented(term))
                if folded:
                    entries.setdefault(" " + folded + ("" if kind == "stem" else " "), (kind, weight))
        for term, (kind, weight) in entries.items():
            a.add_word(term, (kind, len(term), weight))
        if not entries:
            return None
        a.make_automaton()
        return a


def load(path: str = LEXICON) -> Lexicon:
    """The lexicon of a file."""
    words, stems, exceptions = {}, {}, []
    with open(path, encoding="utf-8") as lines:
        for line in lines:
            if line.strip() and not line.startswith("#"):
                _, kind, weight, term = line.rstrip("\n").split("\t")
                if kind == "except":
                    exceptions.append(term)
                else:
                    (words if kind == "word" else stems)[term] = float(weight)
    return Lexicon(words, stems, tuple(exceptions))


def score_text(a: ahocorasick.Automaton | None, text: str) -> tuple[float, int, int]:
    """(score, hits, words) of one text."""
    split = fold(text).split()
    if not split or a is None:
        return 0.0, 0, len(split)
    hits, spans, extra = [], [], accented(text)
    for end, (kind, size, weight) in a.iter(" " + " ".join(split) + (" | " + " ".join(extra) if extra else "") + " "):
        if kind == "except":
            spans.append((end - size + 1, end))
        else:
            hits.append((end - size + 1, end, weight, kind))
    if not hits:
        return 0.0, 0, len(split)
    best: dict[int, float] = {}  # a word counts once, with its heaviest term
    for lo, hi, weight, _ in hits:
        if not any(s <= lo and hi <= e for s, e in spans):
            best[lo] = max(weight, best.get(lo, 0.0))
    return 100.0 * math.fsum(best.values()) / (len(split) + SMOOTH), len(best), len(split)


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with ``tox_score`` double, ``tox_hits`` int and ``toxic``
    boolean; a clashing column of the input gets the prefix ``input_``.

    NULL and empty texts, and those without a letter, score 0 and aren't toxic.
    Every row is scored by itself, so repeated rows score alike and an empty
    table gives an empty one.
    """
    docs, renamed = set_aside(docs, "tox_score", "tox_hits", "toxic")
    text = renamed.get(text, text)
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField("tox_score", T.DoubleType()), T.StructField("tox_hits", T.IntegerType()), T.StructField("toxic", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for b in batches:
            got = [score_text(a, t.as_py() or "") for t in b.column(at)]
            s = [round(x[0], 6) for x in got]
            cols = [*b.columns, pa.array(s, pa.float64()), pa.array([x[1] for x in got], pa.int32()), pa.array([x >= threshold for x in s], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    return docs.transform(batched).mapInArrow(run, schema)


def clean(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`score` doesn't call toxic, with the columns
    of ``docs`` as they are, whatever their names."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lexicon.automaton()
        for b in batches:
            yield b.filter(pa.array([round(score_text(a, t.as_py() or "")[0], 6) < threshold for t in b.column(at)], pa.bool_()))

    return docs.transform(batched).mapInArrow(run, docs.schema)


def _stems(text: str) -> tuple[Counter, int]:
    """The stems of a text's words, as often as they stand there, and the number
    of words."""
    split = fold(text).split()
    out = Counter(w[:k] for w in split for k in range(4, 9) if len(w) >= k)
    out.update(w[:k] for w in accented(text) for k in range(3, 9) if len(w) >= k and not w[:k].isascii())
    return out, len(split)


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, path: str = LEXICON, max_rows: int = MAX_LABELLED_ROWS, min_share: float = 0.02, min_docs: int = 8, ratio: float = 6.0, evidence: float = 26.0, text: str = "text") -> Lexicon:
    """The lexicon of the file ``path`` joined by stems learned from labelled
    documents.

    The sample is the ``max_rows`` labels that come first by a hash of their
    ``doc_id``; labels with a NULL in ``doc_id`` or ``toxic`` are left out.  A
    stem of 4 to 8 letters (3 with an accent) is learned when at least
    ``min_share`` of the toxic documents and ``min_docs`` have it, toxic documents
    use it ``ratio`` times as often as others, and the log-likelihood ratio of the
    documents' numbers is at least ``evidence``.  Of stems that begin alike the
    shortest is taken.  A learned stem weighs in proportion to the logarithm of that
    ratio, by the scale that serves the sample best, a clean document rejected
    counting as two toxic ones missed.  Without labels, or where nothing is learned,
    the file's lexicon is returned.
    """
    picked = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id").select("toxic", "text")
    sample = written(spark, sample, "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {"": [0] * 4}
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                stems, n = _stems(t)
                stems[""] = n
                for w, k in stems.items():
                    x = found.setdefault(w, [0] * 4)
                    x[y <= 0] += 1
                    x[2 + (y <= 0)] += k
        yield pa.RecordBatch.from_arrays([pa.array(list(found)), *(pa.array([x[i] for x in found.values()], pa.int64()) for i in range(4))], ["term", "toxic", "clean", "toxic_words", "clean_words"])

    base = load(path)
    counted = sample.transform(batched).mapInArrow(count, "term string, toxic long, clean long, toxic_words long, clean_words long").groupBy("term").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "toxic_words", "clean_words")))
    found = {r["term"]: tuple(r)[1:] for r in counted.where(f"term = '' or (toxic >= {int(min_docs)} and clean <= toxic * 50)").collect()}
    n_toxic, n_clean, toxic_words, clean_words = found.pop("", (0, 0, 0, 0))
    if not n_toxic or not n_clean:
        return base
    taken: set[str] = set()
    for term, (toxic, clean, k, m) in sorted(found.items()):
        if toxic < max(min_docs, min_share * n_toxic) or k / (toxic_words + 1) < ratio * (m + 1) / (clean_words + 1):
            continue
        expected = (toxic + clean) * n_toxic / (n_toxic + n_clean)
        if 2 * (toxic * math.log(toxic / expected) - (toxic - expected)) < evidence or toxic < expected:
            continue
        if not any(term[:i] in taken for i in range(3, len(term))) and not any(fold(w).startswith(fold(term)) for w in base.words):
            taken.add(term)
    # where a stem with and one without the accents are of the same words, one counts
    taken = {t for t in taken if t.isascii() or not any(fold(t).startswith(u) or u.startswith(fold(t)) and found[u][2] >= 0.8 * found[t][2] for u in taken if u.isascii())}
    if not taken:
        return base
    odds = {t: math.log((found[t][2] + 0.5) / (toxic_words + 1) * (clean_words + 1) / (found[t][3] + 0.5)) for t in taken}
    usual = sorted(odds.values())[len(odds) // 2]
    share = {t: x / usual for t, x in odds.items()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, learned = base.automaton(), Lexicon({}, share, base.exceptions).automaton()
        for b in batches:
            got = [(score_text(plain, t)[0], score_text(learned, t)[0]) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.float64()), pa.array([x for _, x in got], pa.float64())], ["toxic", "base", "learned"])

    rows = sample.transform(batched).mapInArrow(measure, "toxic int, base double, learned double").collect()  # as many as max_rows

    def worth(cut: float) -> tuple[float, float]:
        rejected = [r["toxic"] > 0 for r in rows if r["base"] + r["learned"] * THRESHOLD / cut >= THRESHOLD]
        return sum(rejected) - 2.0 * (len(rejected) - sum(rejected)), cut

    cut = max(worth(i / 20) for i in range(4, 81))[1]
    return Lexicon(base.words, base.stems | {t: round(share[t] * THRESHOLD / cut, 4) for t in sorted(taken)}, base.exceptions)


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Lexicon:
    """The lexicon for the tables in ``sf_dir``."""
    return learn(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
