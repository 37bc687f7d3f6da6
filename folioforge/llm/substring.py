"""Substring deduplication by hashing lines, paragraphs and their sentences.

A text is cut into units: at line ends, after ``.``, ``!`` or ``?`` before white
space, and before a capital that follows white space.  A passage that was pasted
into a line is thus cut out of it as well.  Units are normalised (case, white
space and punctuation), their digests grouped over the whole corpus, and every
occurrence but the earliest, ranked by (doc_id, text digest, position), is a
repeat.  Runs of repeats of at least ``min_words`` words are removed: a lone short
sentence may recur by chance, a run doesn't.  The offsets of what is removed are
those of the original text, in characters.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan
from .common import attach, batched, free_names, row_key, set_aside, written

#: The least number of words of a run of repeats that is removed.
MIN_WORDS = 20
#: Units that a task holds to find repeats among before it sends them.
HELD_UNITS = 750_000

_CUT = re.compile(r"\n|[.!?][^\S\n]+(?=\S)|[^\S\n]+(?=[A-ZÀ-ÖØ-ÞΑ-ΩЀ-Я])")
_WORDS = re.compile(r"\w+")
_HAS_WORD = re.compile(r"\w")


def units(text: str) -> list[tuple[int, int]]:
    """(begin, end) of the units that hold a word.  A unit reaches to the begin
    of the next, so wordless text belongs to the unit before it."""
    cuts = [0, *(m.end() for m in _CUT.finditer(text)), len(text)]
    begins = [a for a, b in zip(cuts, cuts[1:]) if a < b and _HAS_WORD.search(text, a, b)]
    return list(zip(begins, [*begins[1:], len(text)]))


def normalise(unit: str) -> list[str]:
    """The lower-cased words."""
    return _WORDS.findall(unit.lower())


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for the first occurrence of each unit in the partition, with its
    digest, and a row already known to be a repeat for each later one.  A repeat
    needs no partner any more, so it gets a digest of its own: a line that half
    of the corpus has is sent once by each partition, not once by each document.
    """
    held = _Held()
    for b in batches:
        for doc, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            t = text.as_py()
            for i, (lo, hi) in enumerate(units(t)):
                w = normalise(t[lo:hi])
                held.add(doc, key, i, len(w), xxhash.xxh3_128_digest(" ".join(w)))
            if len(held.unit) > HELD_UNITS:
                yield from _first_here(held)
                held = _Held()
    if held.unit:
        yield from _first_here(held)


class _Held:
    """Units side by side in typed arrays, 40 bytes each."""

    def __init__(self) -> None:
        self.doc, self.key, self.unit, self.words, self.digests = array("q"), array("q"), array("i"), array("i"), bytearray()

    def add(self, doc: int, key: int, unit: int, words: int, digest: bytes) -> None:
        self.doc.append(doc)
        self.key.append(key)
        self.unit.append(unit)
        self.words.append(words)
        self.digests += digest


def _first_here(held: _Held) -> Iterator[pa.RecordBatch]:
    doc, key, unit, words = (np.array(x) for x in (held.doc, held.key, held.unit, held.words))
    h = np.frombuffer(held.digests, np.int64).reshape(-1, 2).copy()
    order = np.lexsort((unit, key, doc, h[:, 1], h[:, 0]))
    equal = lambda *cols: np.r_[False, np.logical_and.reduce([c[order[1:]] == c[order[:-1]] for c in cols])]
    order = order[~equal(h[:, 0], h[:, 1], doc, key, unit)]  # a repeated row's units are the same units
    doc, key, unit, words, h = (x[order] for x in (doc, key, unit, words, h))
    again = np.r_[False, (h[1:] == h[:-1]).all(1)]
    h[again, 0] = doc[again] * 1_000_003 + unit[again]
    h[again, 1] = key[again]
    cols = [h[:, 0], h[:, 1], doc, key, unit, words, again]
    for i in range(0, len(doc), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 100_000]) for c in cols], ["h1", "h2", "doc_id", "key", "unit", "words", "again"])


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """(doc_id, key, runs array<struct<first, last>>): the runs of repeated units,
    by unit number, of the documents that have any.

    Rows that repeat ``doc_id`` and text are one document and don't repeat each
    other.  NULL and empty texts have no units; rows with a NULL ``doc_id``
    can't be ranked and take no part.
    """
    made = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), row_key(text).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = made.transform(batched).mapInArrow(_digest, "h1 long, h2 long, doc_id long, key long, unit int, words int, again boolean")
    order = Window.partitionBy("h1", "h2").orderBy("doc_id", "key", "unit")
    first = F.first(F.struct("doc_id", "key", "unit")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    again = found.withColumn("first", first).where(F.col("again") | (F.col("first") != F.struct("doc_id", "key", "unit"))).select("doc_id", "key", "unit", "words").distinct()
    by_doc = Window.partitionBy("doc_id", "key")
    island = again.withColumn("island", F.col("unit") - F.row_number().over(by_doc.orderBy("unit")))
    runs = island.groupBy("doc_id", "key", "island").agg(F.min("unit").alias("first"), F.max("unit").alias("last"), F.sum("words").alias("words")).where(F.col("words") >= min_words)
    return runs.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", offsets: bool = True) -> DataFrame:
    """``docs`` with repeats cut out of ``text`` and ``removed``
    array<struct<begin, end>>: the half-open spans, in characters of the original
    text, that were cut (empty where nothing was).

    Every row stays, a NULL text as NULL; what is left of a document that
    consists of repeats is ''.  Rows that repeat ``doc_id`` (an integer) and text
    are cut alike.  Very long texts are cut whole; an empty table gives an empty
    one.  A column of the input named ``removed`` gets the prefix ``input_``;
    without ``offsets`` no column is made and none renamed.
    """
    if offsets:
        docs, renamed = set_aside(docs, "removed")
        text = renamed.get(text, text)
    k, r = free_names(docs, "row_key", "runs")
    runs = written(spark, repeats(docs, min_words, text), "repeats").withColumnsRenamed({"key": k, "runs": r})
    joined = attach(docs.withColumn(k, row_key(text)), runs, ["doc_id", k], "left", 120).select(*docs.columns, r)
    span = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([*docs.schema.fields, *[T.StructField("removed", T.ArrayType(span))][: int(offsets)]])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            for first, part in textscan.slices(b.column(at)):
                rows = b.slice(first, len(part))
                texts, spans = rows.column(at), [[] for _ in range(len(rows))]
                found = rows.column(rows.num_columns - 1)
                if found.null_count < len(found):
                    kept = texts.to_pylist()
                    for i, cuts in enumerate(found.to_pylist()):
                        if cuts is not None:
                            t, u = kept[i], units(kept[i])
                            spans[i] = [{"begin": u[x["first"]][0], "end": u[x["last"]][1]} for x in cuts]
                            ends = [0, *(x["end"] for x in spans[i])]
                            kept[i] = "".join(t[a:z] for a, z in zip(ends, [*(x["begin"] for x in spans[i]), len(t)]))
                    texts = pa.array(kept, texts.type)
                cols = list(rows.columns[:-1])
                cols[at] = texts
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array(spans, kind)][: int(offsets)]], schema.names)

    return joined.transform(batched).mapInArrow(run, schema)


#: The same in DuckDB's SQL.  Cuts are marked with a character that no text has;
#: cuts more than the above only make wordless units, which are skipped.
SQL = r"""
WITH marked AS (
  SELECT doc_id, text, string_split(regexp_replace(regexp_replace(text, '(\n|[.!?][ \t\r\f\v]+)', '\1' || chr(1), 'g'), '([ \t\r\f\v])([A-ZÀ-ÖØ-ÞΑ-ΩЀ-Я])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts FROM documents),
exploded AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS nr FROM marked),
placed AS (SELECT doc_id, part, nr, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY nr) - length(part) AS begin_at, regexp_extract_all(lower(part), '[\p{L}\p{N}_]+') AS w FROM exploded),
worded AS (SELECT p.doc_id, p.begin_at, len(p.w) AS words, array_to_string(p.w, ' ') AS norm, row_number() OVER (PARTITION BY p.doc_id ORDER BY p.nr) AS unit,
  coalesce(lead(p.begin_at) OVER (PARTITION BY p.doc_id ORDER BY p.nr), length(d.text)) AS end_at
  FROM placed p JOIN documents d USING (doc_id) WHERE len(p.w) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, unit) AS occurrence FROM worded),
again AS (SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS island FROM ranked WHERE occurrence > 1),
runs AS (SELECT doc_id, min(begin_at) AS b, max(end_at) AS e FROM again GROUP BY doc_id, island HAVING sum(words) >= 20),
spans AS (SELECT doc_id, list(CAST(b AS INT) ORDER BY b) AS bs, list(CAST(e AS INT) ORDER BY b) AS es FROM runs GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN s.bs IS NULL THEN d.text ELSE array_to_string([d.text[z[1] + 1 : z[2]] FOR z IN list_zip(list_concat([0], s.es), list_concat(s.bs, [length(d.text)]))], '') END AS text, 
  CASE WHEN s.bs IS NULL THEN '' ELSE array_to_string([CAST(z[1] AS VARCHAR) || '-' || CAST(z[2] AS VARCHAR) FOR z IN list_zip(s.bs, s.es)], ' ') END AS removed
FROM documents d LEFT JOIN spans s USING (doc_id)
"""
