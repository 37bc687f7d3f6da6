"""Operators on candidate sets: keep-first distinct, selection against candidates,
argmax, near-duplicate containment, budgets and chunks.  Rows carry a position
wherever their order means something."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.udf import batched, pandas_udf


def keep_first(df: DataFrame, by: list[str], key: Column, pos: str = "pos") -> DataFrame:
    """Of the rows of a group with an equal key, the first; none for a blank key."""
    rank = F.row_number().over(Window.partitionBy(*by, "_key").orderBy(pos))
    return df.withColumn("_key", key).where("_key != ''").withColumn("_rank", rank).where("_rank = 1").drop("_key", "_rank")


def keep_first_values(values: Column, key: Callable[[Column], Column] = T.support_key) -> Column:
    """The same for an array: values trimmed, blanks dropped, in order."""
    trimmed = F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), T.strip), lambda v: key(v) != "")
    return F.aggregate(trimmed, F.array().cast("array<string>"), lambda kept, v: F.when(F.exists(kept, lambda k: key(k) == key(v)), kept).otherwise(F.array_append(kept, v)))


def union_distinct(*arrays: Column) -> Column:
    """Ordered union, the first spelling of each key."""
    return keep_first_values(F.concat(*(F.coalesce(a, F.array().cast("array<string>")) for a in arrays)))


def select_from(selected: DataFrame, candidates: DataFrame, by: list[str], value: str = "value", pos: str = "pos") -> DataFrame:
    """The candidates that a selection names, by key: the candidate's spelling, in
    the selection's order, once each."""
    c = keep_first(candidates, by, T.support_key(F.col(value)), pos).select(*by, F.trim(value).alias("_candidate"), T.support_key(F.col(value)).alias("_k"))
    s = keep_first(selected, by, T.support_key(F.col(value)), pos).withColumn("_k", T.support_key(F.col(value)))
    return s.join(c, [*by, "_k"]).select(*by, pos, F.col("_candidate").alias(value))


def select_values(selected: Column, candidates: Column) -> Column:
    """The same for arrays."""
    keyed = F.transform(keep_first_values(candidates), lambda c: F.struct(T.support_key(c).alias("k"), c.alias("c")))

    def pick(s: Column, known: Column) -> Column:
        return T.let(T.support_key(s), lambda k: F.get(F.filter(known, lambda x: x["k"] == k), F.lit(0))["c"])

    return T.let(keyed, lambda known: F.filter(F.transform(keep_first_values(selected), lambda s: pick(s, known)), lambda v: v.isNotNull()))


def argmax(df: DataFrame, by: list[str], score: str, pos: str = "pos") -> DataFrame:
    """The row of the highest score in each group, the first in a tie; NULL and NaN
    scores take no part."""
    rest = [c for c in df.columns if c not in by]
    best = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))).groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(score, -F.col(pos))).alias("_b"))
    return best.select(*by, *(F.col(f"_b.{c}").alias(c) for c in rest))


#: Keys of a group up to which all are compared, as an index takes longer.
FEW_KEYS = 32


def _not_contained(rows: list[tuple[str, str, object]], ratio: float) -> list[int]:
    """Of rows (key, distinct words joined, position), the indices of the first of each key
    that isn't inside another or contained in one with more words.

    Where a key stands, its inner words stand as words; and a row that shares the
    ratio of words has one of the rarest.  So only rows that have such a word are
    looked at.
    """
    own: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        if r[0]:
            own.setdefault(r[0], []).append(i)
    keys = list(own)
    sets = [frozenset(rows[own[k][0]][1].split()) for k in keys]
    few, all_keys = len(keys) <= FEW_KEYS, range(len(keys))
    by_part: dict[str, list[int]] = {}
    by_word: dict[str, list[int]] = {}
    if not few:
        for n, (k, w) in enumerate(zip(keys, sets)):
            for x in set(k.split(" ")):
                by_part.setdefault(x, []).append(n)
            for x in w:
                by_word.setdefault(x, []).append(n)
    every, starts, at = "\n".join(keys), [], 0
    for k in keys:
        starts.append(at)
        at += len(k) + 1

    def inside(n: int) -> bool:
        k = keys[n]
        inner = () if few else k.split(" ")[1:-1]
        if not inner:
            return every.find(k) != starts[n] or every.find(k, starts[n] + 1) >= 0
        rarest = min((by_part[x] for x in inner), key=len)
        return any(m != n and k in keys[m] for m in rarest)

    def places(n: int) -> set:
        """The positions of rows that contain it; two are as good as all."""
        w, found, seen = sets[n], set(), set()
        lost = next((m for m in range(len(w)) if (len(w) - m) / len(w) < ratio), len(w))  # of so many words a row has one
        for some in [by_word[x] for x in sorted(w, key=lambda x: len(by_word[x]))[:lost]] if not few else [all_keys] if w else []:
            for m in some:
                if m != n and m not in seen and len(sets[m]) > len(w):
                    seen.add(m)
                    if len(w & sets[m]) / len(w) >= ratio:
                        found.update(rows[i][2] for i in own[keys[m]])
                        if len(found) > 1:
                            return found
        return found

    kept = []
    for n, k in enumerate(keys):
        if not inside(n):
            there = places(n)
            left = own[k] if not there else [i for i in own[k] if {rows[i][2]} == there]
            if left:
                kept.append(min(left, key=lambda i: rows[i][2]))
    return kept


def without_contained(df: DataFrame, by: list[str], text: str = "text", pos: str = "pos", ratio: float = 0.9) -> DataFrame:
    """Of each group, the texts that aren't repeated, inside another or (by
    ``ratio`` of their distinct words) contained in one with more words.  Groups are
    sorted and streamed, so a group's size bounds what a task holds."""
    names = df.columns
    key = F.lower(T.norm_ws(F.col(text)))
    base = df.repartition(*by).sortWithinPartitions(*by).withColumn("_key", key).withColumn("_tokens", F.array_join(F.array_distinct(T.support_tokens(F.col("_key"))), " "))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, np.ndarray]] = []  # with what stays of each
        group: list[tuple[np.ndarray, int]] = []  # where the open group's rows stand
        rows: list[tuple[str, str, object]] = []
        now = None

        def close() -> None:
            alone = now is not None and None in now  # an unknown group's rows aren't compared
            for i in _first_of_each(rows) if alone else _not_contained(rows, ratio):
                mask, j = group[i]
                mask[j] = True

        for b in batches:
            mask = np.zeros(b.num_rows, bool)
            fields = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("_key", "_tokens", pos)]
            for j, (of, row) in enumerate(zip(zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in by)), zip(*fields))):
                if of != now:
                    close()
                    group, rows, now = [], [], of
                group.append((mask, j))
                rows.append(row)
            held.append((b.select(names), mask))
            if group and group[0][0] is mask:  # the open group began here: what is before is done
                for piece, keep in held[:-1]:
                    yield piece.filter(pa.array(keep))
                held = held[-1:]
        close()
        for piece, keep in held:
            yield piece.filter(pa.array(keep))

    return batched(base).mapInArrow(run, df.schema)


def _first_of_each(rows: list[tuple[str, str, object]]) -> list[int]:
    first: dict[str, int] = {}
    for i, (k, _, p) in enumerate(rows):
        if k and (k not in first or p < rows[first[k]][2]):
            first[k] = i
    return list(first.values())


def within_budget(df: DataFrame, by: list[str], size: Column, most: int, pos: str = "pos") -> DataFrame:
    """The rows of each group before the first that would exceed the budget."""
    running = F.sum("_size").over(Window.partitionBy(*by).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("_size", size).withColumn("_sum", running).where(F.col("_sum") <= most).drop("_size", "_sum")


def chunks(df: DataFrame, by: list[str], size: int = 50, pos: str = "pos", text: str = "text") -> DataFrame:
    """(by, chunk, n, text): numbered entries, joined ``size`` at a time."""
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(pos))
    entry = F.concat(F.lit("["), F.col("_rn"), F.lit("] "), F.col(text))
    numbered = df.withColumn("_rn", rn).withColumn("chunk", F.floor((F.col("_rn") - 1) / size).cast("int")).withColumn("_e", F.struct("_rn", entry.alias("e")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("_e")), lambda e: e["e"]), "\n")
    return numbered.groupBy(*by, "chunk").agg(F.count("*").alias("n"), joined.alias("text"))


def numbered_blocks(blocks: Column, most_each: int = 1200, most: int = 8000) -> Column:
    """Candidate blocks (array<struct<source, text>>) as one prompt text, up to the
    first that doesn't fit."""
    chunk = lambda b, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] source="), b["source"], F.lit("\n"), F.substring(b["text"], 1, most_each), F.lit("\n"))
    parts = F.transform(blocks, chunk)
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("total"), F.lit(False).alias("full"))

    def step(a: Column, p: Column) -> Column:
        full = a["full"] | (a["total"] + F.length(p) > most)
        return F.struct(F.when(full, a["kept"]).otherwise(F.array_append(a["kept"], p)).alias("kept"), F.when(full, a["total"]).otherwise(a["total"] + F.length(p)).alias("total"), full.alias("full"))

    return F.aggregate(parts, start, step, lambda a: F.array_join(a["kept"], "\n"))


def supported(candidate: Column, source: Column) -> Column:
    """Whether a source supports a text literally: it contains it, or of 20 words or
    more nine tenths occur in it.  (:func:`supported_by` adds similarity.)"""

    def overlaps(x: Column) -> Column:
        known = F.filter(x["t"], lambda t: F.array_contains(x["there"], t))
        return (F.size(x["t"]) >= 20) & (F.size(x["there"]) > 0) & (F.size(known) / F.greatest(F.size(x["t"]), F.lit(1)) >= 0.9)

    def of(k: Column) -> Column:
        words = F.struct(T.support_tokens(k["c"]).alias("t"), F.array_distinct(T.support_tokens(k["s"])).alias("there"))
        return F.when((k["c"] == "") | (k["s"] == ""), F.lit(False)).when(F.contains(k["s"], k["c"]), F.lit(True)).otherwise(T.let(words, overlaps))

    return T.let(F.struct(T.support_key(candidate).alias("c"), T.support_key(source).alias("s")), of)


#: Words of a passage that are looked up.
GRAM = 5


def _runs(w: Column, m: int) -> Column:
    """The digests of all runs of ``m`` words."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - m + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(m)))))


def holding(sources: DataFrame, passages: DataFrame, source: str, passage: str, text: str = "text", wanted: str = "passage") -> DataFrame:
    """(passage, source): which sources hold which passages literally, by their keys.

    Where a passage stands, its inner words stand as words: so a passage is looked
    up by its second to sixth word (of shorter ones, by all inner words) among the
    runs of words of the sources, and what is found is verified.  Passages of one
    or two words have no inner word; they are compared with each source.  Blank
    passages are in none.
    """
    p = passages.select(F.col(passage), T.support_key(F.col(wanted)).alias("_c")).where("_c != ''").withColumn("_w", F.split("_c", " "))
    p = p.withColumn("_m", F.least(F.size("_w") - 2, F.lit(GRAM)))
    sizes = sorted(r[0] for r in p.select("_m").distinct().collect())  # as many as GRAM and one
    s = sources.select(F.col(source), T.support_key(F.col(text)).alias("_k"))
    found = []
    for m in sizes:
        if m <= 0:
            found.append(s.join(p.where("_m <= 0").select(passage, "_c"), F.contains("_k", "_c")).select(passage, source))
            continue
        asked = p.where(F.col("_m") == m).select(passage, "_c", F.xxhash64(F.slice("_w", 2, m)).alias("_h"))
        have = s.select(source, T.let(F.split("_k", " "), lambda w: F.when(F.size(w) >= m, _runs(w, m))).alias("_r"))  # noqa: B023
        near = have.select(source, F.explode("_r").alias("_h")).join(asked.select(passage, "_h"), "_h").select(passage, source)
        sure = near.join(asked.select(passage, "_c"), passage).join(s, source).where(F.contains("_k", "_c"))
        found.append(sure.select(passage, source).distinct())
    if not found:
        return p.join(s, F.lit(False)).select(passage, source)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


@pandas_udf("boolean")
def _similar(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    return pd.Series([len(x) >= 80 and len(y) > 0 and SequenceMatcher(None, x, y).ratio() >= z for x, y, z in zip(a, b, least)])


def supported_by(candidate: Column, source: Column, least: float = 0.92) -> Column:
    """:func:`supported`, or of 80 characters or more and about equal.  The similarity
    is asked only where it can decide: of texts that aren't supported literally and
    whose lengths allow for it."""
    c, s, literal = T.support_key(candidate), T.support_key(source), supported(candidate, source)
    longest = 2.0 * F.least(F.length(c), F.length(s)) / F.greatest(F.length(c) + F.length(s), F.lit(1))
    asked = ~literal & (F.length(c) >= 80) & (longest >= least)
    return literal | _similar(F.when(asked, c).otherwise(""), F.when(asked, s).otherwise(""), F.lit(least))


@pandas_udf("array<string>")
def block_tokens(text: pd.Series) -> pd.Series:
    """The distinct words of a text after compatibility decomposition, in lower case,
    but for numbers (which line numbers of a layout leave in it)."""
    return pd.Series([sorted({w for w in re.findall(r"\w+", unicodedata.normalize("NFKD", t or "").lower()) if not w.isdigit()}) for t in text])


def near_marker(text: Column, most: int = 5000, before: int = 200, marker: str = r"(?iuU)\b(?:abstract|resumen|resumo)\b") -> Column:
    """``most`` characters of a text, from a little before its first abstract marker;
    without one, its begin."""
    x = T.text_of(text)
    return T.let(F.regexp_instr(x, F.lit(marker)), lambda at: F.substr(x, F.greatest(at - before, F.lit(1)), F.lit(most)))


def best_abstract(candidates: Column, preferred: Column) -> Column:
    """The candidate abstract of the highest score: of those that aren't statements,
    that are long enough where any is long, that are of one language where any such
    is long, and of the preferred language where any is; each of these rules holds
    only if it leaves something.  '' without a candidate."""
    none = F.array().cast("array<string>")
    kept = F.filter(F.coalesce(candidates, none), lambda c: T.strip(c) != "")
    judged = F.transform(kept, lambda c: T.let(T.language_hits(c), lambda h: F.struct(c.alias("t"), T.word_count(c).alias("n"), T.is_boilerplate(c).alias("b"), T.mixed(h).alias("m"), T.detected(h).alias("l"), T.score_abstract(c).alias("s"))))

    def narrowed(rows: Column, rule: Callable[[Column], Column], needed: Callable[[Column], Column]) -> Column:
        return T.let(rows, lambda r: F.when(F.exists(r, lambda x: needed(x)), F.filter(r, lambda x: rule(x))).otherwise(r))

    rows = narrowed(judged, lambda x: ~x["b"], lambda x: ~x["b"])
    rows = narrowed(rows, lambda x: x["n"] >= 15, lambda x: x["n"] >= 30)
    rows = narrowed(rows, lambda x: ~x["m"], lambda x: ~x["m"] & (x["n"] >= 30))
    wanted = lambda x: (preferred != "unknown") & (preferred != "") & (x["l"] == preferred)
    rows = narrowed(rows, wanted, wanted)
    start = F.struct(F.lit("").alias("t"), F.lit(float("-inf")).alias("s"))
    return F.aggregate(rows, start, lambda a, x: F.when((x["s"] > a["s"]) | (a["t"] == ""), F.struct(x["t"].alias("t"), x["s"].alias("s"))).otherwise(a))["t"]


def abstract_blocks(windows: DataFrame, abstracts: DataFrame) -> DataFrame:
    """(record_id, pos, text): the parser's abstracts (record_id, pos, text), then the
    windows (record_id, block, text) after abstract headings; statements and what
    another one contains are dropped."""
    own = abstracts.select("record_id", "pos", "text")
    every = own.unionByName(windows.select("record_id", (F.col("block") + 1_000_000).alias("pos"), "text"))
    return without_contained(every.where(~T.is_boilerplate(F.col("text"))), ["record_id"]).select("record_id", "pos", "text")


def with_preprint_identifiers(record_id: Column, identifiers: Column) -> Column:
    """Identifiers but for authors' ones, and those that follow from the record's
    id; distinct."""
    own = F.filter(F.coalesce(identifiers, F.array().cast("array<string>")), lambda v: (T.text_of(v) != "") & ~T.is_orcid(v))
    return F.array_distinct(F.concat(own, T.preprint_identifiers(record_id)))


def coalesced(records: list[str], scalars: list[str], lists: list[str]) -> dict[str, Column]:
    """Each field of the first of the struct columns that has it filled."""
    none = F.array().cast("array<string>")
    out = {k: F.coalesce(*(F.nullif(T.strip(F.col(f"{r}.{k}")), F.lit("")) for r in records), F.lit("")) for k in scalars}
    filled = lambda c: F.when(F.size(T.safe_list(c)) > 0, T.safe_list(c))
    return out | {k: F.coalesce(*(filled(F.col(f"{r}.{k}")) for r in records), none) for k in lists}


def target_languages(keywords: Column, available: Column) -> Column:
    """The languages to translate keywords to: English from Portuguese and Spanish;
    from English, those that the article has marks of; else all of these."""
    of = T.detect_language(F.array_join(keywords, " "))
    here = F.coalesce(available, F.array().cast("array<string>"))
    from_en = F.filter(F.array(F.lit("es"), F.lit("pt")), lambda k: F.array_contains(here, k))
    rest = F.array_sort(F.array_distinct(F.filter(here, lambda k: k != "unknown")))
    chosen = T.let(of, lambda k: F.when(k.isin("pt", "es"), F.array(F.lit("en"))).when(k == "en", from_en).otherwise(rest))
    return F.when(F.size(F.coalesce(keywords, F.array().cast("array<string>"))) > 0, chosen).otherwise(F.array().cast("array<string>"))


def closest(names: DataFrame, wanted: DataFrame, n: int = 5, least: float = 0.4) -> DataFrame:
    """(wanted, name, score): the most similar names (name) of each that is wanted
    (wanted), a few of either: model lists."""
    pairs = wanted.select("wanted").join(names.select("name"), F.levenshtein("wanted", "name") <= F.greatest(F.length("wanted"), F.length("name")) * (1 - least))
    scored = pairs.withColumn("score", T.edit_sim(F.col("wanted"), F.col("name"))).where(F.col("score") >= least)
    rank = F.row_number().over(Window.partitionBy("wanted").orderBy(F.desc("score"), "name"))
    return scored.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def resolved(wanted: DataFrame, names: DataFrame) -> DataFrame:
    """(wanted, name): the name that equals the one wanted, or else the first that
    does when case and punctuation are left out; NULL without either."""
    own = names.select("name", T.canonical_model(F.col("name")).alias("k"), T.canonical_model(F.substring_index("name", "/", -1)).alias("last"))
    keyed = wanted.select("wanted", T.canonical_model(F.col("wanted")).alias("k"), T.canonical_model(F.substring_index("wanted", "/", -1)).alias("last"))
    exact = keyed.join(own.select("name", F.lit(0).alias("rank")), F.col("wanted") == F.col("name")).select("wanted", "name", "rank")
    same = keyed.join(own, "k").select("wanted", "name", F.lit(1).alias("rank"))
    tail = keyed.drop("k").join(own.drop("k"), "last").select("wanted", "name", F.lit(2).alias("rank"))
    best = exact.unionByName(same).unionByName(tail).groupBy("wanted").agg(F.min_by("name", F.struct("rank", "name")).alias("name"))
    return wanted.select("wanted").join(best, "wanted", "left")


def first_nonempty(*values: Column) -> Column:
    """The first text that isn't '' or array that isn't empty."""
    out = values[-1]
    for v in reversed(values[:-1]):
        out = F.when(v.isNotNull() & (v != F.lit("")), v).otherwise(out)
    return out


def normalize_identifiers(values: Column) -> Column:
    """DOIs taken out of what surrounds them; distinct."""
    def one(v: Column) -> Column:
        d = F.regexp_extract(v, f"({T.DOI})", 1)
        return F.when(d != "", F.regexp_replace(d, r"[.,;:\]}]+$", "")).otherwise(v)

    return keep_first_values(F.transform(T.safe_list(values), one))


def without_own(references: Column, identifiers: Column) -> Column:
    """References but for the article's own DOIs (identifiers with a slash)."""
    own = F.filter(F.transform(F.coalesce(identifiers, F.array().cast("array<string>")), T.normalize_identifier), lambda v: F.contains(v, F.lit("/")))
    return T.let(own, lambda mine: F.filter(references, lambda r: ~F.array_contains(mine, T.normalize_identifier(r))))


def without_lone_deposits(dois: Column) -> Column:
    """Deposit DOIs only stay beside another citation."""
    standard = F.exists(dois, lambda d: T.is_citation_doi(d) & ~T.is_deposit_doi(d))
    return F.when(standard, dois).otherwise(F.filter(dois, lambda d: ~T.is_deposit_doi(d)))


def keyword_values(values: Column) -> Column:
    """Keywords: labels stripped or taken as separators, statements cut off, lists
    split, placeholders dropped; distinct."""
    edge = "^[ ;.:-]+|[ ;.:-]+$"
    marker = r"(?:descriptors?|descritores?|palabras\s+clave|palavras[-\s]+chave|key-?words?)"
    unlabelled = F.transform(T.safe_list(values), lambda v: F.regexp_replace(F.regexp_replace(v, rf"(?iuU)^\s*{marker}\s*[:.]?\s+", ""), edge, ""))
    parts = F.flatten(F.transform(unlabelled, lambda v: F.filter(F.transform(F.split(v, rf"(?iuU)\s+{marker}\s*[:.]?\s+"), lambda p: F.regexp_replace(p, edge, "")), lambda p: p != "")))

    def cut(p: Column) -> Column:
        at = F.regexp_instr(p, F.lit(T.SUSPECT_KEYWORD))
        return F.when(at == 0, p).when(at <= 50, "").otherwise(F.regexp_replace(F.substr(p, F.lit(1), at - 1), edge, ""))

    clean = F.filter(F.transform(parts, cut), lambda p: p != "")
    many = lambda p: (F.regexp_count(p, F.lit("[,;]")) >= 3) | (F.regexp_count(p, F.lit(";")) >= 2)
    split = F.flatten(F.transform(clean, lambda p: F.when(many(p), F.filter(F.transform(F.split(p, r"\s*[;,]\s*"), lambda x: F.regexp_replace(x, edge, "")), lambda x: x != "")).otherwise(F.array(p))))
    return keep_first_values(F.filter(split, lambda v: ~T.support_key(v).isin("n/a", "none", "not applicable")))


def merge_content(ours: Column, theirs: Column) -> Column:
    """One list, or where it is empty the other."""
    return F.when(F.size(F.coalesce(ours, F.array().cast("array<string>"))) > 0, ours).otherwise(theirs)


def similar_sets(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(q, c, score): the sets (q) of ``a`` and (c) of ``b``, distinct arrays, of a
    Jaccard similarity of at least so much.

    Two such sets share one of the rarest words of each: of the words beyond those,
    both have too few.  So only these are joined, and of what is found lengths and
    places drop most before it is compared.
    """
    often = b.select(F.explode("c").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    at_least = lambda n: F.ceil(n * least - 1e-9)

    def rarest(side: DataFrame, name: str) -> DataFrame:
        own = side.select(name, F.explode(name).alias("t")).join(often, "t", "left").select(name, F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t").alias("s"))
        kept = F.slice(F.array_sort(F.collect_list("s")), F.lit(1), (F.size(name) - at_least(F.size(name)) + 1).cast("int"))
        return own.groupBy(name).agg(kept.alias("k")).select(name, F.posexplode("k").alias(f"{name}_at", "k")).select(name, F.size(name).alias(f"{name}_n"), f"{name}_at", "k.t")

    both, q, c = rarest(a, "q").join(rarest(b, "c"), "t"), F.col("q_n"), F.col("c_n")
    fits = (c >= at_least(q)) & (q >= at_least(c)) & (1 + F.least(q - F.col("q_at") - 1, c - F.col("c_at") - 1) >= F.ceil((q + c) * (least / (1 + least)) - 1e-9))
    near, shared = both.where(fits).select("q", "c").distinct(), F.size(F.array_intersect("q", "c"))
    return near.withColumn("score", T.let(shared, lambda m: m / (F.size("q") + F.size("c") - m))).where(F.col("score") >= least)


def lookup(queries: DataFrame, catalogue: DataFrame, least: float = 0.5, rows: int = 5, query: str = "title", entry: str = "title") -> DataFrame:
    """Each query's best catalogue entry by Jaccard similarity of title words (of
    at least ``least``), of years that differ by one at most where both are known;
    only ``rows`` best are ranked by year.

    Equal sets of words are found first, then those that are half as far off as
    ``least`` allows, then the rest; a query that one step settles doesn't go to the
    next.  None is missed: what a step leaves out ranks behind all that it finds.
    ``queries``: (query_id, title, year); ``catalogue``: (entry_id, title, year).
    """
    sets = lambda x: F.array_sort(T.token_set(F.col(x)))
    asked = queries.select("query_id", F.col("year").alias("q_year"), sets(query).alias("q")).where(F.size("q") > 0)
    c = catalogue.select("entry_id", F.col("year").alias("c_year"), sets(entry).alias("c")).where(F.size("c") > 0)
    c = c.withColumn("_n", F.row_number().over(Window.partitionBy("c").orderBy("entry_id"))).where(F.col("_n") <= rows).drop("_n")  # further ones of equal words rank behind
    fits = F.col("q_year").isNull() | F.col("c_year").isNull() | (F.abs(F.col("q_year") - F.col("c_year")) <= 1)

    def same(x: DataFrame, y: DataFrame) -> Column:
        return (x["q"] == y["q"]) & x["q_year"].eqNullSafe(y["q_year"])

    left, found = asked.select("q", "q_year").distinct(), []
    between = (1 + least) / 2 if 0.3 <= least < 1 else least  # of a low one the rest is asked at once
    for t in sorted({max(1.0, least), between, least}, reverse=True):
        if found and left.isEmpty():
            break
        if t >= 1:
            ranked = left.join(c, F.col("q") == F.col("c")).withColumn("score", F.lit(1.0)).where(F.col("score") >= t)
        else:
            ranked = left.join(similar_sets(left.select("q").distinct(), c.select("c").distinct(), t), "q").join(c, "c")
        top = ranked.withColumn("rn", F.row_number().over(Window.partitionBy("q", "q_year").orderBy(F.desc("score"), "entry_id"))).where(F.col("rn") <= rows)
        best = top.groupBy("q", "q_year").agg(F.count("*").alias("n"), F.min_by(F.struct("entry_id", "score"), F.when(fits, F.col("rn"))).alias("b"))
        found.append(best.where("b is not null").select("q", "q_year", "b.entry_id", "b.score"))
        settled = best.where(F.col("b").isNotNull() | (F.col("n") >= rows)).select("q", "q_year").alias("s")
        left = left.join(settled, same(left, settled), "left_anti")
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return asked.join(every, same(asked, every)).select("query_id", "entry_id", "score")
