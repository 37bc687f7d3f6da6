"""Record-level metrics of predictions against gold, as column expressions.

A metric is NULL when gold is empty, 0 when only the prediction is.  A precision,
recall and F1 together are one struct ``<p, r, f1>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

PR = "struct<p:double,r:double,f1:double>"


def pr_of(matched: Column, n_gold: Column, n_pred: Column, matched_pred: Column | None = None) -> Column:
    """The struct from counts."""
    counts = F.struct(matched.alias("m"), n_gold.alias("g"), n_pred.alias("n"), (matched if matched_pred is None else matched_pred).alias("mp"))

    def rates(c: Column) -> Column:
        r = c["m"] / F.greatest(c["g"], F.lit(1))
        p = F.when(c["n"] > 0, c["mp"] / F.greatest(c["n"], F.lit(1))).otherwise(F.lit(0.0))
        return F.when(c["g"] > 0, F.struct(p.alias("p"), r.alias("r")))

    f1 = lambda x: F.when(x["p"] + x["r"] > 0, 2 * x["p"] * x["r"] / (x["p"] + x["r"])).otherwise(F.lit(0.0))
    return T.let(T.let(counts, rates), lambda x: F.when(x.isNotNull(), F.struct(x["p"].alias("p"), x["r"].alias("r"), f1(x).alias("f1")))).cast(PR)


def _sides(gold: Column, pred: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of both sides, each computed once."""
    return T.let(F.struct(gold.alias("g"), pred.alias("p")), lambda x: body(x["g"], x["p"]))


def _no_blank(values: Column, key: Callable[[Column], Column]) -> Column:
    some, each = F.coalesce(values, F.array().cast("array<string>")), lambda x: F.transform(x, lambda v: key(v))
    keyed = T.let(some, lambda x: F.when(T.all_normal(x), x).otherwise(each(x))) if key is T.normalize_text else each(some)
    return F.filter(keyed, lambda v: v != "")


def set_pr(gold: Column, pred: Column) -> Column:
    """Of two sets as arrays."""
    return _sides(F.array_distinct(gold), F.array_distinct(pred), lambda g, p: pr_of(F.size(F.array_intersect(g, p)), F.size(g), F.size(p)))


def keyword_pr(gold: Column, pred: Column) -> Column:
    return set_pr(_no_blank(gold, T.normalize_text), _no_blank(pred, T.normalize_text))


def keyword_recall(gold: Column, pred: Column) -> Column:
    return keyword_pr(gold, pred)["r"]


def identifier_pr(gold: Column, pred: Column) -> Column:
    return set_pr(_no_blank(gold, T.normalize_identifier), _no_blank(pred, T.normalize_identifier))


def identifier_recall(gold: Column, pred: Column) -> Column:
    return identifier_pr(gold, pred)["r"]


def greedy_matches(gold: Column, pred: Column, match: Callable[[Column, Column], Column]) -> Column:
    """How many gold values find a partner, when each in turn takes the first
    prediction that matches and isn't taken."""

    def step(left: Column, g: Column) -> Column:
        def look(a: Column, p: Column) -> Column:  # what is behind the first match isn't compared
            i = a["i"] + 1
            return F.when(a["at"] > 0, a).otherwise(F.struct(i.alias("i"), F.when(match(g, p), i).otherwise(0).alias("at")))

        def without(at: Column) -> Column:
            return F.when(at > 0, F.concat(F.slice(left, F.lit(1), at - 1), F.slice(left, at + 1, F.greatest(F.size(left) - at, F.lit(0))))).otherwise(left)

        return T.let(F.aggregate(left, F.struct(F.lit(0).alias("i"), F.lit(0).alias("at")), look)["at"], without)

    return F.size(pred) - F.size(F.aggregate(gold, pred, step))


def greedy_pr(gold: Column, pred: Column, match: Callable[[Column, Column], Column]) -> Column:
    return _sides(gold, pred, lambda g, p: pr_of(greedy_matches(g, p, match), F.size(g), F.size(p)))


def alike(g: Column, p: Column, least: float) -> Column:
    """Whether the edit similarity is at least so much; the lengths decide most."""
    return F.when(T.most_sim(g, p) < least, F.lit(False)).otherwise(T.edit_sim(g, p) >= least)


def section_pr(gold: Column, pred: Column, least: float = 0.7) -> Column:
    """Headings, greedily matched by normalised edit similarity."""
    norm = lambda v: _no_blank(v, T.normalize_text)
    return greedy_pr(norm(gold), norm(pred), lambda g, p: alike(g, p, least))


def caption_pr(gold: Column, pred: Column) -> Column:
    return greedy_pr(_no_blank(gold, T.normalize_text), _no_blank(pred, T.normalize_text), T.normal_captions_match)


def reference_pr(gold_dois: Column, pred_dois: Column, gold_titles: Column, pred_titles: Column) -> Column:
    """By DOI where both sides have any, by title else."""
    by_title = _sides(_no_blank(gold_titles, T.normalize_reference_title), _no_blank(pred_titles, T.normalize_reference_title), lambda g, p: F.when(F.size(g) > 0, section_pr(g, p, 0.5)))
    by_doi = lambda g, p: F.when((F.size(g) > 0) & (F.size(p) > 0), set_pr(g, p)).otherwise(by_title)
    return _sides(_no_blank(gold_dois, T.normalize_identifier), _no_blank(pred_dois, T.normalize_identifier), by_doi)


def author_match(gold: Column, predicted: Column) -> Column:
    """Whether any predicted name has the last word of the gold name."""
    last = F.try_element_at(T.author_tokens(gold), F.lit(-1))
    return T.let(last, lambda w: F.coalesce(F.exists(predicted, lambda p: F.array_contains(T.author_tokens(p), w)), F.lit(False)))


def author_matches(gold: DataFrame, predicted: DataFrame, by: list[str], name: str = "name") -> DataFrame:
    """``gold`` (by, name, …) with ``hit``: :func:`author_match` of its name and the
    names of ``predicted`` (by, name) in its group.  Words are joined, so neither the
    group's names are gathered nor read once for each gold name."""
    words = predicted.select(*by, F.explode(T.author_tokens(F.col(name))).alias("_word")).distinct().withColumn("hit", F.lit(True))
    last = gold.withColumn("_word", F.try_element_at(T.author_tokens(F.col(name)), F.lit(-1)))
    return last.join(words, [*by, "_word"], "left").select(*gold.columns, F.coalesce("hit", F.lit(False)).alias("hit"))


def authors_pr(gold: Column, pred: Column) -> Column:
    none = F.array().cast("array<string>")
    words = lambda v: F.transform(F.coalesce(v, none), lambda x: T.author_tokens(x))
    has = lambda x, b: F.coalesce(F.exists(b, lambda y: F.array_contains(y, F.try_element_at(x, F.lit(-1)))), F.lit(False))
    hits = lambda a, b: F.size(F.filter(a, lambda x: has(x, b)))
    return _sides(words(gold), words(pred), lambda g, p: pr_of(hits(g, p), F.size(g), F.size(p), hits(p, g)))


def best_pr(triples: Column) -> Column:
    """The struct of the highest F1, the first in a tie; NULLs are passed over."""
    return F.aggregate(F.filter(triples, lambda t: t.isNotNull()), F.lit(None).cast(PR), lambda a, t: F.when(a.isNull() | (t["f1"] > a["f1"]), t).otherwise(a))


def reference_combined_pr(records: Column, dois: Column, titles: Column) -> Column:
    """Gold records in turn take their DOI, or else the most similar title that is
    left, of a similarity of one half or more."""
    none = F.array().cast("array<string>")
    asked = F.transform(records, lambda r: F.struct(T.normalize_identifier(r["doi"]).alias("doi"), T.normalize_text(r["title"]).alias("title")))
    names = F.transform(F.filter(F.coalesce(titles, none), lambda t: T.text_of(t) != ""), lambda t: T.normalize_text(t))
    start = F.struct(F.array_distinct(_no_blank(dois, T.normalize_identifier)).alias("d"), names.alias("t"), F.lit(0).alias("m"))

    def without(values: Column, at: Column) -> Column:
        return F.concat(F.slice(values, F.lit(1), at - 1), F.slice(values, at + 1, F.greatest(F.size(values) - at, F.lit(0))))

    def step(acc: Column, r: Column) -> Column:
        best = lambda s: F.struct(F.array_max(s).alias("sim"), F.array_position(s, F.array_max(s)).cast("int").alias("at"))
        by_title = T.let(
            T.let(F.transform(acc["t"], lambda t: T.edit_sim(r["title"], t)), best),
            lambda b: F.when(b["sim"] >= 0.5, F.struct(acc["d"].alias("d"), without(acc["t"], b["at"]).alias("t"), (acc["m"] + 1).alias("m"))).otherwise(acc),
        )
        by_doi = F.struct(F.array_remove(acc["d"], r["doi"]).alias("d"), acc["t"].alias("t"), (acc["m"] + 1).alias("m"))
        return F.when((r["doi"] != "") & F.array_contains(acc["d"], r["doi"]), by_doi).when((r["title"] != "") & (F.size(acc["t"]) > 0), by_title).otherwise(acc)

    def of(s: Column) -> Column:
        return pr_of(F.aggregate(asked, s, step)["m"], F.size(records), F.size(s["d"]) + F.size(s["t"]))

    return F.when(F.size(records) > 0, T.let(start, of))


def _has(df: DataFrame, side: str, name: str) -> bool:
    return name in df.schema[side].dataType.names


def evaluate(df: DataFrame, pred: str = "pred", gold: str = "gold") -> DataFrame:
    """``df`` with a column for each metric, from the structs ``pred`` and ``gold``.

    Missing fields count as empty; the content metrics (sections, captions,
    references) are made only for the fields that both sides have, and are NULL
    where a row has NULL for one of them.
    """

    def at(side: str, name: str, kind: str) -> Column:
        return F.col(f"{side}.{name}") if _has(df, side, name) else F.lit(None).cast(kind)

    words = "array<string>"
    out: dict[str, Column] = {}
    title = T.normalize_text(at(pred, "title", "string"))
    golds = F.coalesce(at(gold, "titles", words), F.array().cast(words))
    golds = F.transform(F.when(F.size(golds) > 0, golds).otherwise(F.array(T.text_of(at(gold, "title", "string")))), T.normalize_text)
    out["title_match"] = F.exists(golds, lambda g: (g != "") & (g == title)).cast("int")
    out["title_edit_sim"] = T.max_edit_sim(title, golds)
    triples = {"authors": authors_pr(at(gold, "authors", words), at(pred, "authors", words))}
    abstract = T.text_of(at(pred, "abstract", "string"))
    abstracts = F.coalesce(at(gold, "abstracts", words), F.array().cast(words))
    abstracts = F.filter(F.when(F.size(abstracts) > 0, abstracts).otherwise(F.array(T.text_of(at(gold, "abstract", "string")))), lambda a: a != "")
    sim = F.array_max(F.transform(abstracts, lambda a: T.normalized_edit_sim(a, abstract)))
    triples["abstract"] = F.when(sim.isNotNull(), F.struct(sim.alias("p"), sim.alias("r"), sim.alias("f1"))).cast(PR)
    out["abstract_edit_sim"] = F.array_max(F.transform(abstracts, lambda a: T.edit_sim(abstract, a)))
    words_pred = at(pred, "keywords", words)
    flat = keyword_pr(at(gold, "keywords", words), words_pred)
    if _has(df, gold, "keywords_groups"):
        groups = F.coalesce(F.map_values(F.col(f"{gold}.keywords_groups")), F.array().cast("array<array<string>>"))
        triples["keywords"] = F.coalesce(best_pr(F.transform(groups, lambda g: keyword_pr(g, words_pred))), flat)
    else:
        triples["keywords"] = flat
    for name in ("publisher", "date", "rights"):
        out[f"{name}_match"] = T.scalar_match(at(gold, name, "string"), at(pred, name, "string"))
    out["language_match"] = T.language_match(at(gold, "language", "string"), at(pred, "language", "string"))
    for name in ("types", "formats", "relations"):
        triples[name] = keyword_pr(at(gold, name, words), at(pred, name, words))
    triples["identifiers"] = identifier_pr(at(gold, "identifiers", words), at(pred, "identifiers", words))
    both = lambda *names: all(_has(df, s, n) for s in (pred, gold) for n in names)
    for name, field, rule in (("body_section", "body_sections", section_pr), ("figure_caption", "figure_captions", caption_pr), ("table_caption", "table_captions", caption_pr)):
        if both(field):
            g, p = F.col(f"{gold}.{field}"), F.col(f"{pred}.{field}")
            triples[name] = F.when(g.isNotNull() & p.isNotNull(), rule(g, p))
    refs = [n for n in ("reference_dois", "reference_titles") if _has(df, pred, n)]
    there = F.lit(False)
    for n in refs:
        there = there | F.col(f"{pred}.{n}").isNotNull()
    if refs and (_has(df, gold, "reference_dois") or _has(df, gold, "reference_titles")):
        g_there = at(gold, "reference_dois", words).isNotNull() | at(gold, "reference_titles", words).isNotNull()
        triples["reference"] = F.when(there & g_there, reference_pr(*(at(s, n, words) for n in ("reference_dois", "reference_titles") for s in (gold, pred))))
    if refs and _has(df, gold, "reference_records"):
        made = reference_combined_pr(F.col(f"{gold}.reference_records"), at(pred, "reference_dois", words), at(pred, "reference_titles", words))
        triples["reference_combined"] = F.when(there, made)
    for name, t in triples.items():
        for part, field in (("precision", "p"), ("recall", "r"), ("f1", "f1")):
            out[f"{name}_{part}"] = t[field]
    return df.withColumns(out)
