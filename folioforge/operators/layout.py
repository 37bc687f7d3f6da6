"""Operators on layout lines: rows (record_id, pos, text, page, x, y, …) of which
``pos`` gives the order.  Missing numbers count as 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

FURNITURE = "(?iuU)" + T.alternatives(
    r"\b(?:med|bio)rxiv\s+preprint\b",
    r"\b" + T.alternatives(r"downloaded\s+from", r"all\s+rights\s+reserved", r"international\s+license", r"cc[-\s]?by", r"made\s+available\s+under", r"license\s+to\s+display", "author/funder", r"copyright\s+holder", r"not\s+certified\s+by\s+peer\s+review", r"this\s+version\s+posted") + r"\b",
)
IDENTIFIER = r"(?iuU)\b(?:www\.|https?://|doi\s*:)"


def number(df: DataFrame, name: str) -> Column:
    """A numeric column, 0 where it is missing."""
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)


def page(df: DataFrame) -> Column:
    return F.coalesce(F.expr("try_cast(page AS int)"), F.lit(0))


def scale(df: DataFrame, name: str, usual: float) -> Column:
    """A page's size against the usual one, 1 where it is missing or tiny."""
    n = number(df, name)
    return F.when(n < 100, F.lit(1.0)).otherwise(n / usual)


def repeated_keys(lines: DataFrame, min_pages: int = 3) -> DataFrame:
    """(record_id, key): texts that stand on so many pages of a document."""
    key = T.support_key(F.col("text"))
    return lines.select("record_id", key.alias("key"), page(lines).alias("_p")).where("key != ''").groupBy("record_id", "key").agg(F.count_distinct("_p").alias("_n")).where(F.col("_n") >= min_pages).select("record_id", "key")


def _judged(lines: DataFrame, drop_identifiers: bool) -> DataFrame:
    """The lines with what :func:`_furniture` asks of them: ``_bare``, furniture by
    itself; ``_often``, furniture where it recurs; ``_key``, a digest of its key, and
    ``_page``.  These are made before lines travel, so the text need not."""
    t, x, y = F.col("_t"), number(lines, "x"), number(lines, "y")
    xs, ys = scale(lines, "page_w", 612.0), scale(lines, "page_h", 792.0)
    often = ((y < 65 * ys) | (y > 720 * ys) | (F.length(t) < 90)) & (t != "") & ~t.rlike(T.SECTION_ANCHOR) & F.col("record_id").isNotNull()
    bare = (t == "") | t.rlike(r"(?U)^[\W_]+$") | t.rlike(r"(?U)^[\divxIVX]+$") | t.rlike(FURNITURE) | t.rlike(r"(?i)^doi\s*:?$")
    bare = bare | (x < 60 * xs) & t.rlike(r"(?U)^[\dA-Za-z.:-]{1,6}$") | (y < 32 * ys) & (F.length(t) < 180) | (y > 760 * ys) & (F.length(t) < 100)
    if drop_identifiers:
        bare = bare | (F.length(t) < 180) & t.rlike(IDENTIFIER)
    return lines.withColumn("_t", T.norm_ws(F.col("text"))).select(*lines.columns, bare.alias("_bare"), often.alias("_often"), F.md5(T.fold_case(t)).alias("_key"), page(lines).alias("_page"))


def _furniture(min_pages: int) -> Column:
    """Whether a judged line is furniture, among the lines that there are."""
    again = F.size(F.collect_set("_page").over(Window.partitionBy("record_id", "_key"))) >= min_pages
    return F.col("_bare") | F.col("_often") & again


def prune(lines: DataFrame, max_page: int | None = None, drop_identifiers: bool = False, min_pages: int = 3) -> DataFrame:
    """The lines without page furniture: blanks, page numbers, banners, running
    heads and feet, margin marks.  Headings of back sections stay however often
    they recur.  Repetition is counted over all pages."""
    out = _judged(lines, drop_identifiers).withColumn("_drop", _furniture(min_pages)).where("not _drop")
    out = out if max_page is None else out.where(F.col("_page") <= max_page)
    return out.select(lines.columns)


def _limited(df: DataFrame, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("record_id").orderBy("pos"))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def front_matter(lines: DataFrame, max_lines: int = 200, max_page: int = 5) -> DataFrame:
    """The lines of the first pages, or where there are none the whole document's;
    of each document at most ``max_lines``."""
    df = lines.withColumn("_front", page(lines) <= max_page)
    df = df.withColumn("_any", F.max("_front").over(Window.partitionBy("record_id")))
    return _limited(df.where("_front or not _any").drop("_front", "_any"), max_lines)


def front_matter_evidence(lines: DataFrame, max_lines: int = 200, max_page: int = 5, drop_identifiers: bool = False) -> DataFrame:
    """The same, pruned; a document of which nothing is left stays as it was."""
    of = Window.partitionBy("record_id")  # all windows below lie in it: lines travel once
    df = _judged(lines, drop_identifiers).withColumn("_front", F.col("_page") <= max_page)
    front = df.withColumn("_any", F.max("_front").over(of)).where("_front or not _any")
    kept = front.withColumn("_keep", ~_furniture(3)).withColumn("_some", F.max("_keep").over(of)).where("_keep or not _some")
    return _limited(kept, max_lines).select(lines.columns)


def numbered(lines: DataFrame) -> DataFrame:
    """(record_id, text): the lines of each document, numbered with their place."""
    n = F.row_number().over(Window.partitionBy("record_id").orderBy("pos"))
    entry = F.format_string("%02d | y=%.1f x=%.1f | %s", "_n", number(lines, "y"), number(lines, "x"), T.text_of(F.col("text")))
    df = lines.withColumn("_n", n).select("record_id", F.struct("_n", entry.alias("e")).alias("s"))
    return df.groupBy("record_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["e"]), "\n").alias("text"))


def joined(lines: DataFrame, most: int = 200) -> DataFrame:
    """(record_id, text): the first lines that have text."""
    df = _limited(lines, most).where(T.text_of(F.col("text")) != "").select("record_id", F.struct("pos", "text").alias("s"))
    return df.groupBy("record_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["text"]), "\n").alias("text"))


def marker_windows(lines: DataFrame, heading: str = T.ABSTRACT_HEADING, stop: str = T.NEXT_SECTION, max_blocks: int = 3, suffix: int = 80, fallback: int = 120, max_page: int = 5, label: bool = True) -> DataFrame:
    """(record_id, block, text): what follows each of the first headings, up to the
    next section or ``suffix`` lines; a bare heading gets a colon (``label``).  Without a heading, lines that begin with the
    word; without those, the first ``fallback`` lines."""
    base = lines.withColumn("i", F.row_number().over(Window.partitionBy("record_id").orderBy("pos"))).withColumn("t", T.text_of(F.col("text")))
    front = page(lines) <= max_page
    strict = front & F.substring(T.strip(F.col("t")), 1, 80).rlike(heading)
    loose = front & F.col("t").rlike(T.ABSTRACT_START)
    marks = base.where(strict | loose).select("record_id", F.col("i").alias("at"), strict.alias("s"))
    marks = marks.withColumn("any_s", F.max("s").over(Window.partitionBy("record_id"))).where("s or not any_s")
    marks = marks.withColumn("block", F.row_number().over(Window.partitionBy("record_id").orderBy("at"))).where(F.col("block") <= max_blocks)
    inside = base.select("record_id", "i", "t").join(marks.select("record_id", "at", "block", "s"), "record_id").where(F.col("i").between(F.col("at"), F.col("at") + suffix - 1))
    end = F.min(F.when((F.col("i") > F.col("at")) & F.col("t").rlike(stop), F.col("i"))).over(Window.partitionBy("record_id", "block"))
    inside = inside.withColumn("end", end).where("end is null or i < end")
    colon = F.lit(label) & (F.col("i") == F.col("at")) & F.substring(T.strip(F.col("t")), 1, 80).rlike(heading) & ~F.rtrim("t").rlike("[.:]$")
    piece = F.struct("i", F.when(colon, F.concat(F.rtrim("t"), F.lit(":"))).otherwise(F.col("t")).alias("t"))
    whole = lambda c: T.norm_ws(F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda s: s["t"]), " ")).alias("text")
    found = inside.groupBy("record_id", "block").agg(whole(piece))
    rest = base.join(marks.select("record_id").distinct(), "record_id", "left_anti").where(F.col("i") <= fallback)
    return found.unionByName(rest.groupBy("record_id").agg(whole(F.struct("i", "t"))).select("record_id", F.lit(1).alias("block"), "text"))


def context(lines: DataFrame, marker: str, before: int = 1, after: int = 4, most: int = 4) -> DataFrame:
    """(record_id, text): the lines around the first marker lines, those of
    overlapping windows once for each."""
    base = lines.withColumn("i", F.row_number().over(Window.partitionBy("record_id").orderBy("pos"))).select("record_id", "i", T.text_of(F.col("text")).alias("t"))
    marks = base.where(F.col("t").rlike(marker)).withColumn("n", F.row_number().over(Window.partitionBy("record_id").orderBy("i"))).where(F.col("n") <= most).select("record_id", "n", F.col("i").alias("at"))
    near = base.join(marks, "record_id").where(F.col("i").between(F.col("at") - before, F.col("at") + after) & (F.col("t") != ""))
    return near.groupBy("record_id").agg(T.norm_ws(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "i", "t"))), lambda s: s["t"]), " ")).alias("text"))


def column_splits(lines: DataFrame, by: list[str], gap: float = 80.0, least: int = 3) -> DataFrame:
    """(by, split): where a page is divided into two columns, by the widest gap
    between the lines' left edges; NULL for one column."""
    x = lines.select(*by, number(lines, "x").alias("x"))
    w = Window.partitionBy(*by).orderBy("x")
    gaps = x.withColumn("next", F.lead("x").over(w)).withColumn("n", F.row_number().over(w)).withColumn("total", F.count("*").over(Window.partitionBy(*by)))
    best = gaps.groupBy(*by).agg(F.max("total").alias("total"), F.max_by(F.struct((F.col("next") - F.col("x")).alias("gap"), ((F.col("x") + F.col("next")) / 2).alias("mid"), "n"), F.struct((F.col("next") - F.col("x")), -F.col("n"))).alias("b"))
    two = (F.col("b.gap") >= gap) & (F.col("b.n") >= least) & (F.col("total") - F.col("b.n") >= least)
    return best.select(*by, F.when(two, F.col("b.mid")).alias("split"))


def reading_order(lines: DataFrame) -> DataFrame:
    """The lines with ``rank``: page by page, the left column before the right."""
    df = lines.withColumn("_page", page(lines))
    split = column_splits(df, ["record_id", "_page"])
    df = df.join(split, ["record_id", "_page"], "left")
    right = F.coalesce((number(lines, "x") > F.col("split")).cast("int"), F.lit(0))
    order = Window.partitionBy("record_id").orderBy("_page", right, number(lines, "y"), number(lines, "x"), "pos")
    return df.withColumn("rank", F.row_number().over(order)).select(*lines.columns, "rank")


def between(lines: DataFrame, start: str = T.REFERENCE_HEADING, stop: str = T.REFERENCE_STOP) -> DataFrame:
    """The lines after the first heading, up to the first stop after it."""
    w = Window.partitionBy("record_id")
    t = T.norm_ws(F.col("text"))
    df = lines.withColumn("_from", F.min(F.when(t.rlike(start), F.col("pos"))).over(w)).where("pos > _from")
    return df.withColumn("_to", F.min(F.when(t.rlike(stop), F.col("pos"))).over(w)).where("_to is null or pos < _to").drop("_from", "_to")


def baseline_neighbours(lines: DataFrame, tolerance: float = 1.5) -> DataFrame:
    """(record_id, pos, neighbours): how many other lines of the page stand at
    about the same height.  A band join: heights fall into buckets of the
    tolerance, and a line asks its own and the two beside it."""
    y = number(lines, "y")
    base = lines.where(T.norm_ws(F.col("text")) != "").select("record_id", "pos", page(lines).alias("p"), y.alias("y"), F.floor(y / tolerance).alias("b"))
    ask = base.withColumn("b", F.explode(F.array(F.col("b") - 1, F.col("b"), F.col("b") + 1))).alias("a")
    pair = ask.join(base.alias("o"), ["record_id", "p", "b"]).where((F.col("a.pos") != F.col("o.pos")) & (F.abs(F.col("a.y") - F.col("o.y")) <= tolerance))
    n = pair.groupBy("record_id", F.col("a.pos").alias("pos")).agg(F.count("*").alias("neighbours"))
    return base.select("record_id", "pos").join(n, ["record_id", "pos"], "left").withColumn("neighbours", F.coalesce("neighbours", F.lit(0)))


def next_in_column(lines: DataFrame, tolerance: float = 42.0) -> DataFrame:
    """(record_id, pos, next_pos, gap): the nearest lower line of the page whose
    left edge is within the tolerance."""
    base = lines.select("record_id", "pos", page(lines).alias("p"), number(lines, "x").alias("x"), number(lines, "y").alias("y"))
    o = base.select("record_id", "p", F.col("pos").alias("o_pos"), F.col("x").alias("o_x"), F.col("y").alias("o_y"))
    pair = base.join(o, ["record_id", "p"]).where((F.col("o_y") > F.col("y")) & (F.abs(F.col("o_x") - F.col("x")) <= tolerance))
    return pair.groupBy("record_id", "pos").agg(F.min(F.struct((F.col("o_y") - F.col("y")).alias("gap"), F.col("o_pos"))).alias("b")).select("record_id", "pos", F.col("b.o_pos").alias("next_pos"), "b.gap")


def previous_text(lines: DataFrame) -> DataFrame:
    """The lines with ``previous``: the last text before that isn't blank or a page
    marker."""
    t = T.norm_ws(F.col("text"))
    w = Window.partitionBy("record_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("previous", F.coalesce(F.last(F.when((t != "") & ~T.is_page_marker(t), t), ignorenulls=True).over(w), F.lit("")))


def body_start(lines: DataFrame, heading: str = r"(?iU)^\s*(?:(?:1|i)[.)]?\s+)?introduc(?:tion|ción|cion|ão|ção)\b") -> DataFrame:
    """(record_id, start): the position of the first introduction, or 0."""
    return lines.groupBy("record_id").agg(F.coalesce(F.min(F.when(T.norm_ws(F.col("text")).rlike(heading), F.col("pos"))), F.lit(0)).alias("start"))


BANNER = r"(?iuU)\b(?:bio|med)rxiv\s+preprint\b"
#: Marks of a language in front matter.
LANGUAGE_MARKS = {"en": r"(?iuU)\babstract\b", "pt": r"(?iuU)\bresumo\b", "es": r"(?iuU)\bresumen\b"}


def _first_lines(lines: DataFrame, n: int) -> DataFrame:
    return lines.withColumn("_n", F.row_number().over(Window.partitionBy("record_id").orderBy("pos"))).withColumn("_t", F.when(F.col("_n") <= n, T.norm_ws(F.col("text"))))


def has_banner(lines: DataFrame, banner: str = BANNER, n: int = 160) -> DataFrame:
    """(record_id, found): whether any of the first lines has a preprint server's
    banner."""
    return _first_lines(lines, n).groupBy("record_id").agg(F.coalesce(F.bool_or(F.col("_t").rlike(banner)), F.lit(False)).alias("found"))


def languages_of(lines: DataFrame, marks: dict[str, str] | None = None, n: int = 200) -> DataFrame:
    """(record_id, languages): those whose mark any of the first lines has, sorted."""
    df, marks = _first_lines(lines, n), LANGUAGE_MARKS if marks is None else marks
    found = F.array_compact(F.array(*(F.when(F.bool_or(F.col("_t").rlike(m)), F.lit(k)) for k, m in sorted(marks.items()))))
    return df.groupBy("record_id").agg(found.alias("languages"))
