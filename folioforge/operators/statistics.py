"""Aggregation of metrics: means by section, paired comparison of two systems and
with a baseline, bootstrap intervals, signed-rank tests, token accounting, pivots
and drill-downs."""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.udf import pandas_udf

TOKEN_FIELDS = ("prompt_tokens", "completion_tokens", "total_tokens", "cached_tokens", "reasoning_tokens")
#: The group of metrics that a stage's calls serve; others are ``other``.
STAGE_GROUPS = {
    "header": ("HEADER_METADATA", "IDENTIFIER_SELECT", "TEI_METADATA", "TEI_VALIDATED"),
    "abstract": ("ABSTRACT_FROM_OCR", "ABSTRACT_SELECT", "OCR_CLEANUP"),
    "keywords": ("KEYWORD_EXTRACT", "KEYWORD_INFER", "KEYWORD_SELECT", "KEYWORD_TRANSLATE"),
    "content": ("CONTENT_BODY_SECTIONS", "CONTENT_FIGURE_CAPTIONS", "CONTENT_HEAD", "CONTENT_REFERENCES", "CONTENT_TABLES_FIGURES", "CONTENT_TABLE_CAPTIONS"),
}


def aggregate_metrics(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, n, mean): the mean of each metric's values that aren't NULL; a
    metric without any has no row."""
    long = unpivot(df, metrics)
    return long.groupBy("metric").agg(F.count("value").alias("n"), F.avg("value").alias("mean")).where("n > 0")


def unpivot(df: DataFrame, metrics: list[str], keep: list[str] | None = None) -> DataFrame:
    """(keep…, metric, value) rows."""
    return df.unpivot(keep or [], [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value") if keep else df.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics))).alias("x")).select("x.*")


@pandas_udf("array<double>")
def bootstrap_ci(values: pd.Series, order: pd.Series) -> list[float]:
    """[mean, low, high]: percentile bootstrap interval (200 resamples, 95 %, fixed
    seed) of the values that aren't NULL, drawn from in the given order."""
    v = values.iloc[np.argsort(order.to_numpy(), kind="stable")].dropna().to_numpy(float)
    if not len(v):
        return [float("nan")] * 3
    rng = np.random.default_rng(0)
    means = np.array([v[rng.integers(0, len(v), len(v))].mean() for _ in range(200)]) if len(v) > 1 else v
    low, high = np.percentile(means, [2.5, 97.5])
    return [float(v.mean()), float(low), float(high)]


def signed_rank_p(a: np.ndarray, b: np.ndarray) -> float | None:
    """Two-sided p of Wilcoxon's signed-rank test, zeros dropped: exact up to 50
    differences without ties, else by the normal approximation with tie
    correction.  None for fewer than two pairs, 1 when all are equal."""
    if len(a) != len(b) or len(a) < 2:
        return None
    d = np.asarray(a, float) - np.asarray(b, float)
    d = d[d != 0]
    if not len(d):
        return 1.0
    size, n = np.abs(d), len(d)
    order = np.argsort(size, kind="stable")
    _, inv, count = np.unique(size, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[inv]
    w = min(rank[d > 0].sum(), rank[d < 0].sum())
    if n <= 50 and len(count) == n and len(order) == len(a):
        ways = np.zeros(n * (n + 1) // 2 + 1)
        ways[0] = 1
        for r in range(1, n + 1):
            ways[r:] = ways[r:] + ways[:-r]
        return float(min(1.0, 2 * ways[: int(w) + 1].sum() / 2.0**n))
    var = n * (n + 1) * (2 * n + 1) / 24 - (count**3 - count).sum() / 48
    z = (w - n * (n + 1) / 4) / math.sqrt(var)
    return float(math.erfc(abs(z) / math.sqrt(2)))


@pandas_udf("double")
def paired_p(a: pd.Series, b: pd.Series) -> float:
    """:func:`signed_rank_p` of the pairs of which neither is NULL."""
    ok = a.notna() & b.notna()
    p = signed_rank_p(a[ok].to_numpy(), b[ok].to_numpy())
    return float("nan") if p is None else p


def sections(pairs: DataFrame, by: str = "corpus") -> DataFrame:
    """(section, metric, n_a, n_b, mean_a, mean_b, delta) overall and for each
    corpus, from rows (corpus, record_id, metric, a, b) of two systems.  Each mean
    is over its side's own values."""
    g = pairs.groupingSets([[F.col("metric")], [F.col(by), F.col("metric")]], by, "metric")
    out = g.agg(F.grouping(by).alias("_all"), F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.avg("a").alias("mean_a"), F.avg("b").alias("mean_b"))
    return out.select(F.when(F.col("_all") == 1, "overall").otherwise(F.col(by)).alias("section"), "metric", "n_a", "n_b", "mean_a", "mean_b", (F.col("mean_a") - F.col("mean_b")).alias("delta"))


def section_tests(pairs: DataFrame, by: str = "corpus") -> DataFrame:
    """(section, metric, ci_a, ci_b, p): intervals of both systems and the paired
    test by key (NULL where there is none).  Values are drawn from in the order of
    corpus and record.  A section's values come to one task: as many as records;
    :func:`poisson_intervals` has no such limit.
    """
    order = F.concat_ws("\x01", F.col(by).cast("string"), F.lpad(F.col("record_id").cast("string"), 40, " "))
    both = pairs.withColumn("section", F.explode(F.array(F.lit("overall"), F.col(by))))
    out = both.groupBy("section", "metric").agg(bootstrap_ci("a", order).alias("a"), bootstrap_ci("b", order).alias("b"), F.nanvl(paired_p("a", "b"), F.lit(None).cast("double")).alias("p"))
    interval = lambda c: F.struct(*(F.col(c)[i].alias(n) for i, n in enumerate(("mean", "low", "high")))).alias(f"ci_{c}")
    return out.select("section", "metric", interval("a"), interval("b"), "p")


def poisson_intervals(pairs: DataFrame, by: str = "corpus", resamples: int = 200, level: float = 0.95) -> DataFrame:
    """(section, metric, mean, low, high): intervals of system a for any number of
    records.  Each record is in each resample as often as a Poisson variable of mean
    1 says, drawn from its key; so resamples are summed where the records are, and
    only their sums are shuffled."""
    own = pairs.where("a is not null").select(F.col(by).cast("string").alias("c"), "metric", F.col("a").cast("double").alias("a"), F.xxhash64(by, "record_id").alias("h"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for b in batches:
            for key, g in b.groupby(["c", "metric"], dropna=False):
                total = sums.setdefault(key, np.zeros((resamples + 1, 2)))
                for h, a in zip(g["h"].to_numpy(), g["a"].to_numpy(float)):
                    n = np.random.default_rng(int(h) & (2**63 - 1)).poisson(1.0, resamples)
                    total[:-1, 0] += n * a
                    total[:-1, 1] += n
                total[-1] += g["a"].sum(), len(g)
        for (c, m), total in sums.items():
            yield pd.DataFrame({"c": c, "metric": m, "i": np.arange(resamples + 1), "s": total[:, 0], "n": total[:, 1]})

    parts = own.mapInPandas(run, "c string, metric string, i int, s double, n double")
    both = parts.withColumn("section", F.explode(F.array(F.lit("overall"), "c"))).groupBy("section", "metric", "i").agg((F.sum("s") / F.nullif(F.sum("n"), F.lit(0.0))).alias("mean"))
    resampled = F.when(F.col("i") < resamples, F.col("mean"))
    return both.groupBy("section", "metric").agg(F.max(F.when(F.col("i") == resamples, F.col("mean"))).alias("mean"), F.percentile(resampled, (1 - level) / 2).alias("low"), F.percentile(resampled, (1 + level) / 2).alias("high"))


def baseline(now: DataFrame, before: DataFrame, metric: str, keys: tuple[str, ...] = ("corpus", "record_id")) -> DataFrame:
    """(corpus, n, mean_now, mean_before, delta) over the records that both runs
    have a value for."""
    joined = now.select(*keys, F.col(metric).alias("_now")).join(before.select(*keys, F.col(metric).alias("_before")), list(keys)).where("_now is not null and _before is not null")
    agg = joined.groupBy(keys[0]).agg(F.count("*").alias("n"), F.avg("_now").alias("mean_now"), F.avg("_before").alias("mean_before"))
    return agg.withColumn("delta", F.col("mean_now") - F.col("mean_before"))


def stage_group(stage: Column) -> Column:
    out = F.lit("other")
    for group, stages in STAGE_GROUPS.items():
        out = F.when(stage.isin(*stages), group).otherwise(out)
    return out


def token_totals(calls: DataFrame, by: str = "corpus", fields: tuple[str, ...] = TOKEN_FIELDS) -> DataFrame:
    """Sums of the token fields and the number of calls by corpus, corpus and stage,
    corpus and group, and overall; NULL counts are 0."""
    base = calls.withColumn("group", stage_group(F.col("stage")))
    c, s, g = F.col(by), F.col("stage"), F.col("group")
    out = base.groupingSets([[], [c], [c, s], [c, g]], by, "stage", "group")
    sums = [F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in fields]
    return out.agg(F.grouping_id().alias("level"), F.count("*").alias("n_calls"), *sums)


def usage(payload: Column) -> dict[str, Column]:
    """The five token counters of a JSON answer; a total that is missing or 0 is the
    sum of prompt and completion."""
    u = F.from_json(payload, "usage struct<prompt_tokens:long,completion_tokens:long,total_tokens:long,prompt_tokens_details:struct<cached_tokens:long>,completion_tokens_details:struct<reasoning_tokens:long>>")["usage"]
    n = lambda x: F.coalesce(x, F.lit(0))
    prompt, completion = n(u["prompt_tokens"]), n(u["completion_tokens"])
    total = F.coalesce(F.nullif(u["total_tokens"], F.lit(0)), prompt + completion)
    return {"prompt_tokens": prompt, "completion_tokens": completion, "total_tokens": total, "cached_tokens": n(u["prompt_tokens_details"]["cached_tokens"]), "reasoning_tokens": n(u["completion_tokens_details"]["reasoning_tokens"])}


def pivot_runs(runs: DataFrame, labels: list[str]) -> DataFrame:
    """(section, metric, <label>…, winner) from rows (label, section, metric, mean);
    the winner is the first label of the highest mean, NaN and NULL apart."""
    wide = runs.groupBy("section", "metric").pivot("label", labels).agg(F.first("mean"))
    value = lambda x: F.when(F.isnan(F.col(f"`{x}`")), None).otherwise(F.col(f"`{x}`"))
    best = F.greatest(*(value(x) for x in labels)) if len(labels) > 1 else value(labels[0])
    winner = F.coalesce(*(F.when(value(x) == best, F.lit(x)) for x in labels))
    return wide.withColumn("winner", winner)


def cases(pairs: DataFrame, mode: str = "regressions", corpus: str | None = None, limit: int | None = None) -> DataFrame:
    """Records on which a is worse (``regressions``) or better (``improvements``)
    than b; NULLs are neither."""
    out = pairs.where("a < b" if mode == "regressions" else "a > b")
    out = out if corpus is None else out.where(F.col("corpus") == corpus)
    return out.orderBy(F.abs(F.col("a") - F.col("b")).desc(), "corpus", "record_id").limit(limit) if limit is not None else out


def word_diff(reference: str | None, candidate: str | None) -> str:
    """Both texts in one, with what only one has marked."""
    if reference is None or candidate is None:
        return f"reference={reference} candidate={candidate}"
    a, b, out = reference.split(), candidate.split(), []
    for op, i1, i2, j1, j2 in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            out += a[i1:i2]
            continue
        if i1 < i2:
            out.append(f"[-{' '.join(a[i1:i2])}-]")
        if j1 < j2:
            out.append(f"{{+{' '.join(b[j1:j2])}+}}")
    return " ".join(out)


@pandas_udf("string")
def word_diff_udf(reference: pd.Series, candidate: pd.Series) -> pd.Series:
    return pd.Series([word_diff(a, b) for a, b in zip(reference, candidate)])


def examples(df: DataFrame, rules: dict[str, Column], pos: Column, most: int = 2) -> DataFrame:
    """The first rows that each rule applies to, with the rule's name."""
    tagged = df.withColumn("rule", F.explode(F.filter(F.array(*(F.when(c, F.lit(name)) for name, c in rules.items())), lambda r: r.isNotNull())))
    rank = F.row_number().over(Window.partitionBy("rule").orderBy(pos))
    return tagged.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


def error_histogram(errors: DataFrame, column: str = "error") -> DataFrame:
    """(kind, n): errors by what stands before the first colon."""
    return errors.groupBy(F.trim(F.substring_index(F.col(column), ":", 1)).alias("kind")).agg(F.count("*").alias("n"))


def weighted_mode(df: DataFrame, by: list[str], value: str, weight: str, pos: str) -> DataFrame:
    """Each group's value of the greatest weight, the first seen in a tie."""
    g = df.groupBy(*by, value).agg(F.sum(weight).alias("_w"), F.min(pos).alias("_p"))
    return g.groupBy(*by).agg(F.max_by(value, F.struct("_w", -F.col("_p"))).alias(value))


def upper_median(x: str) -> Column:
    """The middle value, of an even number the upper one."""
    v = F.array_sort(F.collect_list(x))
    return F.try_element_at(v, (F.floor(F.size(v) / 2) + 1).cast("int"))


def sample(df: DataFrame, by: str, order: str, n: int, seed: int = 42) -> DataFrame:
    """A sample of each group without replacement: the ``n`` records that come first
    by a hash of the seed, the group and their key, ties by the key.  The keys of a
    group in a partition are cut to ``n`` before any is shuffled, and only then are
    whole rows read."""
    keyed = df.select(by, order).withColumn("_h", F.xxhash64(F.lit(seed), by, order))
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_h", order))
    chosen = keyed.withColumn("_n", rank).where(F.col("_n") <= n).select(by, order)
    return df.join(chosen.distinct(), [by, order], "left_semi")
