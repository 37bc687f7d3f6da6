"""Reports as Markdown.  The tables behind them are aggregated by Spark; what comes
to the driver is a row for each section and metric."""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import statistics as S

#: The group of calls that a metric's tokens are those of.
TOKEN_GROUPS = {
    **dict.fromkeys("title_match title_edit_sim authors_recall authors_precision authors_f1 publisher_match date_match language_match rights_match identifiers_f1 identifiers_recall identifiers_precision".split(), "header"),
    **dict.fromkeys("abstract_edit_sim abstract_f1 abstract_precision abstract_recall".split(), "abstract"),
    **dict.fromkeys("keywords_f1 keywords_precision keywords_recall".split(), "keywords"),
    **{f"{c}_{x}": "content" for c in ("body_section", "figure_caption", "table_caption", "reference", "reference_combined") for x in ("precision", "recall", "f1")},
}


def kilo(n: float) -> str:
    """1234 as 1.2k."""
    return f"{n / 1000:.1f}k" if n >= 1000 else str(int(n))


def cell(mean: float, low: float, high: float) -> str:
    return f"{mean:.3f} [{low:.3f}, {high:.3f}]"


def signed(x: float | None) -> str:
    return "n/a" if x is None else f"{x:+.3f}"


def p_value(x: float | None) -> str:
    return "n/a" if x is None or x != x else f"{x:.3g}"


def bold_best(cells: list[str], means: list[float | None]) -> list[str]:
    """The first cell of the highest mean in bold."""
    out, some = list(cells), [m for m in means if m is not None and not math.isnan(m)]
    if some:
        best = means.index(max(some))
        out[best] = f"**{out[best]}**"
    return out


def table(head: list[str], rows: Iterable[list[str]]) -> list[str]:
    line = lambda x: "| " + " | ".join(x) + " |"
    return [line(head), "|" + "|".join(["---"] * len(head)) + "|", *map(line, rows), ""]


def folded(summary: str, inner: list[str], is_open: bool = False) -> list[str]:
    return [f"<details{' open' if is_open else ''}>", f"<summary><b>{summary}</b></summary>", "", *inner, "</details>", ""]


def run_spec(spec: str) -> tuple[str, str]:
    """``label=path``."""
    label, eq, path = spec.partition("=")
    if not eq or not label.strip():
        raise ValueError(f"a run is given as label=path, not as {spec!r}")
    return label.strip(), path.strip()


def backend_text(record: dict | None) -> str:
    """A run's model, adapters and parser in a line."""
    if not record:
        return "(unknown)"
    llm = record.get("llm") or {}
    parts = [f"model=`{llm.get('model') or '?'}`"]
    if adapters := sorted(set((llm.get("step_lora_map") or {}).values())):
        parts.append(f"LoRA adapters=[{', '.join(adapters)}]")
    if record.get("parser_image"):
        parts.append(f"parser=`{record['parser_image']}`")
    return " · ".join(parts)


def tokens_text(total: dict, per_doc: dict | None = None) -> str:
    """A section's tokens in a line; '' where none were used."""
    n = lambda k: int(total.get(k) or 0)
    if not any(map(n, ("prompt_tokens", "completion_tokens", "total_tokens", "n_calls"))):
        return ""
    more = []
    if per_doc and per_doc.get("total_tokens") is not None:
        more.append(f"{kilo(round(per_doc['total_tokens']))} total/doc")
    if per_doc and per_doc.get("n_calls") is not None:
        more.append(f"{per_doc['n_calls']:.1f} calls/doc")
    return f"LLM tokens: {kilo(n('prompt_tokens'))} prompt / {kilo(n('completion_tokens'))} completion / {kilo(n('total_tokens'))} total, {n('n_calls')} calls" + (f" · {' · '.join(more)}" if more else "")


def errors_text(errors: list[dict]) -> list[str]:
    """How many documents were left out, and why."""
    if not errors:
        return []
    kinds = Counter(str(e.get("error") or "").split(":", 1)[0] or "unknown" for e in errors)
    return [f"> **Heads up:** {len(errors)} document(s) skipped due to errors ({', '.join(f'{k}={n}' for k, n in sorted(kinds.items()))}). See `errors.json` for details.", ""]


def scored(pairs: DataFrame) -> DataFrame:
    """(section, metric, n, a, b, delta, p): all that a report shows of two systems'
    values (corpus, record_id, metric, a, b)."""
    n = pairs.groupBy("corpus").agg(F.count_distinct("record_id").alias("n"))
    n = n.select(F.col("corpus").alias("section"), "n").unionByName(n.agg(F.lit("overall").alias("section"), F.sum("n").alias("n")))
    j = S.sections(pairs).join(S.section_tests(pairs), ["section", "metric"]).join(n, "section")
    return j.select("section", "metric", "n", F.col("ci_a").alias("a"), F.col("ci_b").alias("b"), "delta", "p")


def _sections(rows: list, metrics: list[str]) -> list[tuple[str, int, list]]:
    names = sorted({r["section"] for r in rows}, key=lambda s: (s != "overall", s))
    by = {(r["section"], r["metric"]): r for r in rows}
    return [(s, next(r["n"] for r in rows if r["section"] == s), [by[s, m] for m in metrics if (s, m) in by]) for s in names]


def report(scores: DataFrame, metrics: list[str], title: str = "Benchmark report", baseline: DataFrame | None = None, tokens: DataFrame | None = None, record: dict | None = None, errors: list[dict] | None = None) -> str:
    """The report of one run from :func:`scored` (a: the model's system, b: the
    parser's), perhaps with a comparison to a run before (section, metric, delta, p)
    and token totals by section and group (section, group, prompt_tokens,
    completion_tokens, total_tokens, n_calls; group NULL for the section's)."""
    out = [f"# {title}", ""]
    facts = [("LLM model", (record or {}).get("llm", {}).get("model")), ("Parser image", (record or {}).get("parser_image"))]
    out += [f"- **{k}:** {v}" for k, v in facts if v] + ([""] if any(v for _, v in facts) else [])
    out += errors_text(errors or [])
    before = {(r["section"], r["metric"]): r for r in baseline.collect()} if baseline is not None else {}
    used = {(r["section"], r["group"]): r.asDict() for r in tokens.collect()} if tokens is not None else {}
    for section, n, rows in _sections(scores.collect(), metrics):
        text = tokens_text(used.get((section, None), {}))
        groups = any(s == section and g for s, g in used)
        head = ["Metric", "Parser (95% CI)", "Model (95% CI)", "Δ", "p"] + (["Δ vs baseline", "p vs baseline"] if before else []) + (["Prompt tok", "Completion tok"] if groups else [])
        lines = []
        for r in rows:
            line = [r["metric"], cell(*r["b"]), cell(*r["a"]), signed(r["delta"]), p_value(r["p"])]
            if before:
                b = before.get((section, r["metric"]))
                line += [signed(b["delta"]), p_value(b["p"])] if b else ["n/a", "n/a"]
            if groups:
                g = used.get((section, TOKEN_GROUPS.get(r["metric"], "other")))
                line += [kilo(g["prompt_tokens"]), kilo(g["completion_tokens"])] if g else ["—", "—"]
            lines.append(line)
        out += folded(f"{section} (N={n})" + (f" — {text}" if text else ""), table(head, lines), section == "overall")
    if used:
        rows = [(g or "all", r) for (s, g), r in sorted(used.items(), key=lambda x: str(x[0])) if s == "overall"]
        names = ("prompt_tokens", "completion_tokens", "total_tokens", "n_calls")
        out += folded("Tokens", table(["Group", "Prompt", "Completion", "Total", "n_calls"], [[g, *(str(int(r.get(k) or 0)) for k in names)] for g, r in rows]))
    return "\n".join(out)


def side_by_side(runs: dict[str, DataFrame], metrics: list[str], title: str = "Benchmark report, side by side", records: dict[str, dict | None] | None = None) -> str:
    """Several runs by label, each from :func:`scored`, in one table; the best model
    of a row is bold."""
    labels = list(runs)
    read = {k: {(r["section"], r["metric"]): r for r in df.collect()} for k, df in runs.items()}
    out = [f"# {title}", ""]
    if records:
        out += ["**Backends:**", "", *(f"- `{k}` — {backend_text(records.get(k))}" for k in labels), ""]
    for section, n, rows in _sections(list(read[labels[0]].values()), metrics):
        lines = []
        for r in rows:
            own = [read[k].get((section, r["metric"])) for k in labels]
            cells = bold_best([cell(*x["a"]) if x else "n/a" for x in own], [x["a"]["mean"] if x else None for x in own])
            lines.append([r["metric"], cell(*r["b"]), *cells, *(signed(x["delta"] if x else None) for x in own)])
        out += folded(f"{section} (N={n})", table(["Metric", "Parser", *labels, *(f"Δ({k})" for k in labels)], lines), section == "overall")
    return "\n".join(out)


def root_cause_rules(pred: str = "pred", gold: str = "gold", metrics: str = "metrics") -> dict[str, Column]:
    """What may be wrong with a prediction, as predicates."""
    p, g = (lambda n: T.text_of(F.col(f"{pred}.{n}"))), (lambda n: T.text_of(F.col(f"{gold}.{n}")))
    none = lambda n: F.size(F.coalesce(F.col(f"{pred}.{n}"), F.array().cast("array<string>"))) == 0
    noise = lambda a: F.lower(a).rlike("orcid|http|univers|institute")
    return {
        "missing or empty title": T.normalize_text(p("title")) == "",
        "title with more lines than its own": F.length(p("title")) > F.greatest(F.lit(1.0), F.length(g("title")) * 1.5),
        "title cut off": F.length(p("title")) < F.greatest(F.lit(10.0), F.length(g("title")) * 0.6),
        "authors missing": none("authors"),
        "affiliations among the authors": F.exists(F.coalesce(F.col(f"{pred}.authors"), F.array().cast("array<string>")), noise),
        "abstract missing": T.normalize_text(p("abstract")) == "",
        "abstract cut off": F.length(p("abstract")) < F.greatest(F.lit(20.0), F.length(g("abstract")) * 0.3),
        "keywords missing": none("keywords"),
        "keywords partly found": F.coalesce(F.col(f"{metrics}.keywords_recall"), F.lit(1.0)) < 0.5,
        "publisher, date or rights empty": (p("publisher") == "") | (p("date") == "") | (p("rights") == ""),
        "another language": F.coalesce(F.col(f"{metrics}.language_match") == 0, F.lit(False)),
        "identifiers missing": none("identifiers"),
    }


def root_causes(documents: DataFrame, pos: str = "pos", most: int = 2) -> DataFrame:
    """(rule, record_id, gold, pred): the first documents that each rule applies to."""
    found = S.examples(documents, root_cause_rules(), F.col(pos), most)
    return found.select("rule", "record_id", F.to_json("gold").alias("gold"), F.to_json("pred").alias("pred"))


def root_cause_report(documents: DataFrame, summary: dict[str, float], title: str = "Root causes") -> str:
    """The same as text, with the means of the metrics."""
    out = [f"# {title}", "", ", ".join(f"{k}~{v:.3f}" for k, v in summary.items()), ""]
    found = root_causes(documents).collect()
    for rule in root_cause_rules():
        own = [r for r in found if r["rule"] == rule]
        if own:
            out += [f"## {rule}", *(f"- {r['record_id']}: gold={_short(r['gold'])} pred={_short(r['pred'])}" for r in own), ""]
    return "\n".join(out)


def _short(text: str, most: int = 160) -> str:
    text = json.dumps(json.loads(text), ensure_ascii=False)
    return text if len(text) <= most else text[: most - 3] + "..."


def case_text(record_id: str, metric: str, gold: object, sides: dict[str, tuple[float | None, object]]) -> str:
    """One drill-down record: each system's score, and how its value differs from
    the gold one."""
    out = [f"record_id : {record_id}"]
    for label, (score, value) in sides.items():
        shown = "n/a" if score is None else f"{score:.3f}"
        diff = S.word_diff(gold, value) if isinstance(gold or value, str) else f"{gold!r} -> {value!r}"
        out.append(f"  {label} : {metric}={shown} | {diff}")
    return "\n".join(out)


def pred_key(metrics_key: Column) -> Column:
    """The name of a system's predictions, from that of its metrics."""
    return F.concat(F.regexp_replace(metrics_key, "_metrics$", ""), F.lit("_pred"))


def label_of(pred_name: Column) -> Column:
    return F.regexp_replace(pred_name, "_pred$", "")
