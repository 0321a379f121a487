"""Reports: issue relations, stats profiles, HTML and console tables. All inputs have a row per column, rule or check."""

from __future__ import annotations

import html
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import TableSpec
from . import profile as P

RANK = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2, "LOW": 3}


def union_issues(frames: Sequence[DataFrame]) -> DataFrame:
    """(severity, check, detail) of all checks; rows without a severity are no issues."""
    return reduce(lambda a, b: a.unionByName(b), frames).where("severity IS NOT NULL")


def as_issues(df: DataFrame, check: str, detail: str) -> DataFrame:
    """Issues from a check's result with a severity; detail is a Spark SQL expression."""
    return df.select("severity", F.lit(check).alias("check"), F.expr(detail).cast("string").alias("detail"))


def by_severity(issues: DataFrame) -> DataFrame:
    """Issues, the gravest first."""
    return issues.orderBy(F.coalesce(*(F.when(F.col("severity") == k, F.lit(v)) for k, v in RANK.items()), F.lit(9)), "check", "detail")


def severity_counts(issues: DataFrame) -> dict[str, int]:
    got = {r["severity"]: r["count"] for r in issues.groupBy("severity").count().collect()}
    return {k: got.get(k, 0) for k in RANK} | {"total": sum(got.values())}


def build_profile(df: DataFrame, spec: TableSpec | None = None, quantile: str = "exact") -> dict[str, Any]:
    """The stats profile of a table as one document. Every part is a small result of one pass over its columns."""
    types = {r["column"]: r["semantic_type"] for r in P.infer_types(df).collect()}
    if spec is None:
        spec = TableSpec.from_types(df, types)
    cats = [c for c in (*spec.categorical, *((spec.target,) if spec.target and spec.target not in spec.categorical else ())) if c in df.columns]
    nums = [c for c in spec.numeric if c in df.columns]
    base = {r["column"]: r for r in P.base_stats(df, df.columns, exact=False).collect()}
    out: dict[str, Any] = {
        "meta": {"n_rows": df.count(), "n_columns": len(df.columns), "column_names": df.columns, "column_types": types, "numeric_columns": nums, "categorical_columns": cats, "datetime_columns": [c for c in spec.datetime if c in df.columns], "boolean_columns": [c for c in spec.boolean if c in df.columns]},
        "columns": {c: {"dtype": t, "semantic_type": types[c], "n_total": base[c]["n_total"], "n_non_null": base[c]["n_non_null"], "n_unique": base[c]["n_unique"]} for c, t in df.dtypes},
        "missing": {r["column"]: {"count": r["count"], "rate": r["rate"]} for r in P.missingness(df, df.columns).collect()},
        "correlations": {},
        "multivariate": {},
    }
    if nums:
        for r in P.numeric_summary(df, nums, quantile).collect():
            out["columns"][r["column"]] |= {k: r[k] for k in ("min", "max", "mean", "median", "std", "variance", "skewness", "kurtosis")}
        for r in P.quantiles(df, nums, method=quantile).collect():
            out["columns"][r["column"]].setdefault("quantiles", {})[f"p{round(r['prob'] * 100)}"] = r["value"]
        for r in P.best_distributions(df, [c for c in nums if types[c] == "float"]).collect() if any(types[c] == "float" for c in nums) else []:
            out["columns"][r["column"]]["best_fit"] = {"distribution": r["distribution"], "aic": r["aic"]}
        if len(nums) > 1:
            r_ = [r.asDict() for r in P.pearson_pairs(df, nums).collect()]
            out["correlations"]["pearson"] = {a: {r["col_b"] if r["col_a"] == a else r["col_a"]: r["r"] for r in r_ if a in (r["col_a"], r["col_b"])} for a in nums}
            out["multivariate"]["pca"] = [r.asDict() for r in P.pca(df, nums).collect()]
    if cats:
        for r in P.frequency_table(df, cats).collect():
            out["columns"][r["column"]].setdefault("frequency_table", {})[r["value"]] = {"count": r["count"], "proportion": r["proportion"]}
        for r in P.mode_and_entropy(df, cats).collect():
            out["columns"][r["column"]] |= {"mode": r["mode"], "mode_frequency": r["mode_frequency"], "entropy_nats": r["entropy_nats"], "entropy_bits": r["entropy_bits"]}
        if len(cats) > 1:
            pairs = [(a, b) for i, a in enumerate(cats) for b in cats[i + 1 :]]
            out["correlations"]["cramers_v"] = [r.asDict() for r in P.cramers_v(df, pairs).collect()]
    for c in out["meta"]["datetime_columns"]:
        one = P.datetime_stats(df.withColumn(c, F.col(c).try_cast("timestamp")), c).first()
        out["columns"][c] |= one.asDict() if one else {}
    if out["meta"]["boolean_columns"]:
        for r in P.boolean_rates(df, out["meta"]["boolean_columns"]).collect():
            out["columns"][r["column"]] |= {"true_rate": r["true_rate"], "false_rate": r["false_rate"]}
    return out


def coverage_duration(df: DataFrame, start: str, end: str) -> DataFrame:
    """n, min, max, mean, median, p25, p75 of the whole days from start to end, to one digit; rows without either date are left out."""
    days = df.select(F.datediff(F.col(end).try_cast("date"), F.col(start).try_cast("date")).cast("double").alias("days"))
    one = days.agg(F.count("days").alias("n"), *(F.round(f("days"), 1).alias(name) for f, name in ((F.min, "min"), (F.max, "max"), (F.avg, "mean"))))
    found = P.quantiles(days, ["days"], (0.25, 0.5, 0.75))
    middle = found.agg(*(F.round(F.max(F.when(F.abs(F.col("prob") - p) < 1e-9, F.col("value"))), 1).alias(name) for p, name in ((0.5, "median"), (0.25, "p25"), (0.75, "p75"))))
    return one.crossJoin(middle)  # one row each


def synthetic_profile(df: DataFrame, spec: TableSpec, duration: tuple[str, str] | None = None, top: int = 10) -> dict[str, Any]:
    """What an auditor is told of a synthetic table: missing rates, the commonest shares, dates, coverage in days, associations, group sizes."""
    from .privacy import k_anonymity

    cats = [c for c in spec.categorical if c in df.columns]
    gone = {r["column"]: r["rate"] for r in P.missingness(df, df.columns).collect()}
    out: dict[str, Any] = {"n_rows": df.count(), "n_columns": len(df.columns), "missing_rates": {c: gone.get(c, 0.0) for c in df.columns}, "columns": {}}
    if cats:
        n = {r["column"]: r["n_unique"] for r in P.base_stats(df, cats).collect()}
        out["columns"] = {c: {"type": "categorical", "n_unique": n[c], "top_proportions": {}} for c in cats}
        for r in P.frequency_table(df, cats, top).collect():
            out["columns"][r["column"]]["top_proportions"][r["value"]] = round(r["proportion"], 4)
    nums = [c for c in spec.numeric if c in df.columns]
    for r in P.numeric_summary(df, nums).collect() if nums else []:
        out["columns"][r["column"]] = {"type": "numeric"} | {k: r[k] for k in ("min", "max", "mean", "median", "std")}
    if duration and all(c in df.columns for c in duration):
        out["coverage_duration_days"] = {k: v for k, v in coverage_duration(df, *duration).first().asDict().items() if k != "n"}
    if len(cats) > 1:
        out["cramers_v"] = {f"{r['col_a']}__{r['col_b']}": round(r["v"], 4) for r in P.cramers_v(df, [(a, b) for i, a in enumerate(cats) for b in cats[i + 1 :]]).collect()}
    qi = [c for c in spec.quasi_ids if c in df.columns]
    if len(qi) > 1:
        out["k_anonymity"] = {"quasi_ids": qi} | k_anonymity(df, qi).first().asDict()
    return out


def ab_report(a: DataFrame, b: DataFrame, config: Mapping[str, Any], sizes: Mapping[str, int]) -> dict[str, Any]:
    """One document of an A/B comparison: settings, row counts, the (metric, value) scores of either side, and who wins each."""
    from .drift import ab_tally

    listed = lambda df: {r["metric"]: r["value"] for r in df.collect()}  # noqa: E731  a row per metric
    wins = {r["metric"]: r["winner"] for r in ab_tally(a.select("metric", "value"), b.select("metric", "value")).collect()}
    return {"config": dict(config), "n_rows": dict(sizes), "scores": {"a": listed(a), "b": listed(b)}, "winners": wins}


def console_table(rows: Sequence[Mapping[str, Any]], columns: Sequence[str], width: int = 40) -> str:
    """A boxed table with wrapped cells."""
    import textwrap

    cells = [[textwrap.wrap(str("" if r.get(c) is None else r[c]), width) or [""] for c in columns] for r in rows]
    wide = [max([len(c), *(len(line) for row in cells for line in row[i])]) for i, c in enumerate(columns)]
    bar = lambda a, b, c: a + b.join("─" * (w + 2) for w in wide) + c
    line = lambda parts: "│" + "│".join(f" {p:<{w}} " for p, w in zip(parts, wide, strict=True)) + "│"
    out = [bar("┌", "┬", "┐"), line(columns), bar("├", "┼", "┤")]
    for row in cells:
        for k in range(max(map(len, row))):
            out.append(line([c[k] if k < len(c) else "" for c in row]))
    return "\n".join([*out, bar("└", "┴", "┘")])


_COLOURS = {"CRITICAL": "#b00020", "HIGH": "#c75000", "MEDIUM": "#8a6d00", "LOW": "#33691e"}


def html_scorecard(title: str, score: float, sections: Mapping[str, Sequence[Mapping[str, Any]]]) -> str:
    """A page with the score and a table per section; a severity is a badge."""
    parts = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><p>Score {score:.2f} of 100</p>"]
    for name, rows in sections.items():
        columns = list(rows[0]) if rows else []
        head = "".join(f"<th>{html.escape(c)}</th>" for c in columns)
        cell = lambda c, v: f"<td><b style='color:{_COLOURS.get(v, '#000')}'>{html.escape(str(v))}</b></td>" if c == "severity" else f"<td>{html.escape('' if v is None else str(v))}</td>"
        body = "".join("<tr>" + "".join(cell(c, r[c]) for c in columns) + "</tr>" for r in rows)
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>")
    return "\n".join(parts)
