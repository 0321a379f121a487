"""Texts for row generators. What to say is decided by predicates over profile tables; saying it is templating on the driver, over
values with a row per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import TableSpec


def reminders(freq: DataFrame, summary: DataFrame, quantiles: DataFrame, pairs: DataFrame, target: str | None = None) -> DataFrame:
    """kind, column, value, number: what a generator must be told.

    dominant (> 70 %) and rare (< 8 %) values, columns that are zero at their median or upper quartile, |skewness| > 2, |r| > 0.35, and every share of the target.
    """
    col = F.col
    shares = freq.select("column", "value", "proportion")
    tgt = shares.where(col("column") == F.lit(target)).select(F.lit("target").alias("kind"), "column", "value", col("proportion").alias("number"))
    other = shares.where(col("column") != F.lit(target or "")).select(F.when(col("proportion") > 0.70, "dominant").when(col("proportion") < 0.08, "rare").alias("kind"), "column", "value", col("proportion").alias("number")).where("kind IS NOT NULL")
    q = quantiles.groupBy("column").agg(F.max(F.when(F.abs(col("prob") - 0.5) < 1e-9, col("value"))).alias("p50"), F.max(F.when(F.abs(col("prob") - 0.75) < 1e-9, col("value"))).alias("p75"))
    num = summary.join(q, "column").select(F.when((col("p50") == 0) & (col("p75") == 0), "mostly_zero").when(col("p50") == 0, "half_zero").when(F.abs("skewness") > 2, "skewed").alias("kind"), "column", F.lit(None).cast("string").alias("value"), col("skewness").alias("number")).where("kind IS NOT NULL")
    cor = pairs.where(F.abs("r") > 0.35).select(F.when(col("r") > 0, "positive").otherwise("inverse").alias("kind"), col("col_a").alias("column"), col("col_b").alias("value"), col("r").alias("number"))
    return tgt.unionByName(other).unionByName(num).unionByName(cor)


def diversity_hints(freq: DataFrame, summary: DataFrame, quantiles: DataFrame, target: str | None = None) -> DataFrame:
    """kind, column, value, number: numbers clustered in a quarter of their range, and values with 3 to 20 % of rows."""
    col = F.col
    some = freq.where((col("column") != F.lit(target or "")) & (col("proportion") > 0.03) & (col("proportion") < 0.20)).select(F.lit("include").alias("kind"), "column", "value", col("proportion").alias("number"))
    q = quantiles.groupBy("column").agg(*(F.max(F.when(F.abs(col("prob") - p) < 1e-9, col("value"))).alias(n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))))
    spread = summary.join(q, "column").withColumn("share", F.try_divide(col("p75") - col("p25"), col("max") - col("min")))
    zero = (col("p50") == 0) & (col("p75") == 0)
    return some.unionByName(spread.where(~zero & (col("share") < 0.25)).select(F.lit("spread").alias("kind"), "column", F.lit(None).cast("string").alias("value"), col("share").alias("number")))


def top_pairs(pairs: DataFrame, n: int = 10) -> DataFrame:
    """The n unordered pairs with the greatest |r|."""
    one = pairs.select(F.least("col_a", "col_b").alias("col_a"), F.greatest("col_a", "col_b").alias("col_b"), "r").dropDuplicates(["col_a", "col_b"])
    return one.orderBy(F.desc(F.abs("r")), "col_a", "col_b").limit(n)


def exemplars(df: DataFrame, target: str, numeric: Sequence[str], key: Sequence[str], n: int = 2) -> DataFrame:
    """The n most and least typical rows of each class by mean |z|. Rows are real: off unless asked for."""
    w = Window.partitionBy(target)
    z = sum((F.abs((F.col(c) - F.avg(c).over(w)) / (F.stddev_samp(c).over(w) + 1e-9)) for c in numeric), F.lit(0.0)) / len(numeric)
    scored = df.withColumn("mean_abs_z", z)
    near, far = Window.partitionBy(target).orderBy("mean_abs_z", *key), Window.partitionBy(target).orderBy(F.desc("mean_abs_z"), *key)
    a = scored.withColumn("at", F.row_number().over(near)).where(F.col("at") <= n).withColumn("kind", F.lit("typical"))
    b = scored.withColumn("at", F.row_number().over(far)).where(F.col("at") <= n).withColumn("kind", F.lit("extreme"))
    return a.unionByName(b)


def _say(kind: str, column: str, value: str | None, x: float) -> str:
    return {
        "target": f"{column} is {value} in {x:.0%} of rows; keep this share.",
        "dominant": f"{column} is {value} in about {x:.0%} of rows; other values stay scarce.",
        "rare": f"{column} is {value} in only about {x:.0%} of rows; it must still occur.",
        "mostly_zero": f"{column} is 0 in over three quarters of rows.",
        "half_zero": f"{column} is 0 in over half of rows.",
        "skewed": f"{column} has a long tail (skewness {x:.1f}): most values near the median, few extremes.",
        "positive": f"{column} rises with {value} (r = {x:+.2f}).",
        "inverse": f"{column} falls as {value} rises (r = {x:+.2f}).",
        "include": f"Have {column} = {value} in about {x:.0%} of rows.",
        "spread": f"Spread {column} over its whole range.",
    }[kind]


def render_lines(rows: DataFrame, title: str) -> str:
    """Reminder or diversity rows as a list under a title."""
    got = sorted((r["kind"], r["column"], r["value"] or "", r["number"]) for r in rows.collect())
    return "\n".join([title, *(f"- {_say(k, c, v, x)}" for k, c, v, x in got)])


def system_prompt(name: str, spec: TableSpec, stats: Mapping[str, Any], rules: Sequence[str] = (), narratives: Sequence[str] = ()) -> str:
    """Role, task, schema table, rules, narratives, missingness and output form. stats should be noised statistics."""
    rows = []
    for c in spec.expected:
        s = stats.get("columns", {}).get(c, {})
        freq = s.get("frequency_table", {})
        if freq:
            note = ", ".join(f"{v} ({d['proportion']:.0%})" for v, d in sorted(freq.items(), key=lambda x: -x[1]["proportion"])[:6])
        elif s.get("min") is not None:
            middle = "median" if abs(s.get("skewness") or 0) > 2 else "mean"
            note = f"{s['min']:g} to {s['max']:g}, {middle} {s.get(middle, 0):g}"
        else:
            note = ""
        gone = stats.get("missing", {}).get(c, {}).get("rate", 0)
        rows.append(f"| {c} | {'categorical' if c in spec.categorical else 'numeric'} | {note}{f'; {gone:.0%} missing' if gone > 0.005 else ''} |")
    parts = [
        f"# Role\nYou write synthetic {name} rows with the same statistics as the described table.",
        "# Task\nWrite the number of rows that the message asks for.",
        "# Schema\n| Column | Kind | Notes |\n| --- | --- | --- |\n" + "\n".join(rows) + f"\n\nColumn order: {','.join(spec.expected)}",
    ]
    if rules:
        parts.append("# Rules\n" + "\n".join(f"- {r}" for r in rules))
    if narratives:
        parts.append("# Observed patterns\n" + "\n".join(f"- {r}" for r in narratives))
    parts.append("# Output\nCSV lines only: no header, no fences, no comment; a missing cell is empty.")
    return "\n\n".join(parts)


def archetypes(config: Mapping[str, Any], stats: Mapping[str, Any], target: str | None) -> list[dict[str, str]]:
    """The configured profiles, or one for each value of the target."""
    given = config.get("generation", {}).get("archetypes")
    if given:
        return [dict(a) for a in given]
    freq = stats.get("columns", {}).get(target or "", {}).get("frequency_table", {})
    return [{"name": f"{target} = {v}", "description": f"Rows whose {target} is {v}, with the spread seen among them."} for v in freq] or [{"name": "general", "description": "The whole table."}]


def user_message(batch: int, size: int, kinds: Sequence[Mapping[str, str]], lines: Sequence[str] = ()) -> str:
    """A batch's request; kinds take turns."""
    a = kinds[(batch - 1) % len(kinds)]
    return "\n".join([f"Batch {batch}. Profile: {a['name']}. {a['description'].strip()}", *lines, f"Write exactly {size} rows."])


def stratified_message(rows: Sequence[Mapping[str, Any]], spec: TableSpec) -> str:
    """A template line per row, with `___` for the numbers to fill in."""
    fixed = {*spec.categorical, spec.target}
    line = lambda r: ",".join(str(r.get(c, "") or "") if c in fixed else "___" for c in spec.expected)
    return "\n".join(["Fill in every ___ and leave all else as it is:", *map(line, rows)])


def template_lines(strata: DataFrame, spec: TableSpec) -> DataFrame:
    """row_id and template of each stratum, as a plan."""
    fixed = {*spec.categorical, spec.target}
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) if c in fixed and c in strata.columns else F.lit("___") for c in spec.expected]
    return strata.select("row_id", F.concat_ws(",", *cells).alias("template"))


def audit_prompt(noised_stats: Mapping[str, Any], issues: Sequence[Mapping[str, Any]]) -> str:
    """A request for an auditor's verdict as JSON; it sees noised statistics only."""
    import json

    return "\n".join(["Judge this synthetic table. Answer with JSON: verdict, score from 0 to 100, issues (list of text).", json.dumps({"statistics": noised_stats.get("columns", {}), "issues": list(issues)}, default=str)])


def audit(complete: Callable[[str, str], str], noised_stats: Mapping[str, Any], issues: Sequence[Mapping[str, Any]], profile: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """The auditor's verdict as a document; an answer that is no JSON comes back as `error` with the answer. complete is any text source."""
    import json
    import re

    told = audit_prompt(noised_stats, issues) + (f"\nSynthetic table: {json.dumps(profile, default=str)}" if profile else "")
    answer = complete("You audit synthetic tables for quality and privacy.", told).strip()
    bare = re.sub(r"^```\w*\s*|\s*```$", "", answer)
    try:
        return json.loads(bare)
    except ValueError as e:
        return {"error": f"the answer is no JSON: {e}", "answer": answer}
