"""Declarative rules compiled to columns. All rules of one kind over one table are one aggregate, whatever their number."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import to_double, to_text, to_time, zip3
from ..spec import Bound, GroupRule, Rule
from .profile import pearson_expr

WEIGHTS = {"CRITICAL": 4.0, "HIGH": 3.0, "MEDIUM": 2.0, "LOW": 1.0}
ISSUE = "severity string, check string, detail string"


def band(rate: Column, critical: float, high: float) -> Column:
    return F.when(rate > critical, "CRITICAL").when(rate > high, "HIGH").otherwise("MEDIUM")


def group_mask(column: str, spec: Any) -> Column:
    """Membership of a group: a value compared as text, None for null, or {op: value} with ==, !=, in, not_in."""
    c = F.col(column)
    if spec is None:
        return c.isNull()
    text = to_text(c)
    if not isinstance(spec, Mapping):
        return text == F.lit(str(spec))
    masks = []
    for op, value in spec.items():
        if op in ("in", "not_in"):
            inside = text.isin(*(str(v) for v in value))
            masks.append(inside if op == "in" else ~inside)
        elif op in ("==", "!="):
            masks.append(text == str(value) if op == "==" else text != str(value))
        else:
            raise ValueError(f"group operator {op!r} is not known")
    return reduce(lambda a, b: a & b, masks)


def violated(rule: Rule) -> Column:
    """True where the row breaks the rule; never null. A null, or a value that is no number where one is compared, breaks it unless nulls are ignored."""
    c, x, v = F.col(rule.column), to_double(F.col(rule.column)), rule.value
    compare = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b}
    if rule.operator in compare:
        held, known = compare[rule.operator](x, F.lit(float(v))), x.isNotNull()
    elif rule.operator == "between":
        held, known = x.between(float(v[0]), float(v[1])), x.isNotNull()
    elif rule.operator in ("in", "not_in"):
        inside = to_text(c).isin(*(str(i) for i in v))
        held, known = inside if rule.operator == "in" else ~inside, c.isNotNull()
    else:
        raise ValueError(f"rule operator {rule.operator!r} is not known")
    if rule.nulls == "ignore":
        return F.coalesce(known & ~held, F.lit(False))
    return F.coalesce(~held, F.lit(True))


def _present(df: DataFrame, rules: Sequence, *fields: str) -> list:
    """Rules all of whose columns the table has: a plan-time choice."""
    have = set(df.columns)
    return [r for r in rules if all(getattr(r, f) in have for f in fields)]


def bounds_check(df: DataFrame, bounds: Sequence[Bound]) -> DataFrame:
    """column, n, n_out, rate, severity. Rates are of the values that are numbers."""
    live = _present(df, bounds, "column")
    aggs = []
    for i, b in enumerate(live):
        x = to_double(F.col(b.column))
        out = F.lit(False)
        if b.low is not None:
            out = out | (x < b.low)
        if b.high is not None:
            out = out | (x > b.high)
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(out).alias(f"o{i}")]
    rows = F.array(*(F.struct(F.lit(b.column).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"o{i}").alias("n_out")) for i, b in enumerate(live)))
    flat = df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")
    rate = F.coalesce(F.try_divide(F.col("n_out").cast("double"), F.col("n")), F.lit(0.0))
    return flat.withColumn("rate", rate).withColumn("severity", F.when(F.col("n_out") > 0, band(F.col("rate"), 0.10, 0.02)))


def rule_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, severity, n_total, n_violated, rate. The rate's base is all rows."""
    live = _present(df, rules, "column")
    one = df.agg(F.count("*").alias("t"), *(F.count_if(violated(r)).alias(f"v{i}") for i, r in enumerate(live)))
    rows = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col("t").alias("n_total"), F.col(f"v{i}").alias("n_violated")) for i, r in enumerate(live)))
    return one.select(F.explode(rows).alias("r")).select("r.*").withColumn("rate", F.coalesce(F.try_divide(F.col("n_violated").cast("double"), F.col("n_total")), F.lit(0.0)))


def violation_samples(df: DataFrame, rules: Sequence[Rule], key: Sequence[str], n: int = 3) -> DataFrame:
    """rule, sample: the n least row keys that break each rule, kept in a bounded buffer while rows stream by."""
    live = _present(df, rules, "column")
    broken = F.array_compact(F.array(*(F.when(violated(r), F.struct(F.lit(r.name).alias("rule"), F.col(r.column).cast("string").alias("value"))) for r in live)))
    hit = df.select(F.explode(broken).alias("b"), *key).select("b.rule", "b.value", *key)
    from pyspark.sql import Window

    w = Window.partitionBy("rule").orderBy(*key)
    return hit.withColumn("at", F.row_number().over(w)).where(F.col("at") <= n)  # the planner limits each group before the shuffle


def plausibility_score(violations: DataFrame) -> DataFrame:
    """One row: score = 100 * (1 - weighted mean of the rates), 100 without rules."""
    w = F.coalesce(*(F.when(F.col("severity") == k, F.lit(v)) for k, v in WEIGHTS.items()), F.lit(1.0))
    return violations.agg(F.coalesce(F.round(100 * (1 - F.try_divide(F.sum(w * F.col("rate")), F.sum(w))), 2), F.lit(100.0)).alias("score"))


def prevalence(df: DataFrame, column: str, value: Any, low: float, high: float, extreme: tuple[float, float] = (0.02, 0.50)) -> DataFrame:
    """value, rate, severity: the share of a target value; null severity inside [low, high]."""
    one = df.agg(F.avg((to_text(F.col(column)) == str(value)).cast("double")).alias("rate"))
    r = F.col("rate")
    return one.select(F.lit(str(value)).alias("value"), r, F.when((r < low) | (r > high), F.when((r < extreme[0]) | (r > extreme[1]), "HIGH").otherwise("MEDIUM")).alias("severity"))


def group_comparison(df: DataFrame, rules: Sequence[GroupRule]) -> DataFrame:
    """rule, severity, a, b, violated for all rules in one pass; rules with an empty side are left out.

    A share's base includes rows whose metric is null; a mean's does not.
    """
    live = _present(df, rules, "group_column", "metric_column")
    aggs = []
    for i, r in enumerate(live):
        x = to_double(F.col(r.metric_column)) if r.metric_type == "mean" else to_text(F.col(r.metric_column)).isin(*(str(v) for v in r.proportion_values)).cast("double")
        aggs += [F.avg(F.when(group_mask(r.group_column, g), x)).alias(f"{k}{i}") for k, g in (("a", r.group_a), ("b", r.group_b))]
    rows = []
    for i, r in enumerate(live):
        a, b = F.col(f"a{i}"), F.col(f"b{i}")
        broken = {">": a <= b, ">=": a < b, "<": a >= b, "<=": a > b}.get(r.expected_direction, F.lit(False))
        rows.append(F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), a.alias("a"), b.alias("b"), broken.alias("violated")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("a IS NOT NULL AND b IS NOT NULL")


def expected_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], least_n: int = 30) -> DataFrame:
    """col_a, col_b, n, r, violated (r < 0) of pairs that should go together; fewer than least_n rows are left out."""
    have = set(df.columns)
    live = [p for p in pairs if have.issuperset(p)]
    aggs = []
    for i, (a, b) in enumerate(live):
        x, y = to_double(F.col(a)), to_double(F.col(b))
        aggs += [F.count_if(x.isNotNull() & y.isNotNull()).alias(f"n{i}"), pearson_expr(x, y).alias(f"r{i}")]
    rows = F.array(*(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(live)))
    return df.agg(*aggs).select(F.explode(rows).alias("p")).select("p.*").where(f"n >= {least_n} AND r IS NOT NULL").withColumn("violated", F.col("r") < 0)


def seed_drift(seed: DataFrame, synth: DataFrame, least: float = 0.20) -> DataFrame:
    """name, seed_value, synth_value, drift, flagged of two (name, value) metric tables; the base is floored at 1e-6."""
    a, b = seed.toDF("name", "seed_value"), synth.toDF("name", "synth_value")
    drift = F.abs(F.col("synth_value") - F.col("seed_value")) / F.greatest(F.abs("seed_value"), F.lit(1e-6))
    return a.join(b, "name").withColumn("drift", drift).withColumn("flagged", F.col("drift") > least)


def datetime_checks(df: DataFrame, column: str, low: str, high: str, end: str | None = None, month_start: bool = False, month_end: bool = False, birth_year: str | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """check, n, severity: values that do not parse, lie out of [low, high] or of years, off month borders, end before start, born after."""
    t, raw = to_time(F.col(column)), F.col(column)
    checks: dict[str, Column] = {"parse_error": raw.isNotNull() & t.isNull(), "out_of_range": (t < F.lit(low).cast("timestamp")) | (t > F.lit(high).cast("timestamp"))}
    if years:
        checks["year_out_of_range"] = ~F.year(t).between(*years)
    if month_start:
        checks["not_first_of_month"] = F.dayofmonth(t) != 1
    if month_end:
        checks["not_last_of_month"] = F.to_date(t) != F.last_day(t)
    if end:
        checks["end_before_start"] = to_time(F.col(end)) < t
    if birth_year:
        checks["born_after"] = F.col(birth_year).try_cast("int") > F.year(t)
    severity = {"parse_error": "CRITICAL", "end_before_start": "CRITICAL", "born_after": "CRITICAL", "out_of_range": "HIGH", "year_out_of_range": "HIGH"}
    one = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()))
    rows = F.array(*(F.struct(F.lit(k).alias("check"), F.col(k).alias("n"), F.when(F.col(k) > 0, F.lit(severity.get(k, "MEDIUM"))).alias("severity")) for k in checks))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def geo_check(df: DataFrame, ranges: DataFrame, area: str, code: str, is_zip: bool = False) -> DataFrame:
    """area, n, n_bad, rate, severity: rows whose code is in none of their area's [lo, hi]; unknown areas pass.

    ranges (area, lo, hi) is a fixed list of areas; it is grouped to one row per area, so a row meets its area once.
    """
    spans = ranges.groupBy(F.col("area").alias("_area")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    x = zip3(F.col(code)) if is_zip else to_double(F.col(code))
    hit = df.select(F.col(area).alias("area"), x.alias("x")).join(F.broadcast(spans), F.col("area") == F.col("_area"), "left")
    bad = F.col("spans").isNotNull() & ~F.coalesce(F.exists("spans", lambda s: F.col("x").between(s["lo"], s["hi"])), F.lit(False))
    out = hit.groupBy("area").agg(F.count("*").alias("n"), F.count_if(bad).alias("n_bad"))
    return out.withColumn("rate", F.col("n_bad") / F.col("n")).withColumn("severity", F.when(F.col("n_bad") > 0, band(F.col("rate"), 0.10, 0.02)))


def id_checks(df: DataFrame, column: str) -> DataFrame:
    """duplicate_rate, n_bad_length, n_not_hex of an identifier of 32 hexadecimal digits; duplicates are counted per value first."""
    c = F.col(column).cast("string")
    per = df.groupBy(c.alias("id")).agg(F.count("*").alias("n"))
    return per.agg(
        (1 - F.count("id") / F.sum(F.when(F.col("id").isNotNull(), F.col("n")))).alias("duplicate_rate"),
        F.sum(F.when(F.length("id") != 32, F.col("n")).otherwise(0)).alias("n_bad_length"),
        F.sum(F.when(~F.col("id").rlike("^[0-9a-f]*$"), F.col("n")).otherwise(0)).alias("n_not_hex"),
    )


def row_count_check(df: DataFrame, expected: int) -> DataFrame:
    return df.agg(F.count("*").alias("n")).withColumn("severity", F.when(F.col("n") != expected, F.lit("HIGH")))


def schema_check(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Issues: CRITICAL for each missing column, LOW for each extra one. No job reads the data."""
    have = list(df.columns)
    rows = [("CRITICAL", "schema", f"missing column {c}") for c in expected if c not in have] + [("LOW", "schema", f"extra column {c}") for c in have if c not in expected]
    return df.sparkSession.createDataFrame(rows, ISSUE)
