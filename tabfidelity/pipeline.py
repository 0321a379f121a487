"""The five stages from a seed table to a judged synthetic one: profile, noise, generate, validate, utility."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import assoc, drift, dp, privacy, prompts, report, rules, synth, tstr
from .sources import io
from .spec import Bound, GroupRule, Rule, TableSpec


@dataclass(frozen=True)
class RuleSet:
    """Everything a configuration says of valid rows."""

    bounds: tuple[Bound, ...] = ()
    rules: tuple[Rule, ...] = ()
    groups: tuple[GroupRule, ...] = ()
    correlations: tuple[tuple[str, str], ...] = ()

    @staticmethod
    def from_config(config: Mapping[str, Any]) -> RuleSet:
        p = config.get("plausibility", config)
        bounds = tuple(Bound(c, *(b if isinstance(b, (list, tuple)) else (b.get("min"), b.get("max")))) for c, b in (p.get("column_bounds") or {}).items())
        listed = tuple(Rule(r["name"], r["column"], r["operator"], r["value"], r.get("severity", "MEDIUM"), r.get("description", ""), r.get("nulls", "violate")) for r in p.get("rules") or ())
        groups = tuple(GroupRule(g["name"], g["group_column"], g["group_a"], g["group_b"], g["metric_column"], g["expected_direction"], g.get("metric_type", "mean"), tuple(map(str, g.get("proportion_values", ()))), g.get("severity", "MEDIUM")) for g in p.get("group_comparison_rules") or ())
        return RuleSet(bounds, listed, groups, tuple(tuple(x) if isinstance(x, (list, tuple)) else (x["a"], x["b"]) for x in p.get("correlation_pairs") or ()))


def noise_profile(spark: SparkSession, stats: Mapping[str, Any], epsilon: float, seed: int = 42, split_columns: bool = False, redact: bool = False) -> dict[str, Any]:
    """The profile with noise on proportions, moments, quantiles, missingness and correlations, and a block on what was spent.

    By default each column gets its family's whole share, so the epsilon that is truly spent is the sum in `composed_epsilon`;
    split_columns shares it out. redact leaves out what has no noise.
    """
    out = json.loads(json.dumps(stats, default=str))
    cols, n = out["columns"], max(1, int(out["meta"]["n_rows"]))
    cats = [c for c in cols if cols[c].get("frequency_table")]
    nums = [c for c in cols if cols[c].get("mean") is not None]
    gone = out.get("missing", {})
    eps = dp.split_budget(epsilon, {"proportions": len(cats), "numeric": len(nums), "missing": len(gone)} if split_columns else None)
    if cats:
        freq = spark.createDataFrame([(c, v, float(d["count"])) for c in cats for v, d in cols[c]["frequency_table"].items()], "column string, value string, count double")
        noised = dp.dp_proportions(freq, eps["proportions"], seed)
        for c in cats:
            cols[c]["frequency_table"] = {}
        for r in noised.collect():
            cols[r["column"]]["frequency_table"][r["value"]] = {"count": r["count"], "proportion": r["proportion"]}
        for r in dp.dp_modes(noised).collect():
            cols[r["column"]] |= {"mode": r["mode"], "mode_frequency": r["mode_frequency"]}
    if nums:
        table = spark.createDataFrame([(c, *(float(cols[c].get(k) or 0.0) for k in ("min", "max", "mean", "median", "std"))) for c in nums], "column string, min double, max double, mean double, median double, std double")
        for r in dp.dp_numeric(table, n, eps["numeric"], seed).collect():
            cols[r["column"]] |= {k: r[k] for k in ("mean", "median", "std")}
        q = spark.createDataFrame([(c, int(k[1:]) / 100, float(v)) for c in nums for k, v in (cols[c].get("quantiles") or {}).items()], "column string, prob double, value double")
        for r in dp.dp_quantiles(q, table.select("column", "min", "max"), n, eps["numeric"], seed).collect():
            cols[r["column"]]["quantiles"][f"p{round(r['prob'] * 100)}"] = r["value"]
        if redact:
            for c in nums:
                for k in ("variance", "skewness", "kurtosis", "best_fit", "n_unique"):
                    cols[c].pop(k, None)
            out["multivariate"] = {}
    if gone:
        m = spark.createDataFrame([(c, float(v["count"])) for c, v in gone.items()], "column string, count double")
        out["missing"] = {r["column"]: {"count": int(r["count"]), "rate": r["rate"]} for r in dp.dp_missing(m, n, eps["missing"], seed).collect()}
    pearson = out.get("correlations", {}).get("pearson")
    if pearson:
        names = list(pearson)
        pairs = spark.createDataFrame([(a, b, float(pearson[a].get(b) or 0.0)) for i, a in enumerate(names) for b in names[i + 1 :]], "col_a string, col_b string, r double")
        fixed: dict[str, dict[str, float]] = {a: {} for a in names}
        for r in dp.dp_correlations(pairs, names, n, eps["correlations"], seed).collect():
            fixed[r["col_a"]][r["col_b"]] = fixed[r["col_b"]][r["col_a"]] = r["r"]
        out["correlations"]["pearson"] = fixed
    spent = eps["proportions"] * len(cats) + 2 * eps["numeric"] * len(nums) + eps["missing"] * len(gone) + (eps["correlations"] if pearson else 0.0)
    out["dp"] = {"mechanism": "laplace", "epsilon": epsilon, "composed_epsilon": spent, "delta": 0.0, "n": n, "budget_split": dp.BUDGET, "seed": seed}
    return out


def validate(synthetic: DataFrame, seed: DataFrame, spec: TableSpec, rule_set: RuleSet = RuleSet(), k: int = 5, expected_rows: int | None = None, sample: int = privacy.SAMPLE, transactions=None, mined: DataFrame | None = None) -> dict[str, Any]:
    """Every check over one pair of tables: the issues as one relation, and the metrics behind them."""
    cats = [c for c in dict.fromkeys((*spec.categorical, *((spec.target,) if spec.target else ()))) if c in synthetic.columns and c in seed.columns]
    nums = [c for c in spec.numeric if c in synthetic.columns and c in seed.columns]
    both = [*cats, *nums]
    psi = drift.psi_report(seed, synthetic, cats, nums)
    violations = rules.rule_violations(synthetic, rule_set.rules) if rule_set.rules else None
    score = rules.plausibility_score(violations).first()["score"] if violations is not None else 100.0
    issues = [
        rules.schema_check(synthetic, spec.expected),
        report.as_issues(drift.null_rate_check(seed, synthetic, both), "null rate", "concat(column, ' ', round(synth_rate, 4))"),
        report.as_issues(drift.categorical_drift(seed, synthetic, cats), "category", "concat(column, ' = ', value, ': ', change)"),
        report.as_issues(drift.cardinality_check(seed, synthetic, cats), "cardinality", "column"),
        report.as_issues(psi.withColumn("severity", F.when(F.col("status") == "unstable", "HIGH").when(F.col("status") == "monitor", "LOW")), "psi", "concat(column, ' ', psi)"),
    ]
    if rule_set.bounds:
        issues.append(report.as_issues(rules.bounds_check(synthetic, rule_set.bounds), "bounds", "concat(column, ' ', round(rate, 4))"))
    if violations is not None:
        issues.append(report.as_issues(violations.where("n_violated > 0"), "rule", "concat(rule, ' ', n_violated)"))
    if rule_set.groups:
        issues.append(report.as_issues(rules.group_comparison(synthetic, rule_set.groups).where("violated"), "group", "rule"))
    if rule_set.correlations:
        issues.append(report.as_issues(rules.expected_correlations(synthetic, rule_set.correlations).where("violated").withColumn("severity", F.lit("MEDIUM")), "correlation", "concat(col_a, ' / ', col_b)"))
    if len(cats) > 1:
        issues.append(report.as_issues(drift.cramers_drift(seed, synthetic, [(a, b) for i, a in enumerate(cats) for b in cats[i + 1 :]]), "association", "concat(col_a, ' / ', col_b)"))
    if expected_rows is not None:
        issues.append(report.as_issues(rules.row_count_check(synthetic, expected_rows), "row count", "n"))
    metrics: dict[str, Any] = {}
    qi = [c for c in spec.quasi_ids if c in both]
    if len(qi) > 1:
        kanon, link = privacy.k_anonymity(synthetic, qi, k), privacy.record_linkage(synthetic, seed, qi)
        issues += [report.as_issues(kanon, "k-anonymity", "n_violations"), report.as_issues(link, "linkage", "round(unique_link_rate, 4)")]
        metrics |= {"k_anonymity": kanon.first().asDict(), "linkage": link.first().asDict()}
    leak = privacy.row_leakage(synthetic, seed, both)
    issues.append(report.as_issues(leak, "leakage", "n_leaked"))
    metrics["leakage"] = leak.first().asDict()
    if spec.row_key:
        mia, near = privacy.membership_inference(synthetic, seed, cats, nums, spec.row_key, sample), privacy.closest_records(synthetic, seed, cats, nums, spec.row_key, sample)
        metrics |= {"membership": mia.first().asDict(), "closest": near.first().asDict()}
        other = [c for c in cats if c not in qi]
        attribute = [privacy.attribute_disclosure(synthetic, seed, c, qi).first()["risk"] for c in other] if qi else []
        one = synthetic.sparkSession.createDataFrame([(metrics["membership"]["auc"], metrics["closest"]["dcr_ratio"], metrics["closest"]["mean_nndr"], *(metrics.get("linkage", {}).get(m) for m in ("unique_link_rate", "pct_small", "mean_group")), float(np.mean(attribute)) if attribute else 0.0)], "mia_auc double, dcr_ratio double, mean_nndr double, unique_link_rate double, pct_small double, mean_group double, attribute_risk double")
        metrics["residual_risk"] = privacy.residual_risk(one).first().asDict()
    if mined is not None and transactions is not None:
        metrics["rule_coverage"] = [r.asDict() for r in assoc.rule_coverage(transactions(synthetic), mined).collect()]
    relation = report.by_severity(report.union_issues(issues))
    return {"issues": relation, "summary": report.severity_counts(relation), "plausibility": score, "psi": [r.asDict() for r in psi.collect()], "metrics": metrics}


def utility(seed: DataFrame, synthetic: DataFrame, spec: TableSpec, kind: str = "forest", cross: int = 0, extended: Sequence[str] = ()) -> dict[str, Any]:
    """Macro F1 of the three modes and their ratio. Codes are those of the seed on both sides, of all its levels.

    cross: folds of cross-validation on either table. extended: learners to report by regime.
    """
    labels = list(spec.orders.get(spec.target, ())) or sorted(str(r[0]) for r in seed.select(spec.target).na.drop().distinct().collect())
    cats = {c: list(spec.orders.get(c, ())) or tstr.level_codes(seed, c) for c in spec.categorical if c != spec.target}
    enc = lambda df: tstr.encode(df, spec.target, labels, cats, spec.numeric, spec.row_key)
    real, made = enc(seed), enc(synthetic)
    modes = tstr.evaluate_modes(real, made, len(labels), spec.row_key, kind)
    rows = [r.asDict() for r in modes.collect()]
    table = seed.sparkSession.createDataFrame([(r["mode"], r["n"], r["accuracy"], r["macro_f1"]) for r in rows], modes.schema)
    out = {"modes": rows, "fidelity": tstr.fidelity_ratio(table).first()["fidelity"]}
    if cross:
        out["cross_validation"] = {n: tstr.cross_summary(tstr.cross_validated(d, len(labels), spec.row_key, kind, cross)).first().asDict() for n, d in (("seed", real), ("synthetic", made))}
    if extended:
        out["extended"] = [r.asDict() for r in tstr.extended_report(real, made, len(labels), spec.row_key, extended).collect()]
    return out


def run(spark: SparkSession, seed: DataFrame, spec: TableSpec, output: str, rows: int = 3000, epsilon: float = 1.0, rule_set: RuleSet = RuleSet(), seed_no: int = 42, skip_tstr: bool = False, source: str = "seed", auditor: synth.Completion | None = None, progress: Callable[[int, int], None] | None = None) -> dict[str, Any]:
    """All stages; every result is written under output, each file by the stage that made it, beside a copy of the seed.

    auditor, if given, is asked for a verdict on noised statistics and issues. progress(stages done, of) is called after each stage.

    source="seed" draws strata and matches quantiles on the seed itself, so the rows are not covered by epsilon, whatever the
    published statistics are.
    """
    if source != "seed":
        raise ValueError("only the seed can be drawn from; noised statistics are for publication")
    root = Path(output)
    tell = progress or (lambda stage, of: None)
    seed.write.mode("overwrite").parquet(str(root / "seed"))  # what the run was made from
    tell(1, 5)
    stats = report.build_profile(seed, spec)
    io.write_json(stats, str(root / "stats.json"))
    tell(2, 5)
    noised = noise_profile(spark, stats, epsilon, seed_no)
    io.write_json(noised, str(root / "stats_dp.json"))
    pearson = noised.get("correlations", {}).get("pearson", {})
    corr = np.array([[1.0 if a == b else pearson.get(a, {}).get(b) or 0.0 for b in spec.numeric] for a in spec.numeric]) if len(spec.numeric) > 1 else None
    made = synth.synthesise(spark, seed, rows, spec.target, list(dict.fromkeys((spec.target, *spec.categorical))), list(spec.numeric), corr, seed_no)
    made.write.mode("overwrite").parquet(str(root / "synthetic"))
    made = spark.read.parquet(str(root / "synthetic"))
    tell(3, 5)
    # Rows of the seed get an identifier from their place in the copy, so that every check of privacy runs.
    both = TableSpec(**{**spec.__dict__, "row_key": ("row_id",)})
    copy = spark.read.parquet(str(root / "seed")).drop("row_id").withColumn("row_id", F.monotonically_increasing_id())
    checked = validate(made, copy, both, rule_set, expected_rows=rows)
    if auditor:
        checked["audit"] = prompts.audit(auditor, noised, [r.asDict() for r in checked["issues"].collect()], report.synthetic_profile(made, spec))
    tell(4, 5)
    io.write_json({**checked, "issues": [r.asDict() for r in checked["issues"].collect()]}, str(root / "validation.json"))
    (root / "validation.html").write_text(report.html_scorecard("Plausibility", checked["plausibility"], {"Issues": [r.asDict() for r in checked["issues"].collect()], "PSI": checked["psi"]}), encoding="utf-8")
    out: dict[str, Any] = {"stats": noised, "validation": checked}
    if not skip_tstr:
        out["utility"] = utility(copy, made, both)
        io.write_json(out["utility"], str(root / "utility.json"))
    tell(5, 5)
    return out


def system_prompt(config: Mapping[str, Any], stats: Mapping[str, Any], name: str, rules_table: DataFrame | None = None, top: int = 15) -> str:
    told = [r["narrative"] for r in assoc.describe_rules(assoc.narrative_rules(rules_table, top)).collect()] if rules_table is not None else []
    listed: Sequence[Rule] = RuleSet.from_config(config).rules
    return prompts.system_prompt(name, TableSpec.from_config(config), stats, [f"{r.column} {r.operator} {r.value}" for r in listed], told)

