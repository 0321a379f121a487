"""Unit tests of the operators on small tables: edge cases and invariants that SQL comparisons do not show."""

import json
from math import exp

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfidelity.functions import coerce, rng, text
from tabfidelity.operators import assoc, dp, drift, privacy, profile, prompts, report, rules, synth, tstr
from tabfidelity.spec import GroupRule, Rule, TableSpec, deep_merge


def rows(df):
    return [tuple(r) for r in df.collect()]


# -- configuration


def test_deep_merge():
    base = {"a": {"x": 1, "y": [1, 2]}, "b": 1}
    assert deep_merge(base, {"a": {"y": [3]}, "c": 2}) == {"a": {"x": 1, "y": [3]}, "b": 1, "c": 2}
    assert base == {"a": {"x": 1, "y": [1, 2]}, "b": 1}
    assert deep_merge(base, {"b": {"z": 1}})["b"] == {"z": 1}


def test_declared_roles_win(spark):
    df = spark.createDataFrame([(1, "a")], "flag int, name string")
    spec = TableSpec.from_types(df, {"flag": "integer", "name": "categorical"}, categorical=("flag",))
    assert spec.categorical == ("flag", "name") and spec.numeric == ()


# -- types and profile


def test_semantic_types(spark):
    data = [(i, float(i), i % 2 == 0, f"2024-01-{i % 28 + 1:02d}", "ab"[i % 2], f"text {i}", None) for i in range(100)]
    df = spark.createDataFrame(data, "i int, f double, b boolean, d string, c string, t string, n string")
    got = {r["column"]: r["semantic_type"] for r in profile.infer_types(df).collect()}
    assert got == {"i": "integer", "f": "float", "b": "boolean", "d": "datetime", "c": "categorical", "t": "text", "n": "datetime"}


def test_profile_of_empty_constant_and_null(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (1.0, None, "a")], "c double, n double, s string")
    assert rows(profile.pearson_pairs(df, ["c", "n"])) == [("c", "n", 0, None)]
    assert rows(profile.cramers_v(df.withColumn("t", F.col("s")), [("s", "t")])) == [("s", "t", 2, 0.0)]
    got = {r["column"]: r for r in profile.numeric_summary(df, ["c", "n"]).collect()}
    assert got["c"]["std"] == 0.0 and got["n"]["mean"] is None
    empty = df.where("false")
    assert rows(profile.missingness(empty, ["c"])) == []
    assert rows(profile.frequency_table(empty, ["s"])) == []
    assert rows(profile.missingness(df, ["c", "n"])) == [("n", 2, 1.0)]


def test_entropy_and_mode_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    r = profile.mode_and_entropy(df, ["s"]).first()
    assert r["mode"] == "a" and r["entropy_bits"] == pytest.approx(1.0)


def test_student_p_and_shapiro():
    assert profile.t_two_sided(0.0, 10) == pytest.approx(1.0)
    assert profile.t_two_sided(0.632, 10) == pytest.approx(0.05, abs=2e-3)  # the table's value for 8 degrees of freedom
    assert profile.t_two_sided(1.0, 5) == 0.0 and profile.t_two_sided(None, 5) is None
    r = np.random.default_rng(3)
    w, p = profile.shapiro(r.normal(size=500))
    assert w > 0.99 and p > 0.05
    assert profile.shapiro(r.exponential(size=500))[1] < 1e-6
    assert profile.shapiro(np.ones(20)) is None and profile.shapiro(np.arange(5.0)) is None


@pytest.mark.parametrize("name", ["norm", "uniform", "expon", "lognorm", "gamma", "beta"])
def test_best_fit_finds_its_own(spark, name):
    r = np.random.default_rng(5)
    x = {"norm": r.normal(5, 2, 4000), "uniform": r.uniform(1, 2, 4000), "expon": r.exponential(3, 4000), "lognorm": r.lognormal(0, 1, 4000), "gamma": r.gamma(3, 2, 4000), "beta": r.beta(2, 5, 4000)}[name]
    got = profile.best_distributions(spark.createDataFrame([(float(v),) for v in x], "x double"), ["x"]).first()["distribution"]
    assert got == name or name == "gamma" and got == "beta" or name == "beta" and got == "gamma"


# -- rules


def test_null_breaks_a_rule_unless_ignored(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (5.0, "z")], "x double, s string")
    checks = [Rule("gt", "x", ">", 2), Rule("gt_known", "x", ">", 2, nulls="ignore"), Rule("in", "s", "in", ["a"]), Rule("not_in", "s", "not_in", ["a"]), Rule("between", "x", "between", [0, 2]), Rule("text", "s", "==", 1), Rule("gone", "nope", ">", 1)]
    assert {r["rule"]: r["n_violated"] for r in rules.rule_violations(df, checks).collect()} == {"gt": 2, "gt_known": 1, "in": 2, "not_in": 1, "between": 2, "text": 3}
    with pytest.raises(ValueError):
        rules.violated(Rule("bad", "x", "~", 1))
    with pytest.raises(ValueError):
        rules.group_mask("x", {"~": 1})


def test_codes_compare_as_text(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "flag int")
    assert rules.rule_violations(df, [Rule("binary", "flag", "in", [0, 1])]).first()["n_violated"] == 1


def test_group_rule_with_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 3.0), ("b", None)], "g string, x double")
    got = rules.group_comparison(df, [GroupRule("n", "g", None, "a", "x", ">"), GroupRule("empty", "g", "zzz", "a", "x", ">"), GroupRule("null metric", "g", "b", "a", "x", ">")]).collect()
    assert [(r["rule"], r["violated"]) for r in got] == [("n", False)]


def test_score_without_rules(spark):
    assert rules.plausibility_score(spark.createDataFrame([], "rule string, severity string, rate double")).first()["score"] == 100.0


# -- drift


def test_psi_status_bounds(spark):
    df = spark.createDataFrame([(0.0999,), (0.10,), (0.1999,), (0.20,)], "psi double")
    assert [r[0] for r in df.select(drift.psi_status(F.col("psi"))).collect()] == ["stable", "monitor", "monitor", "unstable"]


def test_psi_of_identical_and_degenerate(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(60)] + [("b", float(i)) for i in range(40)], "s string, x double")
    assert drift.psi_categorical(df, df, ["s"]).first()["psi"] == pytest.approx(0, abs=1e-9)
    bad = df.select(F.lit("x").alias("s"), F.lit("no number").alias("x"))
    r = drift.psi_numeric(df, bad, ["x"]).first()
    assert (r["psi"], r["n_bins"]) == (0.0, 0)
    one = df.withColumn("x", F.lit(1.0))
    assert drift.psi_numeric(one, df, ["x"]).first()["n_bins"] == 0
    assert drift.psi_categorical(df.where("s = 'a'"), df, ["s"]).first()["n_bins"] == 2


def test_psi_repeated_quantiles(spark):
    df = spark.createDataFrame([(0.0 if i < 80 else float(i),) for i in range(100)], "x double")
    assert drift.psi_numeric(df, df, ["x"]).first()["psi"] > 0.2  # the first probability of a repeated edge
    assert drift.psi_numeric(df, df, ["x"], keep="last").first()["psi"] < 0.05


def test_ks_ends(spark):
    a, b = (spark.createDataFrame([(float(i),) for i in r], "x double") for r in (range(10), range(100, 110)))
    assert drift.ks_two_sample(a, b, ["x"]).first()["ks"] == 1.0
    assert drift.ks_two_sample(a, a, ["x"]).first()["ks"] == 0.0


# -- privacy


def test_leakage_matches_nulls(spark):
    seed = spark.createDataFrame([("a", None), ("b", 1)], "s string, x int")
    synth_ = spark.createDataFrame([("a", None), ("a", 1), ("a", None)], "s string, x int")
    r = privacy.row_leakage(synth_, seed, ["s", "x"]).first()
    assert (r["n"], r["n_leaked"], r["severity"]) == (3, 2, "CRITICAL")


def test_gower_by_hand(spark):
    q = spark.createDataFrame([(1, "a", 0.0), (2, None, None)], "k int, s string, x double")
    ref = spark.createDataFrame([(3, "a", 10.0), (4, None, 5.0)], "k int, s string, x double")
    got = dict(rows(privacy.gower_nearest(q, ref, ["s"], ["x"], ["k"])))
    assert got == {1: 0.5, 2: 0.0}  # the null number is the median of 0, 10 and 5


def test_disjoint_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = [sorted(r[0] for r in x.collect()) for x in privacy.disjoint_samples(df.repartition(1), 50, ["k"])]
    b = [sorted(r[0] for r in x.collect()) for x in privacy.disjoint_samples(df.repartition(7), 50, ["k"])]
    assert a == b and not set(a[0]) & set(a[1]) and len(a[0]) == 50


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.9, 1), (0.1, 0)], "score double, label int")
    assert privacy.auc(df).first()["auc"] == pytest.approx(0.875)
    assert privacy.auc(df.where("label = 1")).first()["auc"] is None


# -- differential privacy


def test_laplace_scale_zero_and_seed(spark):
    df = spark.range(2000)
    assert df.select(F.max(F.abs(rng.laplace(0.0, 1, F.col("id"))))).first()[0] == 0.0
    x = [r[0] for r in df.select(rng.laplace(2.0, 1, F.col("id"))).collect()]
    assert x == [r[0] for r in df.repartition(5).orderBy("id").select(rng.laplace(2.0, 1, F.col("id"))).collect()]
    assert abs(np.mean(x)) < 0.3 and np.mean(np.abs(x)) == pytest.approx(2.0, rel=0.1)


def test_dp_proportions_sum_and_zero(spark):
    freq = spark.createDataFrame([("c", v, n) for v, n in (("x", 600.0), ("y", 300.0), ("z", 100.0))], "column string, value string, count double")
    assert sum(r["proportion"] for r in dp.dp_proportions(freq, 1.0).collect()) == pytest.approx(1, abs=2e-6)
    none = dp.dp_proportions(spark.createDataFrame([("c", "x", -1e9)], "column string, value string, count double"), 1.0).first()
    assert none["proportion"] == 0.0


def test_nearest_correlation():
    bad = np.array([[1, 0.9, -0.9], [0.9, 1, 0.9], [-0.9, 0.9, 1.0]])
    good = dp.nearest_correlation(bad)
    assert np.linalg.eigvalsh(good).min() > -1e-9 and np.allclose(np.diag(good), 1)
    assert np.allclose(dp.nearest_correlation(good), good)
    ok = np.array([[1, 0.3], [0.3, 1.0]])
    assert np.allclose(dp.nearest_correlation(ok), ok)


def test_dp_quantiles_are_monotone(spark):
    q = spark.createDataFrame([("x", p, p * 100) for p in (0.1, 0.25, 0.5, 0.75, 0.9)], "column string, prob double, value double")
    ends = spark.createDataFrame([("x", 0.0, 100.0)], "column string, min double, max double")
    for eps in (0.001, 0.1, 10.0):
        v = [r["value"] for r in dp.dp_quantiles(q, ends, 100, eps).orderBy("prob").collect()]
        assert v == sorted(v) and v[0] >= 0 and v[-1] <= 100


def test_budget():
    assert sum(dp.split_budget(2.0).values()) == pytest.approx(2.0)
    with pytest.raises(ValueError):
        dp.split_budget(0)


# -- association


def test_multi_consequents_and_coverage(spark):
    t = spark.createDataFrame([(["a", "b", "c"],)] * 8 + [(["a"],)] * 2, "items array<string>")
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): r for r in assoc.association_rules(assoc.frequent_itemsets(t, 0.2)).collect()}
    assert got[("b",), ("a", "c")]["confidence"] == 1.0 and got[("a",), ("b", "c")]["confidence"] == pytest.approx(0.8)
    assert assoc.mine(t)[0] == 0.50
    with pytest.raises(ValueError):
        assoc.mine(spark.createDataFrame([(["a"],), (["b"],)], "items array<string>"))
    assert rows(assoc.frequent_itemsets(t.where("false"), 0.2)) == []


def test_bins_are_closed_above(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 2.0, 3.0, None)], "x double")
    got = [r[0] for r in df.select(coerce.right_closed_bin(F.col("x"), [0, 1, 2], ["low", "high"])).collect()]
    assert got == [None, "low", "high", "high", None, None]
    got = [r[0] for r in df.select(coerce.right_closed_bin(F.col("x"), [0, 1, 2], ["low", "high"], include_lowest=True)).collect()]
    assert got[0] == "low"


# -- text


NAMES = [f"c{i}" for i in range(13)]


@pytest.mark.parametrize(
    ("line", "first", "bad"),
    [
        (",".join("abcdefghijklm"), "a", False),
        ("deadbeefdeadbeef," + ",".join("abcdefghijklm"), "a", False),
        ("deadbeefdeadbeef," + ",".join("abcdefghijkl"), None, True),
        (",".join("abcdefghij"), "a", False),
        ("12345678," + ",".join("abcdefghijkl"), "12345678", False),
        ("a,b", None, True),
        ('"x, y",' + ",".join("abcdefghijkl"), "x, y", False),
    ],
)
def test_line_repair(spark, line, first, bad):
    r = text.parse_rows(spark.createDataFrame([(line,)], "line string"), NAMES).first()
    assert r["malformed"] == bad and (r["cells"] is None if bad else (r["cells"][0] == first and len(r["cells"]) == 13))


def test_headers_blanks_and_fences_go(spark):
    df = spark.createDataFrame([(",".join(NAMES),), ("```csv",), ("",), (None,), ("  ",)], "line string")
    assert text.parse_rows(df, NAMES).count() == 0


def test_text_helpers(spark):
    df = spark.createDataFrame([("```json\n{\"verdict\": \"ok\", \"score\": 3}\n```", "## A\nx\n## B\ny", "frozenset({'b_2', 'a_1'})", "a <!-- x\ny --> b")], "j string, p string, r string, c string")
    r = df.select(text.verdict(F.col("j")).alias("v"), text.drop_section(F.col("p"), "A").alias("p"), text.rule_items(F.col("r")).alias("i"), text.strip_comments(F.col("c")).alias("c")).first()
    assert r["v"]["verdict"] == "ok" and r["v"]["error"] is None and r["p"] == "## B\ny" and r["i"] == ["a_1", "b_2"] and r["c"] == "a  b"
    bad = spark.createDataFrame([("no json",)], "j string").select(text.verdict(F.col("j")).alias("v")).first()["v"]
    assert bad["error"] == "no json"


def test_hash_detector(spark):
    df = spark.createDataFrame([("0123456789abcdef" * 2, "x")] * 4, "h string, s string")
    assert text.is_hash_like(df, "h").first()[0] and not text.is_hash_like(df, "s").first()[0] and not text.is_hash_like(df.where("false"), "s").first()[0]


# -- synthesis


def toy(spark):
    return spark.createDataFrame([("NO", "F", "a"), ("NO", "M", "a"), ("NO", "F", None), ("YES", "F", "b"), ("YES", "M", " "), ("NO", "M", "b")], "t string, g string, r string")


def test_conditional_distribution(spark):
    got = {(r["column"], r["target"], r["value"]): (r["p"], r["missing_rate"]) for r in synth.conditional_distributions(toy(spark), "t", ["g", "r"]).collect()}
    assert got["r", "NO", "a"] == (pytest.approx(2 / 3), 0.25) and got["r", "YES", "b"] == (1.0, 0.5) and got["r", "YES", None][0] is None


def test_strata_are_repeatable(spark):
    a = synth.sample_strata(toy(spark), 200, "t", ["g", "r"], 1)
    b = synth.sample_strata(toy(spark).repartition(3), 200, "t", ["g", "r"], 1)
    assert sorted(rows(a)) == sorted(rows(b)) and sorted(rows(a)) != sorted(rows(synth.sample_strata(toy(spark), 200, "t", ["g", "r"], 2)))
    assert a.count() == 200 and 0.5 < a.where("t = 'NO'").count() / 200 < 0.8
    assert {r[0] for r in a.where("t = 'YES'").select("r").distinct().collect()} == {"b", ""}


def test_pinning(spark):
    r = spark.createDataFrame([(0, "x", "1"), (1, "y", "2"), (2, "z", "3")], "row_id long, a string, n string")
    s = spark.createDataFrame([(0, "A"), (1, "B")], "row_id long, a string")
    assert sorted(rows(synth.pin_strata(r, s, ["a", "nope"]).select("row_id", "a", "n"))) == [(0, "A", "1"), (1, "B", "2"), (2, "z", "3")]


def test_generation_keeps_row_ids(spark):
    strata = synth.sample_strata(toy(spark), 20, "t", ["g"], 3)
    said = "\n".join(["a,1", "deadbeef", "b,2"])  # fewer lines than rows, one of them bad
    out = synth.generate(strata, ["x", "y"], lambda system, user: said, "", lambda part: "", batch=5, max_retries=2)
    assert out.count() == 20 and {r[0] for r in out.select("row_id").collect()} == set(range(20))
    assert 0 < out.where("cells IS NOT NULL").count() < 20


def test_iman_conover_keeps_marginals(spark):
    df = spark.range(2000).select(F.col("id").alias("row_id"), (F.col("id") % 97).cast("double").alias("a"), F.pow(F.col("id") % 89, F.lit(2.0)).alias("b"))
    out = synth.iman_conover(df, ["a", "b"], np.array([[1, 0.8], [0.8, 1.0]]))
    for c in "ab":
        assert sorted(r[0] for r in df.select(c).collect()) == sorted(r[0] for r in out.select(c).collect())
    assert profile.spearman_pairs(out, ["a", "b"]).first()["r"] == pytest.approx(0.8, abs=0.06)


def test_quantile_match_keeps_order(spark):
    a = spark.createDataFrame([(i, float((i * 37) % 50)) for i in range(50)] + [(99, None)], "row_id long, x double")
    s = spark.createDataFrame([(float(v),) for v in np.linspace(100, 200, 11)], "x double")
    got = synth.quantile_match(a, s, "x").join(a, "row_id").orderBy("x").collect()
    m = [r["matched"] for r in got]
    assert len(m) == 50 and m == sorted(m) and m[0] == 100 and m[-1] == 200


def test_global_rank_over_ties(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    assert sorted(r["rank"] for r in synth.global_rank(df, "v", ["k"]).collect()) == list(range(1000))


# -- utility, prompts, report


def test_scores_on_single_class(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0)], "label double, prediction double")
    r = tstr.macro_f1(df).first()
    assert r["accuracy"] == 0.5 and r["macro_f1"] == pytest.approx((2 / 3 + 0) / 2)


def test_ece_last_bin(spark):
    df = spark.createDataFrame([(1.0, {1.0: 1.0}), (0.0, {1.0: 1.0})], "label double, p map<double,double>")
    assert tstr.brier_ece(df).first()["ece"] == 0.0
    assert tstr.brier_ece(df, closed_last=True).first()["ece"] == 0.5


def test_prompt_texts(spark):
    spec = TableSpec(categorical=("g",), numeric=("x",), target="t")
    stats = {"columns": {"g": {"frequency_table": {"a": {"proportion": 0.9}}}, "x": {"min": 0, "max": 9, "mean": 4.0, "median": 4.0, "skewness": 0.1}, "t": {"frequency_table": {"Y": {"proportion": 1.0}}}}}
    said = prompts.system_prompt("toy", spec, stats, ["x > 0"], ["n"])
    assert "| g | categorical | a (90%) |" in said and "Column order: g,x,t" in said
    kinds = prompts.archetypes({}, stats, "t")
    assert "t is Y" in prompts.user_message(3, 50, kinds) and "___" in prompts.stratified_message([{"g": "a", "t": "Y"}], spec)
    strata = spark.createDataFrame([(0, "a", "Y")], "row_id long, g string, t string")
    assert prompts.template_lines(strata, spec).first()["template"] == "a,___,Y"


def test_report_pieces(spark):
    issues = spark.createDataFrame([("LOW", "b", "x"), ("CRITICAL", "a", "<y>"), (None, "c", "z")], "severity string, check string, detail string")
    one = report.by_severity(report.union_issues([issues]))
    assert [r["severity"] for r in one.collect()] == ["CRITICAL", "LOW"] and report.severity_counts(one)["total"] == 2
    assert "&lt;y&gt;" in report.html_scorecard("t", 99, {"i": [r.asDict() for r in one.collect()]})
    assert "CRITICAL" in report.console_table([r.asDict() for r in one.collect()], ["severity", "detail"])


def test_coercions(spark):
    df = spark.createDataFrame([(" 00123 ",), ("000",), ("x",), (None,)], "z string")
    assert [r[0] for r in df.select(coerce.zip3(F.col("z"))).collect()] == [123, 0, -1, -1]
    df = spark.createDataFrame([("NaN",), ("1e3",), ("x",), (None,)], "z string")
    assert [r[0] for r in df.select(coerce.to_double(F.col("z"))).collect()] == [None, 1000.0, None, None]
    assert exp(0) == 1 and json.loads("1") == 1
