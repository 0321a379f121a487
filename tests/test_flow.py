"""Sources, the pipeline from end to end, the command line and the streaming monitor."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfidelity import cli, pipeline
from tabfidelity.operators import report
from tabfidelity.sources import io
from tabfidelity.spec import Bound, Rule, TableSpec
from tabfidelity.streaming import psi


@pytest.fixture(scope="module")
def seed_csv(tmp_path_factory):
    r = np.random.default_rng(1)
    lines = [",sex,ward,age,stay,outcome"]
    for i in range(300):
        age = int(r.integers(20, 90))
        lines.append(f"{i},{'FM'[r.integers(2)]},{['a', 'b', 'None', 'NA'][r.integers(4)]},{age},{age / 10 + r.normal():.3f},{'yes' if age + r.normal() * 10 > 60 else 'no'}")
    p = tmp_path_factory.mktemp("seed") / "seed.csv"
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_csv_reader(spark, seed_csv):
    df = io.read_csv(spark, seed_csv)
    assert dict(df.dtypes) == {"sex": "string", "ward": "string", "age": "bigint", "stay": "double", "outcome": "string"}
    assert df.where("ward IN ('None', 'NA')").count() == 0 and df.where("ward IS NULL").count() > 50
    assert set(io.read_csv(spark, seed_csv, typed=False).dtypes) == {(c, "string") for c in df.columns}
    assert io.header(spark, seed_csv) == df.columns
    assert io.read_csv(spark, seed_csv, "age double").columns == ["age"]


def test_domain_names():
    assert io.domain_of("data/heart_failure_seed.csv", ["diabetes", "heart_failure"]) == "heart_failure"
    assert io.domain_of("diab.csv", ["diabetes", "heart_failure"]) == "diabetes"
    assert io.domain_of("zzz.csv", ["diabetes"]) is None


def test_rules_round_trip(spark, tmp_path):
    r = spark.createDataFrame([(["a_1", "b_2"], ["c_3"], 0.5, 0.9, 1.2)], "antecedents array<string>, consequents array<string>, support double, confidence double, lift double")
    io.write_rules(r, str(tmp_path / "rules"))
    assert io.read_rules(spark, str(tmp_path / "rules")).collect() == r.collect()


def test_runs_are_kept_apart(spark, tmp_path):
    df = spark.range(3)
    for run in ("one", "two"):
        io.append_rows(df, str(tmp_path / "rows"), run)
    assert spark.read.parquet(str(tmp_path / "rows")).where("run_id = 'one'").count() == 3


SPEC = TableSpec(categorical=("sex", "ward"), numeric=("age", "stay"), target="outcome", quasi_ids=("sex", "ward"))


def test_whole_run(spark, seed_csv, tmp_path):
    seed = io.read_csv(spark, seed_csv)
    rules = pipeline.RuleSet((Bound("age", 0, 120),), (Rule("adult", "age", ">=", 18, "HIGH"),))
    out = pipeline.run(spark, seed, SPEC, str(tmp_path / "out"), rows=200, epsilon=5.0, rule_set=rules)
    made = spark.read.parquet(str(tmp_path / "out" / "synthetic"))
    assert made.count() == 200 and made.where("age < 20 OR age > 90").count() == 0
    assert out["validation"]["plausibility"] == 100.0 and 0 < out["utility"]["fidelity"] <= 2
    noised = json.loads((tmp_path / "out" / "stats_dp.json").read_text())
    assert noised["dp"]["epsilon"] == 5.0 and noised["dp"]["composed_epsilon"] > 5.0
    for p in ("stats.json", "validation.json", "validation.html", "utility.json"):
        assert (tmp_path / "out" / p).stat().st_size > 0


def test_validate_with_privacy(spark, seed_csv):
    seed = io.read_csv(spark, seed_csv).withColumn("id", F.monotonically_increasing_id())
    spec = TableSpec(**{**SPEC.__dict__, "row_key": ("id",)})
    out = pipeline.validate(seed, seed, spec, sample=50)
    assert out["metrics"]["leakage"]["rate"] == 1.0 and out["metrics"]["residual_risk"]["overall_band"] in ("LOW", "MEDIUM", "HIGH")
    assert out["summary"]["CRITICAL"] >= 1


def test_command_line(spark, seed_csv, tmp_path):
    stats = str(tmp_path / "s.json")
    assert cli.main(["profile", "--seed", seed_csv, "--output", stats]) == 0
    assert cli.main(["dp", "--stats", stats, "--epsilon", "1", "--output", str(tmp_path / "n.json")]) == 0
    assert json.loads((tmp_path / "n.json").read_text())["dp"]["mechanism"] == "laplace"
    config = tmp_path / "c.yaml"
    config.write_text("schema:\n  expected_columns: [sex, age, outcome]\n  categorical_columns: [sex]\n  target_column: outcome\nplausibility:\n  column_bounds: {age: [0, 120]}\n  rules:\n    - {name: adult, column: age, operator: '>=', value: 18}\n")
    assert cli.main(["--config", str(config), "build-prompt", "toy", "--stats", stats, "--output", str(tmp_path / "p.md")]) == 0
    assert "age >= 18" in (tmp_path / "p.md").read_text()
    assert cli.main(["--config", str(config), "validate", "--synthetic", seed_csv, "--seed", seed_csv, "--output", str(tmp_path / "v.json")]) == 0


def test_profile_document(spark, seed_csv):
    p = report.build_profile(io.read_csv(spark, seed_csv), SPEC)
    assert p["columns"]["age"]["quantiles"]["p50"] > 20 and p["columns"]["sex"]["mode"] in ("F", "M") and p["missing"]["ward"]["count"] > 50


def test_streaming_psi(spark, tmp_path):
    seed = spark.range(100).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("s"))
    src = tmp_path / "in"
    seed.repartition(2).write.parquet(str(src))
    seen = []
    for _ in range(2):  # the second start finds nothing new and counts nothing twice
        stream = spark.readStream.schema("s string").option("maxFilesPerTrigger", 1).parquet(str(src))
        psi.monitor(stream, seed, ["s"], str(tmp_path / "state"), str(tmp_path / "cp"), lambda df, n: seen.append((n, df.first().asDict()))).awaitTermination()
    assert seen[-1][1]["n"] == 100 and seen[-1][1]["psi"] == pytest.approx(0, abs=1e-9) and [n for n, _ in seen] == [0, 1]
