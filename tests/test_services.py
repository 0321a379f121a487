"""Text sources: requests, back-off, failures by batch, the audit, and reports."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfidelity.operators import drift, profile, prompts, report, synth, tstr
from tabfidelity.sources import io
from tabfidelity.spec import TableSpec


@pytest.fixture
def service():
    """A chat-completions service on this machine that answers with what it was asked."""
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["content-length"])))
            seen.append((dict(self.headers), body))
            text = body["messages"][-1]["content"]
            answer = {"content": [{"type": "text", "text": text}]} if "system" in body else {"choices": [{"message": {"content": text}}]}
            raw = json.dumps(answer).encode()
            self.send_response(500 if text == "fail" else 200)
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/", seen
    server.shutdown()


@pytest.mark.parametrize("kind", ["chat", "messages"])
def test_endpoint(service, kind, monkeypatch):
    url, seen = service
    monkeypatch.setenv("TABFIDELITY_API_KEY", "k")
    assert synth.Endpoint(url, "m", kind=kind)("sys", "hello") == "hello"
    headers = {k.lower(): v for k, v in seen[0][0].items()}
    assert headers.get("x-api-key" if kind == "messages" else "authorization") in ("k", "Bearer k") and seen[0][1]["model"] == "m"


def test_back_off(service):
    url, seen = service
    waits = []
    with pytest.raises(OSError):
        synth.with_back_off(synth.Endpoint(url, "m"), "s", "fail", 3, 1.0, waits.append)
    assert waits == [1.0, 2.0] and len(seen) == 3


def test_failures_stay_with_their_batch(spark):
    strata = spark.range(30).withColumnRenamed("id", "row_id").coalesce(1)

    def complete(system, user):
        first = int(user)
        if first == 10:
            raise ConnectionError("down")
        return "\n".join(f"{i},x" for i in range(first, first + (10 if first == 0 else 3)))

    asked = synth.request_rows(strata.repartition(1), complete, "s", lambda part: str(part["row_id"].iloc[0]), batch=10, max_retries=2, first_wait=0.0)
    rows = asked.collect()
    assert [r["row_id"] for r in sorted(rows) if r["line"]] == [*range(10), 20, 21, 22]
    bad = {r["batch_id"]: r for r in synth.failures(asked).collect()}
    assert set(bad) == {1, 2} and "ConnectionError" in bad[1]["error"] and bad[2]["error"] == "3 of 10 rows" and bad[1]["n_missing"] == 10 and bad[1]["tries"] == 2
    told = []
    out = synth.generate(strata, ["a", "b"], lambda s, u: "\n".join("1,2" for _ in range(10)), "s", lambda part: "0", batch=10, progress=lambda *x: told.append(x))
    assert out.where("cells IS NOT NULL").count() == 30 and told == [(30, 30, 0)]


def test_audit():
    assert prompts.audit(lambda s, u: '```json\n{"verdict": "PASS", "score": 90}\n```', {}, [])["score"] == 90
    assert prompts.audit(lambda s, u: "no", {}, [])["answer"] == "no"


def test_ranked_quantiles_equal_the_buffer(spark):
    r = np.random.default_rng(4)
    rows = [(float(x) if x else None, int(y)) for x, y in zip(r.integers(0, 40, 500), r.integers(0, 5, 500))]
    df = spark.createDataFrame(rows, "a double, b int").withColumn("none", F.lit(None).cast("double"))
    got, want = ({(x["column"], x["prob"]): round(x["value"], 9) for x in profile.quantiles(df, ["a", "b", "none"], method=m).collect()} for m in ("exact", "buffer"))
    assert got == want and len(got) == 18
    one = {x["column"]: x["median"] for x in profile.numeric_summary(df, ["a", "none"]).collect()}
    assert one["none"] is None and one["a"] == pytest.approx(got["a", 0.5])


def test_synthetic_profile_and_duration(spark):
    df = spark.createDataFrame([("a", "x", 1.0, "2020-01-01", "2020-01-11"), ("b", "x", 2.0, "2020-01-01", "2020-01-31"), ("b", "y", 3.0, None, "2020-01-31"), ("b", "y", 3.0, "2020-02-01", "2020-02-21")], "s string, t string, v double, d0 string, d1 string")
    out = report.synthetic_profile(df, TableSpec(categorical=("s", "t"), numeric=("v",), target="s", quasi_ids=("s", "t")), ("d0", "d1"))
    assert out["coverage_duration_days"] == {"min": 10.0, "max": 30.0, "mean": 20.0, "median": 20.0, "p25": 15.0, "p75": 25.0}
    assert out["columns"]["s"]["top_proportions"] == {"b": 0.75, "a": 0.25} and out["k_anonymity"]["min_size"] == 1 and out["missing_rates"]["d0"] == 0.25


def test_ab_report(spark):
    a, b = (spark.createDataFrame([("coverage", x), ("mean_ks", 0.2)], "metric string, value double") for x in (0.9, 0.8))
    assert report.ab_report(a, b, {"rows": 5}, {"a": 5, "b": 5})["winners"] == {"coverage": "a", "mean_ks": "tie"}
    assert drift.ab_tally(a, b).count() == 2


def test_levels_beyond_a_list(spark):
    """A column with more levels than a list has is coded by a table, whole and alike on any partitioning."""
    df = spark.range(60).select(F.concat(F.lit("v"), F.lpad((F.col("id") % 30).cast("string"), 2, "0")).alias("c"), F.when(F.col("id") % 2 == 0, "y").otherwise("n").alias("l"), F.col("id").alias("row_id"))
    assert tstr.level_codes(df, "c") == [f"v{i:02d}" for i in range(30)]
    table = tstr.level_codes(df, "c", listed=5)
    both = [sorted((r["row_id"], r["features"].toArray().tolist()) for r in tstr.encode(df, "l", ["n", "y"], {"c": x}, [], ["row_id"]).collect()) for x in (tstr.level_codes(df, "c"), table)]
    assert both[0] == both[1]


def test_cross_validation_and_report(spark, tmp_path):
    r = np.random.default_rng(2)
    x = r.normal(size=300)
    df = spark.createDataFrame([(i, float(v), "hi" if v + r.normal() * 0.3 > 0 else "lo") for i, v in enumerate(x)], "row_id long, v double, l string")
    data = tstr.encode(df, "l", ["lo", "hi"], {}, ["v"], ["row_id"])
    folds = tstr.cross_validated(data, 2, ["row_id"], "logistic", 3).collect()
    assert [f["fold"] for f in folds] == [0, 1, 2] and sum(f["n"] for f in folds) == 300 and min(f["macro_f1"] for f in folds) > 0.75
    rows = [t.asDict() for t in tstr.extended_report(data, data, 2, ["row_id"], ("logistic",)).collect()]
    assert {t["regime"] for t in rows} == {"TRTR", "TRTS", "TSTR", "TSTS"} and min(t["mean_auc"] for t in rows) > 0.85
    io.write_csv(rows, str(tmp_path / "r.csv"))
    assert (tmp_path / "r.csv").read_text().startswith("model,regime,n,accuracy,macro_f1,mean_auc")
