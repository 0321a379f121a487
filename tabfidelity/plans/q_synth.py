"""Queries of generation and repair."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import synth as S
from .bindings import BASE_SQL, read, rounded, seed, synth
from .catalog import query
from .q_dp import usql

_COND = """c AS (SELECT flag AS target, 'l_linestatus' AS "column", nullif(trim(l_linestatus), '') AS value FROM seed UNION ALL SELECT flag, 'pr', nullif(trim(CASE WHEN l_linenumber = 3 THEN ' ' ELSE l_linenumber::VARCHAR END), '') FROM seed),
n AS (SELECT "column", target, value, count(*) AS n FROM c GROUP BY ALL),
cd AS (SELECT *, sum(n) OVER (PARTITION BY "column", target) AS t, sum(CASE WHEN value IS NOT NULL THEN n END) OVER (PARTITION BY "column", target) AS th FROM n)"""


def _seed(spark, d):
    return seed(spark, d).withColumn("pr", F.when(F.col("l_linenumber") == 3, " ").otherwise(F.col("l_linenumber").cast("string")))


@query(f'WITH {BASE_SQL}, {_COND} SELECT "column", target, value, n, CASE WHEN value IS NOT NULL THEN round(n / th, 6) END AS p, round(1 - coalesce(th, 0) / t, 6) AS missing_rate FROM cd')
def cond_dist(spark, d):
    return rounded(S.conditional_distributions(_seed(spark, d), "flag", ["l_linestatus", "pr"]))


def _pick(u: str, table: str, extra: str = "") -> str:
    return f"(SELECT coalesce(min(value) FILTER (cum > {u}), max(value)) FROM {table} WHERE true {extra})"


@query(f"""WITH {BASE_SQL}, {_COND}, mg AS (SELECT flag AS value, sum(count(*)) OVER (ORDER BY flag) / sum(count(*)) OVER () AS cum FROM seed GROUP BY 1),
cp AS (SELECT "column", target, value, sum(n / th) OVER (PARTITION BY "column", target ORDER BY value) AS cum FROM cd WHERE value IS NOT NULL), ms AS (SELECT DISTINCT "column", target, 1 - coalesce(th, 0) / t AS m FROM cd),
r AS (SELECT range AS row_id, {usql("'flag'", 'range')} AS u FROM range(2000)), a AS (SELECT row_id, (SELECT coalesce(min(value) FILTER (cum > u), max(value)) FROM mg) AS flag FROM r),
b AS (SELECT a.*, {usql("'l_linestatus'", 'row_id')} AS u1, {usql("'pr'", 'row_id')} AS u2, {usql("'l_linestatus?'", 'row_id')} AS g1, {usql("'pr?'", 'row_id')} AS g2 FROM a)
SELECT row_id, flag, CASE WHEN g1 < (SELECT m FROM ms WHERE "column" = 'l_linestatus' AND target = flag) THEN '' ELSE (SELECT coalesce(min(value) FILTER (cum > u1), max(value)) FROM cp WHERE "column" = 'l_linestatus' AND target = flag) END AS l_linestatus,
CASE WHEN g2 < (SELECT m FROM ms WHERE "column" = 'pr' AND target = flag) THEN '' ELSE (SELECT coalesce(min(value) FILTER (cum > u2), max(value)) FROM cp WHERE "column" = 'pr' AND target = flag) END AS pr FROM b""")
def strata_sample(spark, d):
    return S.sample_strata(_seed(spark, d), 2000, "flag", ["l_linestatus", "pr"])


@query(f"""WITH {BASE_SQL}, v AS (SELECT 'flag' AS "column", flag AS value FROM seed UNION ALL SELECT 'pr', CASE WHEN l_linenumber = 3 THEN '<missing>' ELSE l_linenumber::VARCHAR END FROM seed)
SELECT "column", value, round(count(*) / (SELECT count(*) FROM seed), 4) AS proportion FROM v GROUP BY ALL""")
def strata_summary(spark, d):
    return S.strata_summary(_seed(spark, d), ["flag", "pr"])


_B = "s AS (SELECT c_custkey AS row_id, c_mktsegment AS seg, c_nationkey::VARCHAR AS nat FROM customer), r AS (SELECT c_custkey AS row_id, CASE WHEN c_custkey % 4 = 0 THEN 'OTHER' ELSE c_mktsegment END AS seg, (c_nationkey % 5)::VARCHAR AS nat, c_acctbal FROM customer WHERE c_custkey % 7 <> 0)"


def _rows(spark, d):
    c = read(spark, d, "customer")
    strata = c.select(F.col("c_custkey").alias("row_id"), F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").cast("string").alias("nat"))
    rows = c.where("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("row_id"), F.when(F.col("c_custkey") % 4 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("seg"), (F.col("c_nationkey") % 5).cast("string").alias("nat"), "c_acctbal")
    return strata, rows


@query(f"WITH {_B} SELECT row_id, coalesce(s.seg, r.seg) AS seg, coalesce(s.nat, r.nat) AS nat, c_acctbal FROM r LEFT JOIN (SELECT * FROM s WHERE row_id % 3 <> 0) s USING (row_id)")
def pin_strata(spark, d):
    strata, rows = _rows(spark, d)
    return S.pin_strata(rows, strata.where("row_id % 3 <> 0"), ["seg", "nat", "unknown"])


@query(f"WITH {_B}, j AS (SELECT r.seg <> s.seg AS a, r.nat <> s.nat AS b FROM r JOIN s USING (row_id)) SELECT 'seg' AS \"column\", count(*) AS n, count_if(a)::BIGINT AS n_differ FROM j UNION ALL SELECT 'nat', count(*), count_if(b)::BIGINT FROM j")
def strata_drift(spark, d):
    strata, rows = _rows(spark, d)
    return S.strata_drift(rows, strata, ["seg", "nat"])


@query(f"""WITH {_B}, w AS (SELECT row_id // 50 AS batch_id, count(*) AS want FROM s GROUP BY 1), g AS (SELECT row_id // 50 AS batch_id, count(*) AS got, avg((seg = 'OTHER')::INT) AS s0 FROM r GROUP BY 1)
SELECT w.batch_id, want, coalesce(got, 0) AS got, coalesce(got, 0) < want * 0.85 AS short, coalesce(s0 < 0.25, true) AS low_0 FROM w LEFT JOIN g USING (batch_id)""")
def batch_checks(spark, d):
    strata, rows = _rows(spark, d)
    return S.batch_checks(S.plan_batches(rows, 50), S.plan_batches(strata, 50), "seg", [("OTHER", 0.25)], 0.85)


@query(f"WITH {_B}, p AS (SELECT row_id, row_id // 50 AS batch_id, row_id % 50 AS pos, row_number() OVER (PARTITION BY row_id // 50 ORDER BY row_id) AS k FROM r) SELECT row_id, batch_id, pos FROM p WHERE k <= 20")
def batch_truncate(spark, d):
    _, rows = _rows(spark, d)
    return S.truncate_batches(S.plan_batches(rows.select("row_id"), 50), 20).select("row_id", "batch_id", "pos")


_K = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _qm(column: str, inflated: bool) -> str:
    ks = ", ".join(_K)
    pool = f"SELECT {column} AS v FROM seed WHERE {column} IS NOT NULL" + (f" AND {column} > 0" if inflated else "")
    at = "CASE WHEN r >= cut THEN least(greatest(round_even((r - cut) / greatest(greatest(n - cut, 1) - 1, 1)::DOUBLE * p99, 0), 0), p99)::BIGINT END" if inflated else "least(greatest(round_even(r / greatest(n - 1, 1)::DOUBLE * (m - 1), 0), 0), m - 1)::BIGINT"
    value = "CASE WHEN at_ IS NULL THEN 0 ELSE floor(v) END" if inflated else "v"
    return f"""x AS (SELECT {ks}, {column} AS x, row_number() OVER (ORDER BY {column}, {ks}) - 1 AS r FROM synth WHERE {column} IS NOT NULL), pool AS ({pool}), pv AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM pool),
k AS (SELECT (SELECT count(*) FROM x) AS n, (SELECT count(*) FROM pool) AS m, round_even((SELECT avg(({column} = 0)::INT) FROM seed) * (SELECT count(*) FROM x), 0)::BIGINT AS cut, round_even(0.99::DOUBLE * ((SELECT count(*) FROM pool) - 1), 0)::BIGINT AS p99),
a AS (SELECT {ks}, {at} AS at_ FROM x, k) SELECT {ks}, ({value})::DOUBLE AS matched FROM a LEFT JOIN pv ON at_ = i"""


@query(f"WITH {BASE_SQL}, {_qm('price', False)}")
def quantile_match(spark, d):
    return S.quantile_match(synth(spark, d), seed(spark, d), "price", _K)


@query(f"WITH {BASE_SQL}, {_qm('zi', True)}")
def zero_inflated_match(spark, d):
    return S.quantile_match(synth(spark, d), seed(spark, d), "zi", _K)


@query()
def iman_conover(spark, d):
    rows = read(spark, d, "orders").select(F.col("o_orderkey").alias("row_id"), "o_orderstatus", F.col("o_totalprice").alias("a"), (F.col("o_custkey") * 1.0).alias("b"))
    return S.iman_conover(rows, ["a", "b"], np.array([[1.0, 0.7], [0.7, 1.0]]), by=["o_orderstatus"])


@query()
def synthesised(spark, d):
    s = seed(spark, d).select("flag", "l_linestatus", "l_quantity", "price")
    return S.synthesise(spark, s, 1000, "flag", ["flag", "l_linestatus"], ["l_quantity", "price"], np.array([[1.0, 0.5], [0.5, 1.0]]))
