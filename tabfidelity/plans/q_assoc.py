"""Queries of rule mining."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assoc as A
from .bindings import BASE_SQL, rounded, seed, synth
from .catalog import query

EDGES = [0.0, 20000.0, 50000.0, 110000.0]
LABELS = ["low", "mid", "high"]


def transactions(df):
    df = df.withColumn("net", F.col("price") * (1 - F.col("l_discount")))
    return df.select(*[c for c in df.columns if c.startswith("l_")], A.items(["flag", "l_linestatus"], {"price": (EDGES, LABELS), "net": (EDGES, LABELS)}).alias("items"))


def _bin(c: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} > {a} AND {c} <= {b} THEN '{l}'" for a, b, l in zip(EDGES, EDGES[1:], LABELS, strict=False)) + " END"


def tx(name: str, table: str) -> str:
    return f"""{name} AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, list_sort(list_filter(['flag_' || flag, 'l_linestatus_' || l_linestatus, 'price_' || {_bin('price')}, 'net_' || {_bin('(price * (1 - l_discount))')}], lambda x: x IS NOT NULL)) AS items FROM {table})"""


@query(f"WITH {BASE_SQL}, {tx('t', 'seed')} SELECT array_to_string(items, ',') AS items, count(*) AS n FROM t GROUP BY 1")
def transaction_sets(spark, d):
    return transactions(seed(spark, d)).groupBy(F.concat_ws(",", "items").alias("items")).agg(F.count("*").alias("n"))


SETS = """r AS (SELECT row_number() OVER () AS id, items FROM t), u AS (SELECT id, unnest(items) AS i FROM r),
tot AS (SELECT count(*) AS t FROM t),
s1 AS (SELECT [i] AS s, count(*) AS f FROM u GROUP BY 1), s2 AS (SELECT [a.i, b.i] AS s, count(*) AS f FROM u a JOIN u b ON a.id = b.id AND a.i < b.i GROUP BY 1),
s3 AS (SELECT [a.i, b.i, c.i] AS s, count(*) AS f FROM u a JOIN u b ON a.id = b.id AND a.i < b.i JOIN u c ON a.id = c.id AND b.i < c.i GROUP BY 1),
s4 AS (SELECT [a.i, b.i, c.i, d.i] AS s, count(*) AS f FROM u a JOIN u b ON a.id = b.id AND a.i < b.i JOIN u c ON a.id = c.id AND b.i < c.i JOIN u d ON a.id = d.id AND c.i < d.i GROUP BY 1),
allsets AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3 UNION ALL SELECT * FROM s4),
fs AS (SELECT s, f, f / (SELECT t FROM tot) AS sup FROM allsets WHERE f >= ceil({min} * (SELECT t FROM tot)))"""
RULES = """ru AS (SELECT a.s AS ant, list_sort(list_filter(i.s, lambda x: NOT list_contains(a.s, x))) AS con, i.sup AS sup, i.sup / a.sup AS conf, i.sup / a.sup / c.sup AS lift
FROM fs i JOIN fs a ON list_has_all(i.s, a.s) AND len(a.s) < len(i.s) JOIN fs c ON c.s = list_sort(list_filter(i.s, lambda x: NOT list_contains(a.s, x))) WHERE i.sup / a.sup >= 0.5)"""
_OUT = "array_to_string(ant, ',') AS antecedents, array_to_string(con, ',') AS consequents, round(sup, 6) AS support, round(conf, 6) AS confidence, round(lift, 6) AS lift"


def _text(rules):
    return rounded(rules.select(F.concat_ws(",", "antecedents").alias("antecedents"), F.concat_ws(",", "consequents").alias("consequents"), "support", "confidence", "lift"))


def _rules(spark, d, support=0.10):
    return A.association_rules(A.frequent_itemsets(transactions(seed(spark, d)).select("items"), support))


@query(f"WITH {BASE_SQL}, {tx('t', 'seed')}, {SETS.replace('{min}', '0.10')} SELECT array_to_string(s, ',') AS items, f AS freq, round(sup, 6) AS support FROM fs")
def freq_itemsets(spark, d):
    return rounded(A.frequent_itemsets(transactions(seed(spark, d)).select("items"), 0.10).select(F.concat_ws(",", "items").alias("items"), "freq", "support"))


@query(f"WITH {BASE_SQL}, {tx('t', 'seed')}, {SETS.replace('{min}', '0.10')}, {RULES} SELECT {_OUT} FROM ru")
def assoc_rules_multi(spark, d):
    return _text(_rules(spark, d))


@query(f"WITH {BASE_SQL}, {tx('t', 'seed')}, {SETS.replace('{min}', '0.10')}, {RULES} SELECT {_OUT} FROM ru WHERE sup >= 0.20 AND conf >= 0.80")
def hard_rules(spark, d):
    return _text(A.hard_rules(_rules(spark, d), 0.20, 0.80))


_SOFT = """so AS (SELECT *, row_number() OVER (PARTITION BY con ORDER BY lift DESC, sup DESC, ant, con) AS at_ FROM ru WHERE len(con) = 1 AND conf < 0.95)"""


@query(f"WITH {BASE_SQL}, {tx('t', 'seed')}, {SETS.replace('{min}', '0.10')}, {RULES}, {_SOFT} SELECT {_OUT} FROM so WHERE at_ <= 3 ORDER BY so.lift DESC, so.sup DESC, so.ant, so.con LIMIT 10")
def soft_prune(spark, d):
    return _text(A.soft_rules(_rules(spark, d), max_rules=10))


@query(f"WITH {BASE_SQL}, {tx('t', 'seed')}, {SETS.replace('{min}', '0.10')}, {RULES} SELECT {_OUT} FROM ru WHERE ru.conf >= 0.6 ORDER BY ru.conf * ru.lift DESC, ant, con LIMIT 5")
def narratives(spark, d):
    return _text(A.narrative_rules(_rules(spark, d), 5))


@query(f"""WITH {BASE_SQL}, {tx('t', 'seed')}, {SETS.replace('{min}', '0.20')}, {RULES}, b AS (SELECT max(sup) AS m FROM ru WHERE sup >= 0.20 AND conf >= 0.80),
l AS (SELECT max(r) AS rung FROM (SELECT unnest([0.50, 0.45, 0.40, 0.35, 0.30, 0.25, 0.20]::DOUBLE[]) AS r), b WHERE r <= m) SELECT rung, {_OUT} FROM ru, l WHERE ru.sup >= rung""")
def mined_rung(spark, d):
    low = A.association_rules(A.frequent_itemsets(transactions(seed(spark, d)).select("items"), 0.20))
    best = A.hard_rules(low, 0.20, 0.80).agg(F.max("support")).first()[0]
    rung = max(s for s in A.LADDER if s <= best)
    return _text(low.where(F.col("support") >= rung)).withColumn("rung", F.lit(rung))


FIXED = [(1, ["price_high"], ["net_high"]), (2, ["flag_X"], ["l_linestatus_O"]), (3, ["net_low"], ["price_low"]), (4, ["flag_A", "l_linestatus_F"], ["net_mid", "price_mid"])]
_FIXED = "ru AS (SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT, {a}, {c})" for i, a, c in FIXED) + ") t(rule_id, ant, con))"


def _fixed(spark):
    return spark.createDataFrame(FIXED, "rule_id long, antecedents array<string>, consequents array<string>")


@query(f"WITH {BASE_SQL}, {tx('t', 'synth')}, {_FIXED} SELECT rule_id, count(*) AS n_triggered, count_if(list_has_all(items, con))::BIGINT AS n_passed, count_if(NOT list_has_all(items, con))::BIGINT AS n_failed FROM t JOIN ru ON list_has_all(items, ant) GROUP BY 1")
def rule_coverage(spark, d):
    return A.rule_coverage(transactions(synth(spark, d)), _fixed(spark))


@query(f"""WITH {BASE_SQL}, {tx('t', 'synth')}, {_FIXED}, f AS (SELECT EXISTS (SELECT 1 FROM ru WHERE list_has_all(items, ant) AND NOT list_has_all(items, con)) AS bad FROM t)
SELECT count(*) AS n_rows, count_if(NOT bad)::BIGINT AS n_passed, count_if(bad)::BIGINT AS n_failed, round(avg((NOT bad)::INT), 6) AS pass_rate FROM f""")
def rows_passed(spark, d):
    return rounded(A.rows_passed(transactions(synth(spark, d)), _fixed(spark)))
