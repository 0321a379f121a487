"""Queries of privacy risk."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import privacy as V
from .bindings import BASE_SQL, PEOPLE_SQL, QI, people, read, rounded, seed, synth
from .catalog import query

QIS = ", ".join(QI)
_K = "round(avg((size < 5)::INT), 6)"


@query(f"""WITH {PEOPLE_SQL}, g AS (SELECT {QIS}, count(*) AS size FROM people GROUP BY ALL)
SELECT count(*) AS n_groups, min(size) AS min_size, count_if(size < 5)::BIGINT AS n_violations, {_K} AS violation_rate, {_K} AS pct_below_5, round(avg((size < 11)::INT), 6) AS pct_below_11,
CASE WHEN count_if(size < 5) = 0 THEN NULL WHEN avg((size < 5)::INT) > 0.20 THEN 'CRITICAL' WHEN avg((size < 5)::INT) > 0.05 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM g""")
def k_anonymity(spark, d):
    return rounded(V.k_anonymity(people(spark, d), QI))


_NULLY = "nullif(o_orderpriority, '5-LOW')"


@query(f"""WITH {PEOPLE_SQL}, s AS (SELECT * REPLACE ({_NULLY} AS o_orderpriority) FROM pseed), y AS (SELECT * REPLACE ({_NULLY} AS o_orderpriority) FROM psynth),
g AS (SELECT {QIS}, count(*) AS size FROM s WHERE o_orderpriority IS NOT NULL GROUP BY ALL), m AS (SELECT y.*, size FROM y LEFT JOIN g USING ({QIS})),
o AS (SELECT count(*) AS n, avg(coalesce(size = 1, false)::INT) AS u, avg((size IS NULL)::INT) AS nm, avg(size) AS mg, avg(coalesce(size <= 5, false)::INT) AS ps FROM m)
SELECT n, round(u, 6) AS unique_link_rate, round(nm, 6) AS no_match_rate, round(mg, 6) AS mean_group, round(ps, 6) AS pct_small, CASE WHEN u > 0.10 THEN 'HIGH' WHEN u > 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS severity, u <= 0.05 AS passed FROM o""")
def linkage(spark, d):
    df = people(spark, d).withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    return rounded(V.record_linkage(df.where("o_orderkey % 2 = 1"), df.where("o_orderkey % 2 = 0"), QI))


_COLS = ("l_quantity", "l_discount", "tax_n", "l_returnflag", "l_linestatus", "l_linenumber")
_COLS_SQL = ", ".join(_COLS)
_SAME = " AND ".join(f"y.{c} IS NOT DISTINCT FROM s.{c}" for c in _COLS)


@query(f"""WITH {BASE_SQL}, s AS (SELECT DISTINCT {_COLS_SQL}, true AS there FROM seed), m AS (SELECT there FROM synth y LEFT JOIN s ON {_SAME}),
o AS (SELECT count(*) AS n, count(there) AS n_leaked FROM m)
SELECT n, n_leaked, round(n_leaked / n, 6) AS rate, CASE WHEN n_leaked / n > 0.1 THEN 'CRITICAL' WHEN n_leaked / n > 0.01 THEN 'HIGH' END AS severity FROM o""")
def leakage_semi(spark, d):
    return rounded(V.row_leakage(synth(spark, d), seed(spark, d), _COLS))


@query(f"""WITH {BASE_SQL}, s AS (SELECT DISTINCT {_COLS_SQL}, true AS there FROM seed), y AS (SELECT {_COLS_SQL}, count(*) AS m FROM synth GROUP BY ALL), j AS (SELECT m, there FROM y LEFT JOIN s ON {_SAME})
SELECT sum(m)::BIGINT AS n_rows, count(*) AS n_distinct, count(there) AS n_in_seed, round(count(*) / sum(m), 6) AS diversity, count(*) / sum(m) < 0.05 AS mode_collapse FROM j""")
def diversity(spark, d):
    return rounded(V.diversity(synth(spark, d), seed(spark, d), _COLS))


def _hash(seed_no: int | str, columns) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{seed_no}', {', '.join(f'{c}::VARCHAR' for c in columns)})), 1, 8))::UBIGINT"


_P = ("o_orderkey",)
_NN_CAT, _NN_NUM = ("o_orderstatus", "o_orderpriority"), ("o_totalprice", "day")
_ORD = f"""o AS (SELECT *, epoch(o_orderdate) / 86400 AS day, {_hash(42, _P)} AS h FROM orders),
ss AS (SELECT *, row_number() OVER (ORDER BY h, o_orderkey) AS at_ FROM o WHERE o_orderkey % 2 = 0 QUALIFY at_ <= 4000),
train AS (SELECT * FROM ss WHERE at_ % 2 = 1), holdout AS (SELECT * FROM ss WHERE at_ % 2 = 0), ours AS (SELECT * FROM o WHERE o_orderkey % 2 = 1 ORDER BY h, o_orderkey LIMIT 2000)"""


def _scale(*frames: str) -> str:
    both = " UNION ALL ".join(f"SELECT o_totalprice, day FROM {f}" for f in frames)
    return f"sc AS (SELECT max(o_totalprice) - min(o_totalprice) AS w1, max(day) - min(day) AS w2 FROM ({both}))"


_DIST = "((q.o_orderstatus <> r.o_orderstatus)::INT + (q.o_orderpriority <> r.o_orderpriority)::INT + abs(q.o_totalprice / w1 - r.o_totalprice / w1) + abs(q.day / w2 - r.day / w2)) / 4.0::DOUBLE"


def _near(name: str, q: str, r: str, other: bool = False) -> str:
    return f"{name} AS (SELECT q.o_orderkey, min({_DIST}) AS distance FROM {q} q, {r} r, sc {'WHERE q.o_orderkey <> r.o_orderkey' if other else ''} GROUP BY 1)"


def _orders(spark, d):
    df = read(spark, d, "orders").withColumn("day", F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1e6 / 86400)
    return df.where("o_orderkey % 2 = 1"), df.where("o_orderkey % 2 = 0")


@query(f"WITH {_ORD}, {_scale('ours', 'train')}, {_near('n', 'ours', 'train')} SELECT o_orderkey, round(distance, 6) AS distance FROM n")
def gower_nn(spark, d):
    y, s = _orders(spark, d)
    train, _ = V.disjoint_samples(s, V.SAMPLE, _P)
    return rounded(V.gower_nearest(V.sample(y, V.SAMPLE, _P), train, _NN_CAT, _NN_NUM, _P))


@query(f"WITH {_ORD}, {_scale('ours', 'ours')}, {_near('n', 'ours', 'ours', True)} SELECT o_orderkey, round(distance, 6) AS distance FROM n")
def nndr_self(spark, d):
    y, _ = _orders(spark, d)
    ours = V.sample(y, V.SAMPLE, _P)
    return rounded(V.gower_nearest(ours, ours, _NN_CAT, _NN_NUM, _P, exclude_self=True))


@query(f"""WITH {_ORD}, {_scale('ours', 'train', 'holdout')}, {_near('a', 'train', 'ours')}, {_near('b', 'holdout', 'ours')},
s AS (SELECT round(distance, 9) AS x, distance, 1 AS y FROM a UNION ALL SELECT round(distance, 9), distance, 0 FROM b),
u AS (SELECT (SELECT sum((p.x > q.x)::INT + 0.5 * (p.x = q.x)::INT) FROM s p, s q WHERE p.y = 1 AND q.y = 0) / (count_if(y = 1) * count_if(y = 0)) AS raw, avg(distance) FILTER (y = 1) AS m1, avg(distance) FILTER (y = 0) AS m0 FROM s),
v AS (SELECT (CASE WHEN m1 >= m0 THEN raw ELSE 1 - raw END)::DOUBLE AS auc FROM u)
SELECT round(auc, 6) AS auc, CASE WHEN auc > 0.75 THEN 'CRITICAL' WHEN auc > 0.60 THEN 'HIGH' ELSE 'LOW' END AS severity, auc <= 0.60 AS passed FROM v""")
def mia_auc(spark, d):
    y, s = _orders(spark, d)
    return rounded(V.membership_inference(y, s, _NN_CAT, _NN_NUM, _P))


@query(f"""WITH {_ORD}, few AS (SELECT * FROM ours ORDER BY h, o_orderkey LIMIT 500), {_scale('ours', 'train', 'holdout')}, {_near('a', 'ours', 'train')}, {_near('b', 'holdout', 'train')}, {_near('c', 'few', 'few', True)},
ov AS (SELECT avg(distance) AS ms, quantile_cont(distance, 0.05) AS p5, quantile_cont(distance, 0.5) AS p50, avg((distance < 0.1)::INT) AS sb, (SELECT avg(distance) FROM b) AS mh, (SELECT avg(a.distance / greatest(c.distance, 1e-9)) FROM a JOIN c USING (o_orderkey)) AS nr FROM a)
SELECT round(ms, 6) AS mean_synth, round(p5, 6) AS p5, round(p50, 6) AS p50, round(sb, 6) AS share_below, round(mh, 6) AS mean_holdout, round(nr, 6) AS mean_nndr, round(ms / greatest(mh, 1e-9), 6) AS dcr_ratio,
CASE WHEN ms / greatest(mh, 1e-9) < 0.50 THEN 'HIGH' WHEN ms / greatest(mh, 1e-9) < 0.80 THEN 'MEDIUM' END AS dcr_severity, CASE WHEN nr < 0.20 THEN 'HIGH' END AS nndr_severity FROM ov""")
def dcr_nndr(spark, d):
    y, s = _orders(spark, d)
    return rounded(V.closest_records(y, s, _NN_CAT, _NN_NUM, _P))


def _nmi_sql(table: str, sens: str, qi: str) -> str:
    h = lambda by: f"(SELECT -sum(n / t * ln(n / t)) FROM (SELECT count(*) AS n, (SELECT count(*) FROM {table}) AS t FROM {table} GROUP BY {by}))"
    return f"(2 * ({h(sens)} + {h(qi)} - {h(sens + ', ' + qi)}) / ({h(sens)} + {h(qi)}))"


@query(f"""WITH {PEOPLE_SQL}, o AS (SELECT {_nmi_sql('psynth', 'o_orderpriority', 'c_nationkey, c_mktsegment')} AS y, {_nmi_sql('pseed', 'o_orderpriority', 'c_nationkey, c_mktsegment')} AS s)
SELECT round(y, 6) AS synth_nmi, round(s, 6) AS seed_nmi, round(least(1.0, greatest(0.0, y - s) / greatest(s, 0.01)), 5) AS risk FROM o""")
def nmi(spark, d):
    df = people(spark, d)
    out = V.attribute_disclosure(df.where("o_orderkey % 2 = 1"), df.where("o_orderkey % 2 = 0"), "o_orderpriority", ["c_nationkey", "c_mktsegment"])
    return out.select(F.round("synth_nmi", 6).alias("synth_nmi"), F.round("seed_nmi", 6).alias("seed_nmi"), F.round("risk", 5).alias("risk"))


_RISKS = [(1, 0.5, 1.0, 1.0, 0.0, 0.0, 1000.0, 0.0), (2, 0.8, 0.4, 0.1, 0.2, 0.5, 20.0, 0.7), (3, 1.0, 0.0, 0.0, 1.0, 1.0, 1.0, 1.0)]
_BAND = "CASE WHEN {c} < 0.33 THEN 'LOW' WHEN {c} < 0.66 THEN 'MEDIUM' ELSE 'HIGH' END AS {c}_band"


@query(f"""WITH m AS (SELECT * FROM (VALUES {', '.join(map(str, _RISKS))}) t(id, mia, dcr, nn, u, ps, mg, ar)),
r AS (SELECT round((0.5 * greatest(0, (mia - 0.5) / 0.5) + 0.3 * greatest(0, 1 - dcr / 0.8) + 0.2 * greatest(0, 1 - least(nn, 10) / 0.2))::DOUBLE, 4) AS identity, round((0.5 * u + 0.3 * ps + 0.2 * greatest(0, 1 - least(mg, 100) / 100))::DOUBLE, 4) AS linkage, round(ar::DOUBLE, 4) AS attribute FROM m),
o AS (SELECT *, greatest(identity, linkage, attribute) AS overall FROM r) SELECT *, {', '.join(_BAND.replace('{c}', c) for c in ('identity', 'linkage', 'attribute', 'overall'))} FROM o""")
def residual_risk(spark, d):
    m = spark.createDataFrame(_RISKS, "id int, mia_auc double, dcr_ratio double, mean_nndr double, unique_link_rate double, pct_small double, mean_group double, attribute_risk double")
    return V.residual_risk(m)


