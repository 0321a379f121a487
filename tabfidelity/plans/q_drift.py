"""Queries of drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from .bindings import BASE_SQL, CATEGORICAL, NUMERIC, rounded, seed, synth
from .catalog import query
from .q_profile import _BANDS_SQL, _CV, _PAIRS, bands, cramers_sql

CAT, NUM = list(CATEGORICAL), list(NUMERIC)
PROBS = "[0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]"


def _flat(table: str, columns, null: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {null.replace('{c}', c) or f'{c}::VARCHAR'} AS value FROM {table}" for c in columns)


def _shares(name: str, table: str, columns, nulls: bool = False) -> str:
    src = _flat(table, columns, "coalesce({c}::VARCHAR, 'nan')" if nulls else "")
    return f"""{name} AS (SELECT "column", value, n / sum(n) OVER (PARTITION BY "column") AS p FROM (SELECT "column", value, count(*) AS n FROM ({src}) WHERE value IS NOT NULL GROUP BY ALL))"""


_PSI_CAT = f"""{_shares('e', 'seed', CAT)}, {_shares('a', 'synth', CAT, True)},
m AS (SELECT coalesce(e."column", a."column") AS "column", round(e.p, 6) AS e, a.p AS a FROM e FULL JOIN a ON e."column" = a."column" AND e.value = a.value),
g AS (SELECT "column", sum(CASE WHEN e IS NOT NULL THEN (greatest(coalesce(a, 0), 1e-4) - greatest(e, 1e-4)) * ln(greatest(coalesce(a, 0), 1e-4) / greatest(e, 1e-4)) END) AS s, count(e) AS k,
 greatest(1 - sum(e), 0) AS eo, coalesce(sum(CASE WHEN e IS NULL THEN a END), 0) AS ao FROM m GROUP BY 1),
pc AS (SELECT "column", 'categorical' AS kind, s + CASE WHEN eo > 1e-9 OR ao > 0 THEN (greatest(ao, 1e-4) - greatest(eo, 1e-4)) * ln(greatest(ao, 1e-4) / greatest(eo, 1e-4)) ELSE 0 END AS psi, k + (eo > 1e-9 OR ao > 0)::BIGINT AS n_bins FROM g)"""

_PSI_NUM = f"""q AS ({" UNION ALL ".join(f"SELECT '{c}' AS \"column\", unnest({PROBS}::DOUBLE[]) AS prob, unnest(quantile_cont({c}::DOUBLE, {PROBS})) AS edge FROM seed" for c in NUM)}),
ed AS (SELECT "column", edge, min(prob) AS prob FROM q GROUP BY ALL),
bn AS (SELECT "column", 0 AS bin, 0.0::DOUBLE AS lo UNION ALL SELECT "column", row_number() OVER (PARTITION BY "column" ORDER BY edge), prob FROM ed),
bins AS (SELECT "column", bin, coalesce(lead(lo) OVER (PARTITION BY "column" ORDER BY bin), 1.0) - lo AS e FROM (SELECT DISTINCT "column", bin, lo FROM (SELECT "column", 0 AS bin, 0.0::DOUBLE AS lo FROM ed UNION ALL SELECT "column", row_number() OVER (PARTITION BY "column" ORDER BY edge), prob FROM ed))),
x AS ({" UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS x FROM synth WHERE {c} IS NOT NULL" for c in NUM)}),
xn AS (SELECT "column", x, count(*) AS n FROM x GROUP BY ALL),
xb AS (SELECT xn."column", xn.x, xn.n, count(ed.edge) AS bin FROM xn LEFT JOIN ed ON ed."column" = xn."column" AND ed.edge < xn.x GROUP BY ALL),
ac AS (SELECT "column", bin, sum(n)::DOUBLE AS n FROM xb GROUP BY ALL), tot AS (SELECT "column", sum(n) AS t FROM ac GROUP BY 1),
pn AS (SELECT bins."column", 'numeric' AS kind, sum((coalesce(ac.n, 0) / t - e) * ln(greatest(coalesce(ac.n, 0) / t, 1e-4) / greatest(e, 1e-4))) AS psi, count(*) AS n_bins FROM bins JOIN tot USING ("column") LEFT JOIN ac ON ac."column" = bins."column" AND ac.bin = bins.bin GROUP BY 1)"""
_PSI_NUM = _PSI_NUM.replace(_PSI_NUM[_PSI_NUM.index("bn AS") : _PSI_NUM.index("bins AS")], "")
_STATUS = "CASE WHEN round(psi, 6) < 0.10 THEN 'stable' WHEN round(psi, 6) < 0.20 THEN 'monitor' ELSE 'unstable' END AS status"


@query(f'WITH {BASE_SQL}, {_PSI_CAT} SELECT "column", kind, round(psi, 6) AS psi, n_bins FROM pc')
def psi_categorical(spark, d):
    return rounded(D.psi_categorical(seed(spark, d), synth(spark, d), CAT))


@query(f'WITH {BASE_SQL}, {_PSI_NUM} SELECT "column", kind, round(psi, 6) AS psi, n_bins FROM pn')
def psi_numeric(spark, d):
    return rounded(D.psi_numeric(seed(spark, d), synth(spark, d), NUM))


_REPORT = f'{_PSI_CAT}, {_PSI_NUM}, r AS (SELECT "column", kind, round(psi, 6) AS psi, n_bins, {_STATUS} FROM (SELECT * FROM pc UNION ALL SELECT * FROM pn))'


@query(f"WITH {BASE_SQL}, {_REPORT} SELECT * FROM r")
def psi_report(spark, d):
    return D.psi_report(seed(spark, d), synth(spark, d), CAT, NUM)


@query(f"""WITH {BASE_SQL}, {_REPORT} SELECT count(*) AS n_columns, round(avg(psi), 6) AS mean_psi, arg_max("column", psi) AS worst_column, round(max(psi), 6) AS worst_psi,
count_if(status = 'stable')::BIGINT AS n_stable, count_if(status = 'monitor')::BIGINT AS n_monitor, count_if(status = 'unstable')::BIGINT AS n_unstable FROM r""")
def psi_summary(spark, d):
    return rounded(D.psi_summary(D.psi_report(seed(spark, d), synth(spark, d), CAT, NUM)))


_ALIGN = f"""{_shares('e', 'seed', CAT)}, {_shares('a', 'synth', CAT)}, m AS (SELECT coalesce(e."column", a."column") AS "column", coalesce(e.value, a.value) AS value, coalesce(e.p, 0) AS seed_p, coalesce(a.p, 0) AS synth_p
FROM e FULL JOIN a ON e."column" = a."column" AND e.value = a.value)"""
_DRIFT = f"""{_ALIGN}, dr AS (SELECT *, CASE WHEN seed_p = 0 THEN 'novel' WHEN synth_p = 0 THEN 'absent' WHEN abs(synth_p - seed_p) > 0.01 THEN 'drifted' END AS change FROM m),
dd AS (SELECT *, CASE change WHEN 'novel' THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM dr WHERE change IS NOT NULL)"""


@query(f'WITH {BASE_SQL}, {_ALIGN} SELECT "column", value, round(seed_p, 6) AS seed_p, round(synth_p, 6) AS synth_p FROM m')
def frequency_align(spark, d):
    return rounded(D.frequency_align(seed(spark, d), synth(spark, d), CAT))


@query(f'WITH {BASE_SQL}, {_DRIFT} SELECT "column", value, round(seed_p, 6) AS seed_p, round(synth_p, 6) AS synth_p, change, severity FROM dd')
def cat_drift(spark, d):
    return rounded(D.categorical_drift(seed(spark, d), synth(spark, d), CAT, 0.01))


@query(f"""WITH {BASE_SQL}, {_DRIFT} SELECT "column", value, round(seed_p, 6) AS seed_p, round(synth_p, 6) AS synth_p, change, severity FROM
(SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY abs(synth_p - seed_p) DESC, value) AS pos FROM dd) WHERE pos <= 2""")
def top_drifts(spark, d):
    return rounded(D.top_drifts(D.categorical_drift(seed(spark, d), synth(spark, d), CAT, 0.01), 2))


@query(f"WITH {BASE_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", (SELECT count(DISTINCT {c}) FROM seed) AS seed_n, (SELECT count(DISTINCT {c}) FROM synth) AS synth_n, CASE WHEN (SELECT count(DISTINCT {c}) FROM synth) > 1.2 * (SELECT count(DISTINCT {c}) FROM seed) THEN 'LOW' END AS severity" for c in [*CAT, "l_linenumber"]))
def cardinality(spark, d):
    return D.cardinality_check(seed(spark, d), synth(spark, d), [*CAT, "l_linenumber"])


_NULLS = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", (SELECT avg(({c} IS NULL)::INT) FROM seed) AS s, (SELECT avg(({c} IS NULL)::INT) FROM synth_n) AS y" for c in ["price", "tax_n", "l_quantity"])
_SYNTH_N = "synth_n AS (SELECT price, tax_n, CASE WHEN l_quantity > 40 THEN NULL ELSE l_quantity END AS l_quantity FROM synth)"


def _synth_n(spark, d):
    return synth(spark, d).withColumn("l_quantity", F.when(F.col("l_quantity") <= 40, F.col("l_quantity")))


@query(f"WITH {BASE_SQL}, {_SYNTH_N}, n AS ({_NULLS}) SELECT \"column\", round(s, 6) AS seed_rate, round(y, 6) AS synth_rate, round(abs(y - s), 6) AS error, CASE WHEN y - s > 0.05 THEN 'HIGH' END AS severity FROM n")
def null_rate(spark, d):
    return rounded(D.null_rate_check(seed(spark, d), _synth_n(spark, d), ["price", "tax_n", "l_quantity"]))


@query(f"WITH {BASE_SQL}, {_SYNTH_N}, n AS ({_NULLS}) SELECT \"column\", round(abs(y - s), 6) AS error FROM n")
def missing_err(spark, d):
    return rounded(D.null_rate_check(seed(spark, d), _synth_n(spark, d), ["price", "tax_n", "l_quantity"]).select("column", "error"))


@query(f"WITH {BASE_SQL}, {_ALIGN} SELECT count(*) AS n_classes, round(avg(abs(seed_p - synth_p)), 6) AS mae FROM m WHERE \"column\" = 'flag'")
def class_mae(spark, d):
    return rounded(D.class_mae(seed(spark, d), synth(spark, d), "flag"))


@query(f"WITH {BASE_SQL}, {_ALIGN} SELECT value, round(seed_p, 6) AS seed_p, round(synth_p, 6) AS synth_p, abs(synth_p - seed_p) > 0.03 AS flagged FROM m WHERE \"column\" = 'flag'")
def target_drift(spark, d):
    return rounded(D.target_drift(seed(spark, d), synth(spark, d), "flag"))


@query(f"""WITH {BASE_SQL}, v AS (SELECT DISTINCT s."column", s.value FROM ({_flat('synth', CAT)}) s), e AS (SELECT DISTINCT s."column", s.value FROM ({_flat('seed', CAT)}) s)
SELECT v."column", count(*) AS n_seed, count(e.value) AS n_covered, round(count(e.value) / count(*), 6) AS coverage, array_to_string(list_sort(list(v.value) FILTER (e.value IS NULL)), ',') AS missing FROM v LEFT JOIN e USING ("column", value) GROUP BY 1""")
def coverage(spark, d):
    out = rounded(D.category_coverage(synth(spark, d), seed(spark, d), CAT))  # sides changed, so that a value is missing
    return out.withColumn("missing", F.when(F.size("missing") > 0, F.concat_ws(",", "missing")))


def _ks(c: str) -> str:
    return f"""SELECT '{c}' AS "column", max(na) AS n_seed, max(nb) AS n_synth, max(abs(ca / na - cb / nb)) AS ks FROM (SELECT x, sum(a) OVER (ORDER BY x) AS ca, sum(b) OVER (ORDER BY x) AS cb, sum(a) OVER () AS na, sum(b) OVER () AS nb
 FROM (SELECT x, sum(a)::BIGINT AS a, sum(b)::BIGINT AS b FROM (SELECT {c} AS x, 1 AS a, 0 AS b FROM seed WHERE {c} IS NOT NULL UNION ALL SELECT {c}, 0, 1 FROM synth WHERE {c} IS NOT NULL) GROUP BY x))"""


@query(f"WITH {BASE_SQL}, k AS ({' UNION ALL '.join(map(_ks, NUM))}) SELECT \"column\", n_seed::BIGINT AS n_seed, n_synth::BIGINT AS n_synth, round(ks, 6) AS ks FROM k")
def ks_2samp(spark, d):
    return rounded(D.ks_two_sample(seed(spark, d), synth(spark, d), NUM))


_NETS = "sn AS (SELECT *, price * (1 - l_discount) AS net FROM seed), yn AS (SELECT *, price * (1 - l_discount) AS net FROM synth)"


def _with_net(df):
    return df.withColumn("net", F.col("price") * (1 - F.col("l_discount")))


@query(f"WITH {BASE_SQL}, {_NETS}, p AS (" + " UNION ALL ".join(f"SELECT (SELECT corr({a}, {b}) FROM sn) AS ra, (SELECT corr({a}, {b}) FROM yn) AS rb" for a, b in _PAIRS) + ") SELECT count(*) AS n_pairs, round(avg(abs(ra - rb)), 6) AS mae FROM p")
def corr_mae(spark, d):
    return rounded(D.correlation_mae(_with_net(seed(spark, d)), _with_net(synth(spark, d)), ["l_quantity", "price", "net", "tax_n"]))


@query(f"""WITH {BASE_SQL}, {_BANDS_SQL.replace('{t}', 'seed')}, s2 AS ({_BANDS_SQL.replace('{t}', 'synth')[len('s AS ('):-1]}), a AS ({cramers_sql('s')}), b AS ({cramers_sql('s2')})
SELECT a.col_a, a.col_b, round(a.v, 5) AS seed_v, round(b.v, 5) AS synth_v, round(abs(b.v - a.v), 5) AS drift, CASE WHEN abs(b.v - a.v) > 0.30 THEN 'HIGH' WHEN abs(b.v - a.v) > 0.15 THEN 'MEDIUM' END AS severity FROM a JOIN b USING (col_a, col_b)""")
def cramers_drift(spark, d):
    return rounded(D.cramers_drift(bands(seed(spark, d)), bands(synth(spark, d)), _CV), 5)


@query("SELECT * FROM (VALUES ('price', 'missing'), ('total', 'extra')) t(\"column\", change)")
def schema_diff(spark, d):
    s = seed(spark, d).select("flag", "price")
    return D.schema_diff(s, s.withColumnRenamed("price", "total"))


def _fidelity(cand: str) -> str:
    both = [*CAT, *["l_quantity", "price"]]
    ks = " UNION ALL ".join(_ks(c).replace("FROM synth", f"FROM {cand}") for c in ("l_quantity", "price"))
    return f"""SELECT 'class_mae' AS metric, (SELECT avg(abs(coalesce(x.p, 0) - coalesce(y.p, 0))) FROM (SELECT flag, count(*) / (SELECT count(*) FROM seed) AS p FROM seed GROUP BY 1) x FULL JOIN (SELECT flag, count(*) / (SELECT count(*) FROM {cand}) AS p FROM {cand} GROUP BY 1) y USING (flag)) AS v
UNION ALL SELECT 'mean_ks', (SELECT avg(ks) FROM ({ks}))
UNION ALL SELECT 'coverage', (SELECT avg(c) FROM ({' UNION ALL '.join(f"SELECT (SELECT count(DISTINCT {c}) FROM seed WHERE {c} IN (SELECT {c} FROM {cand})) / (SELECT count(DISTINCT {c}) FROM seed) AS c" for c in CAT)}))
UNION ALL SELECT 'correlation_mae', abs((SELECT corr(l_quantity, price) FROM seed) - (SELECT corr(l_quantity, price) FROM {cand}))
UNION ALL SELECT 'missingness_error', (SELECT avg(e) FROM ({' UNION ALL '.join(f"SELECT abs((SELECT avg(({c} IS NULL)::INT) FROM seed) - (SELECT avg(({c} IS NULL)::INT) FROM {cand})) AS e" for c in both)}))"""


@query(f"""WITH {BASE_SQL}, other AS (SELECT * FROM synth WHERE flag <> 'X'), a AS ({_fidelity('synth')}), b AS ({_fidelity('other')}),
m AS (SELECT metric, a.v AS a, b.v AS b, CASE metric WHEN 'coverage' THEN a.v - b.v ELSE b.v - a.v END AS g FROM a JOIN b USING (metric))
SELECT metric, round(a, 6) AS a, round(b, 6) AS b, CASE WHEN abs(g) < 1e-4 THEN 'tie' WHEN g > 0 THEN 'a' ELSE 'b' END AS winner FROM m""")
def ab_winner(spark, d):
    s, y = seed(spark, d), synth(spark, d)
    one = lambda c: D.fidelity_scores(s, c, "flag", CAT, ["l_quantity", "price"])
    return rounded(D.ab_tally(one(y), one(y.where("flag <> 'X'"))))
