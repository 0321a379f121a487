"""Queries of the profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from .bindings import BASE_SQL, CATEGORICAL, NUMERIC, read, rounded, seed
from .catalog import query

NUM = list(NUMERIC)
CAT = list(CATEGORICAL)


def _union(template: str, columns, sep: str = " UNION ALL ") -> str:
    return sep.join(template.replace("{c}", c) for c in columns)


LONG = _union("SELECT '{c}' AS \"column\", {c}::VARCHAR AS value FROM seed", [*CAT, "l_linenumber", "tax_n"])
LONG_CAT = _union("SELECT '{c}' AS \"column\", {c}::VARCHAR AS value FROM seed", [*CAT, "l_linenumber"])


@query(f"WITH {BASE_SQL} SELECT count(*) AS n_rows, (SELECT count(*) FROM (DESCRIBE seed)) AS n_columns FROM seed")
def meta(spark, d):
    return P.table_meta(seed(spark, d))


@query("""SELECT * FROM (VALUES ('o_orderkey', 0, 'integer'), ('o_custkey', 1, 'integer'), ('o_orderstatus', 2, 'categorical'), ('o_totalprice', 3, 'float'),
('o_orderdate', 4, 'datetime'), ('o_orderpriority', 5, 'categorical')) t("column", position, semantic_type)""")
def column_types(spark, d):
    return P.infer_types(read(spark, d, "orders"))


@query(f'WITH {BASE_SQL}, v AS ({LONG}) SELECT "column", count(*) AS n_total, count(value) AS n_non_null, count(DISTINCT value) AS n_unique FROM v GROUP BY 1')
def base_stats(spark, d):
    return P.base_stats(seed(spark, d), [*CAT, "l_linenumber", "tax_n"])


@query(f"""WITH {BASE_SQL}, m AS ({_union('SELECT ' + "'{c}'" + ' AS "column", count_if({c} IS NULL)::BIGINT AS "count", count(*) AS n FROM seed', [*CAT, *NUM])})
SELECT "column", "count", round("count" / n::DOUBLE, 6) AS rate FROM m WHERE "count" > 0""")
def missing(spark, d):
    return P.missingness(seed(spark, d), [*CAT, *NUM])


_MOM = """SELECT '{c}' AS "column", min({c}) AS mn, max({c}) AS mx, avg({c}) AS m, quantile_cont({c}, 0.5) AS md, stddev_samp({c}) AS sd, var_samp({c}) AS vr,
 (avg({c} * {c} * {c}) - 3 * avg({c}) * avg({c} * {c}) + 2 * pow(avg({c}), 3)) / pow(var_pop({c}), 1.5) AS sk, kurtosis_pop({c}) AS ku FROM s"""
_RATIO = "s AS (SELECT l_quantity, price / 1000 AS price_k, l_discount, tax_n FROM seed)"


@query(f"""WITH {BASE_SQL}, {_RATIO}, m AS ({_union(_MOM, ['l_quantity', 'price_k', 'l_discount', 'tax_n'])})
SELECT "column", round(round(mn, 6), 4) AS min, round(round(mx, 6), 4) AS max, round(round(m, 6), 4) AS mean, round(round(md, 6), 4) AS median, round(round(sd, 6), 4) AS std, round(round(vr, 6), 4) AS variance, round(round(sk, 6), 4) + 0.0 AS skewness, round(round(ku, 6), 4) + 0.0 AS kurtosis FROM m""")
def numeric_summary(spark, d):
    df = seed(spark, d).withColumn("price_k", F.col("price") / 1000)
    return rounded(P.numeric_summary(df, ["l_quantity", "price_k", "l_discount", "tax_n"]), 4)


@query(f"""WITH {BASE_SQL}, q AS ({_union("SELECT '{c}' AS \"column\", unnest([0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]::DOUBLE[]) AS prob, unnest(quantile_cont({c}, [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99])) AS value FROM seed", NUM)})
SELECT "column", prob, round(value::DOUBLE, 6) AS value FROM q""")
def quantiles(spark, d):
    return rounded(P.quantiles(seed(spark, d), NUM))


_FREQ = f"""v AS ({LONG_CAT}), n AS (SELECT "column", value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY ALL),
f AS (SELECT *, n / sum(n) OVER (PARTITION BY "column") AS p, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS r FROM n)"""


@query(f'WITH {BASE_SQL}, {_FREQ} SELECT "column", value, n AS "count", round(p, 6) AS proportion, r::INT AS rank FROM f WHERE r <= 5')
def freq_topk(spark, d):
    return rounded(P.frequency_table(seed(spark, d), [*CAT, "l_linenumber"], top=5))


@query(f"""WITH {BASE_SQL}, {_FREQ} SELECT "column", round(max(CASE WHEN r = 1 THEN p END), 6) AS mode_frequency, max(CASE WHEN r = 1 THEN value END) AS mode,
round(-sum(p * ln(p)), 6) AS entropy_nats, round(-sum(p * ln(p)) / ln(2), 6) AS entropy_bits FROM f GROUP BY 1""")
def mode_entropy(spark, d):
    return rounded(P.mode_and_entropy(seed(spark, d), [*CAT, "l_linenumber"]))


@query("""WITH t AS (SELECT epoch_us(ts) / 1e6 AS s FROM events), g AS (SELECT s, s - lag(s) OVER (ORDER BY s) AS g FROM t)
SELECT round(min(s), 3) AS min_s, round(max(s), 3) AS max_s, round((max(s) - min(s)) / 86400, 2) AS range_days, round(quantile_cont(s, 0.5), 3) AS median_s, round(avg(g), 4) AS mean_gap_s, round(stddev_samp(g), 4) AS std_gap_s FROM g""")
def datetime_stats(spark, d):
    out = P.datetime_stats(read(spark, d, "events"), "ts")
    sec = lambda c: F.round(F.unix_micros(c) / 1e6, 3).alias(f"{c}_s")
    return out.select(sec("min"), sec("max"), "range_days", sec("median"), F.round("mean_gap_s", 4).alias("mean_gap_s"), F.round("std_gap_s", 4).alias("std_gap_s"))


@query(f"""WITH {BASE_SQL} SELECT 'open' AS "column", round(avg((l_linestatus = 'O')::INT), 6) AS true_rate, round(1 - avg((l_linestatus = 'O')::INT), 6) AS false_rate FROM seed""")
def boolean_rates(spark, d):
    return rounded(P.boolean_rates(seed(spark, d).select((F.col("l_linestatus") == "O").alias("open")), ["open"]))


_NET = ["l_quantity", "price", "net", "tax_n"]
_NET_SQL = "s AS (SELECT *, price * (1 - l_discount) AS net FROM seed)"
_PAIRS = [(a, b) for i, a in enumerate(_NET) for b in _NET[i + 1 :]]


def _net(spark, d):
    return seed(spark, d).withColumn("net", F.col("price") * (1 - F.col("l_discount")))


@query(f"WITH {BASE_SQL}, {_NET_SQL} " + " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, count_if({a} IS NOT NULL AND {b} IS NOT NULL)::BIGINT AS n, round(corr({a}, {b}), 6) + 0.0 AS r FROM s" for a, b in _PAIRS))
def pearson_pairs(spark, d):
    return rounded(P.pearson_pairs(_net(spark, d), _NET))


_RANKS = "r AS (SELECT " + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _NET) + " FROM s WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _NET) + ")"


@query(f"WITH {BASE_SQL}, {_NET_SQL}, {_RANKS} " + " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}::DOUBLE, {b}::DOUBLE), 5) + 0.0 AS r FROM r" for a, b in _PAIRS))
def spearman_pairs(spark, d):
    return rounded(P.spearman_pairs(_net(spark, d), _NET), 5)


@query(f"WITH {BASE_SQL}, {_NET_SQL}, p AS (" + " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM s" for a, b in _PAIRS) + ") SELECT col_a, col_b, round(r, 6) + 0.0 AS r FROM p WHERE abs(r) > 0.5")
def strong_pairs(spark, d):
    return rounded(P.strong_pairs(P.pearson_pairs(_net(spark, d), _NET)).select("col_a", "col_b", "r"))


_CV = [("flag", "l_linestatus"), ("band", "net_band"), ("flag", "band")]
_BANDS_SQL = "s AS (SELECT *, floor(price / 20000)::BIGINT::VARCHAR AS band, floor(price * (1 - l_discount) / 20000)::BIGINT::VARCHAR AS net_band FROM {t})"


def bands(df):
    return df.withColumn("band", F.floor(F.col("price") / 20000).cast("string")).withColumn("net_band", F.floor(F.col("price") * (1 - F.col("l_discount")) / 20000).cast("string"))


def cramers_sql(table: str) -> str:
    one = """SELECT '{a}' AS col_a, '{b}' AS col_b, (SELECT count(*) FROM {t} WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n,
 coalesce(sqrt(greatest(sum(o * o / (rt * ct)) - 1, 0) / nullif(least(count(DISTINCT x), count(DISTINCT y)) - 1, 0)), 0) AS v
 FROM (SELECT x, y, o::DOUBLE AS o, (sum(o) OVER (PARTITION BY x))::DOUBLE AS rt, (sum(o) OVER (PARTITION BY y))::DOUBLE AS ct FROM (SELECT {a}::VARCHAR AS x, {b}::VARCHAR AS y, count(*) AS o FROM {t} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL))"""
    return " UNION ALL ".join(one.replace("{a}", a).replace("{b}", b).replace("{t}", table) for a, b in _CV)


@query(f"WITH {BASE_SQL}, {_BANDS_SQL.replace('{t}', 'seed')} SELECT col_a, col_b, n, round(v, 5) AS v FROM ({cramers_sql('s')})")
def cramers_v(spark, d):
    return rounded(P.cramers_v(bands(seed(spark, d)), _CV), 5)


@query(f"WITH {BASE_SQL} " + " UNION ALL ".join(f"SELECT 'l_linestatus' AS \"binary\", '{c}' AS numeric, count_if({c} IS NOT NULL)::BIGINT AS n, round(corr((l_linestatus = 'O')::INT, {c}), 6) + 0.0 AS r FROM seed" for c in ("price", "tax_n")))
def point_biserial(spark, d):
    return rounded(P.point_biserial(seed(spark, d), ["l_linestatus"], ["price", "tax_n"]).drop("p"))


@query()
def best_distribution(spark, d):
    return P.best_distributions(seed(spark, d), ["l_quantity", "price", "l_discount"])


@query()
def shapiro_wilk(spark, d):
    return P.shapiro_wilk(read(spark, d, "customer"), ["c_acctbal"], ["c_custkey"])


@query()
def pca(spark, d):
    return P.pca(_net(spark, d), _NET)
