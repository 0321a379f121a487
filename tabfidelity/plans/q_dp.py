"""Queries of differential privacy. Noise comes from md5, so another engine draws the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rng
from ..operators import dp as X
from ..operators import profile as P
from .bindings import BASE_SQL, CATEGORICAL, read, rounded, seed
from .catalog import query
from .q_profile import _FREQ, _MOM

EPS = 0.01


def usql(*key: str, no: int | str = 42) -> str:
    return f"((('0x' || substr(md5(concat_ws(':', '{no}', {', '.join(f'({k})::VARCHAR' for k in key)})), 1, 8))::UBIGINT::DOUBLE + 0.5) / 4294967296.0::DOUBLE)"


def lsql(scale: str, *key: str) -> str:
    u = f"({usql(*key)} - 0.5)"
    return f"(CASE WHEN ({scale}) > 0 THEN -({scale}) * sign({u}) * ln(1 - 2 * abs({u})) ELSE 0 END)"


@query(f"SELECT c_custkey, round({usql('c_custkey')}, 9) AS u, round({lsql('2.0::DOUBLE', 'c_custkey')}, 6) AS noise FROM customer")
def hash_noise(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k, F.round(rng.uniform(42, k), 9).alias("u"), F.round(rng.laplace(2.0, 42, k), 6).alias("noise"))


_NOISED = f"""{_FREQ}, z AS (SELECT "column", value, greatest(0, n + {lsql(f'(2.0 / {EPS})::DOUBLE', '"column"', 'value')}) AS c FROM f),
p AS (SELECT "column", value, c, c / CASE WHEN sum(c) OVER (PARTITION BY "column") > 0 THEN sum(c) OVER (PARTITION BY "column") ELSE 1 END AS p FROM z)"""


def _noised(spark, d):
    freq = P.frequency_table(seed(spark, d), [*CATEGORICAL, "l_linenumber"], None)
    return X.dp_proportions(freq, EPS)


@query(f'WITH {BASE_SQL}, {_NOISED} SELECT "column", value, round(c, 4) AS "count", round(p, 6) AS proportion FROM p')
def dp_proportions(spark, d):
    return _noised(spark, d).select("column", "value", F.round("count", 4).alias("count"), "proportion")


@query(f'WITH {BASE_SQL}, {_NOISED} SELECT "column", arg_min(value, (-round(p, 6), value)) AS mode, max(round(p, 6)) AS mode_frequency FROM p GROUP BY 1')
def dp_modes(spark, d):
    return X.dp_modes(_noised(spark, d))


_COLS = ["l_quantity", "l_discount", "tax_n"]
_SUMM = " UNION ALL ".join(_MOM.replace("{c}", c).replace("FROM s", "FROM seed") for c in _COLS)
_SC = f"(greatest(mx - mn, 1e-9) / (SELECT count(*) FROM seed)::DOUBLE / {EPS}::DOUBLE)"


@query(f"""WITH {BASE_SQL}, m AS ({_SUMM}), r AS (SELECT "column", round(mn, 6) AS mn, round(mx, 6) AS mx, round(m, 6) AS m, round(md, 6) AS md, round(sd, 6) AS sd FROM m)
SELECT "column", mn AS min, mx AS max, round(least(greatest(m + {lsql(_SC, '"column"', "'mean'")}, mn), mx), 6) AS mean, round(least(greatest(md + {lsql(_SC, '"column"', "'median'")}, mn), mx), 6) AS median,
round(greatest(sd + {lsql(_SC, '"column"', "'std'")}, 0), 6) AS std FROM r""")
def dp_numeric(spark, d):
    df = seed(spark, d)
    return X.dp_numeric(P.numeric_summary(df, _COLS), df.count(), EPS)


_Q = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", unnest([0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]::DOUBLE[]) AS prob, unnest(quantile_cont({c}::DOUBLE, [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99])) AS value, (SELECT min({c}) FROM seed) AS mn, (SELECT max({c}) FROM seed) AS mx FROM seed" for c in _COLS)


@query(f"""WITH {BASE_SQL}, q AS ({_Q}),
g AS (SELECT *, greatest(0, greatest(0, value - coalesce(lag(value) OVER w, mn)) + {lsql(_SC, '"column"', 'prob')}) AS g, greatest(0, greatest(0, mx - last_value(value) OVER (PARTITION BY "column" ORDER BY prob ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) + {lsql(_SC, '"column"', "'tail'")}) AS tl FROM q WINDOW w AS (PARTITION BY "column" ORDER BY prob)),
t AS (SELECT *, sum(g) OVER (PARTITION BY "column") + tl AS total FROM g)
SELECT "column", prob, round(mn + sum(g) OVER (PARTITION BY "column" ORDER BY prob) * CASE WHEN total > 0 THEN greatest(mx - mn, 1e-9) / total ELSE 0 END, 4) AS value FROM t""")
def dp_quantile_gaps(spark, d):
    df = seed(spark, d)
    ends = P.numeric_summary(df, _COLS).select("column", "min", "max")
    return X.dp_quantiles(P.quantiles(df, _COLS), ends, df.count(), EPS)


@query(f"""WITH {BASE_SQL}, m AS (SELECT 'tax_n' AS "column", count_if(tax_n IS NULL) AS c, count(*) AS n FROM seed),
w AS (SELECT *, trunc(least(greatest(n - c + {lsql(f'(1.0 / {EPS})::DOUBLE', '"column"', "'non_null'")}, 0), n))::BIGINT AS there FROM m)
SELECT "column", (n - there)::BIGINT AS "count", round((n - there) / n, 6) AS rate FROM w""")
def dp_missing(spark, d):
    df = seed(spark, d)
    out = X.dp_missing(P.missingness(df, ["tax_n", "price"]), df.count(), EPS)
    return out.select("column", F.col("count").cast("bigint").alias("count"), "rate")


@query()
def dp_corr(spark, d):
    df = seed(spark, d).withColumn("net", F.col("price") * (1 - F.col("l_discount")))
    cols = ["l_quantity", "price", "net"]
    return X.dp_correlations(P.pearson_pairs(df, cols), cols, df.count(), 1.0)


@query(f'WITH {BASE_SQL}, {_NOISED}, j AS (SELECT abs(round(f.p, 9) - round(p.p, 6)) AS dd FROM f JOIN p USING ("column", value)) SELECT count(*) AS n, round(max(dd), 5) AS max_drift, round(avg(dd), 5) AS mean_drift FROM j WHERE dd > 0')
def dp_drift(spark, d):
    raw = P.frequency_table(seed(spark, d), [*CATEGORICAL, "l_linenumber"], None)
    return rounded(X.dp_drift(raw, X.dp_proportions(raw, EPS), ["column", "value"], "proportion"), 5)
