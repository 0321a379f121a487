"""Queries of the prompt and report layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import prompts as T
from .bindings import BASE_SQL, rounded, seed
from .catalog import query
from .q_profile import _FREQ, _NET, _NET_SQL, _PAIRS

_Q = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", quantile_cont({c}::DOUBLE, 0.25) AS p25, quantile_cont({c}::DOUBLE, 0.5) AS p50, quantile_cont({c}::DOUBLE, 0.75) AS p75, min({c}) AS mn, max({c}) AS mx, (avg({c} * {c} * {c}) - 3 * avg({c}) * avg({c} * {c}) + 2 * pow(avg({c}), 3)) / pow(var_pop({c}), 1.5) AS sk FROM seed" for c in ("zi", "l_quantity", "l_tax"))
_P = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM s" for a, b in _PAIRS)


def _parts(spark, d):
    df = seed(spark, d)
    net = df.withColumn("net", F.col("price") * (1 - F.col("l_discount")))
    nums = ["zi", "l_quantity", "l_tax"]
    return P.frequency_table(df, ["flag", "l_linestatus", "l_linenumber"], None), P.numeric_summary(df, nums), P.quantiles(df, nums), P.pearson_pairs(net, _NET)


@query(f"""WITH {BASE_SQL}, {_NET_SQL}, {_FREQ}, q AS ({_Q}), c AS ({_P})
SELECT 'target' AS kind, "column", value, round(p, 5) AS number FROM f WHERE "column" = 'flag'
UNION ALL SELECT CASE WHEN p > 0.70 THEN 'dominant' ELSE 'rare' END, "column", value, round(p, 5) FROM f WHERE "column" <> 'flag' AND (p > 0.70 OR p < 0.08)
UNION ALL SELECT CASE WHEN p50 = 0 AND p75 = 0 THEN 'mostly_zero' WHEN p50 = 0 THEN 'half_zero' ELSE 'skewed' END, "column", NULL, round(round(sk, 6), 5) FROM q WHERE p50 = 0 OR abs(sk) > 2
UNION ALL SELECT CASE WHEN r > 0 THEN 'positive' ELSE 'inverse' END, a, b, round(r, 5) FROM c WHERE abs(r) > 0.35""")
def reminders(spark, d):
    f, s, q, c = _parts(spark, d)
    return rounded(T.reminders(f, s, q, c, "flag"), 5)


@query(f"""WITH {BASE_SQL}, {_FREQ}, q AS ({_Q})
SELECT 'include' AS kind, "column", value, round(p, 5) AS number FROM f WHERE "column" <> 'flag' AND p > 0.03 AND p < 0.20
UNION ALL SELECT 'spread', "column", NULL, round((p75 - p25) / (mx - mn), 5) FROM q WHERE NOT (p50 = 0 AND p75 = 0) AND (p75 - p25) / (mx - mn) < 0.25""")
def diversity_hints(spark, d):
    f, s, q, _ = _parts(spark, d)
    return rounded(T.diversity_hints(f, s, q, "flag"), 5)


@query(f"WITH {BASE_SQL}, {_NET_SQL}, c AS ({_P}) SELECT least(a, b) AS col_a, greatest(a, b) AS col_b, round(r, 5) + 0.0 AS r FROM c ORDER BY abs(c.r) DESC LIMIT 3")
def corr_pairs_topk(spark, d):
    return rounded(T.top_pairs(_parts(spark, d)[3].select("col_a", "col_b", "r"), 3), 5)


@query("""WITH z AS (SELECT *, (abs((o_totalprice - avg(o_totalprice) OVER w) / (stddev_samp(o_totalprice) OVER w + 1e-9)) + abs((o_custkey - avg(o_custkey) OVER w) / (stddev_samp(o_custkey) OVER w + 1e-9))) / 2 AS z FROM orders WINDOW w AS (PARTITION BY o_orderstatus)),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY z, o_orderkey) AS a, row_number() OVER (PARTITION BY o_orderstatus ORDER BY z DESC, o_orderkey) AS b FROM z)
SELECT 'typical' AS kind, o_orderstatus, o_orderkey, round(z, 5) AS mean_abs_z FROM r WHERE a <= 2 UNION ALL SELECT 'extreme', o_orderstatus, o_orderkey, round(z, 5) FROM r WHERE b <= 2""")
def exemplars(spark, d):
    from .bindings import read

    out = T.exemplars(read(spark, d, "orders"), "o_orderstatus", ["o_totalprice", "o_custkey"], ["o_orderkey"])
    return rounded(out.select("kind", "o_orderstatus", "o_orderkey", "mean_abs_z"), 5)


