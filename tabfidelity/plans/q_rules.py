"""Queries of the rule compiler and the plausibility checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce, text
from ..operators import rules as R
from ..spec import Bound, GroupRule, Rule
from .bindings import BASE_SQL, KEY, read, rounded, seed, synth
from .catalog import query

BOUNDS = [Bound("l_quantity", 2, 45), Bound("price", None, 90000), Bound("tax_n", 0.01, None), Bound("not_there", 0, 1)]
RULES = [
    Rule("cheap", "price", "<", 60000, "HIGH"), Rule("taxed", "tax_n", ">=", 0.02, "LOW"), Rule("taxed_if_known", "tax_n", ">=", 0.02, "LOW", nulls="ignore"),
    Rule("mid_quantity", "l_quantity", "between", [5, 45], "MEDIUM"), Rule("known_flag", "flag", "in", ["A", "N", "R"], "CRITICAL"), Rule("not_open", "l_linestatus", "not_in", ["O"], "LOW"),
    Rule("one_line", "l_linenumber", "==", 1, "LOW"), Rule("text_is_no_number", "flag", ">", 0, "LOW"), Rule("absent", "not_there", ">", 0, "CRITICAL"),
]
_BROKEN = [
    ("cheap", "HIGH", 4, "NOT price < 60000"), ("taxed", "LOW", 1, "coalesce(NOT tax_n >= 0.02, true)"), ("taxed_if_known", "LOW", 1, "coalesce(NOT tax_n >= 0.02, false)"), ("mid_quantity", "MEDIUM", 2, "NOT l_quantity BETWEEN 5 AND 45"),
    ("known_flag", "CRITICAL", 0, "flag NOT IN ('A', 'N', 'R')"), ("not_open", "LOW", 1, "l_linestatus = 'O'"), ("one_line", "LOW", 1, "l_linenumber <> 1"), ("text_is_no_number", "LOW", 1, "true"),
]
_VIOL = "v AS (" + " UNION ALL ".join(f"SELECT '{n}' AS rule, '{s}' AS severity, count(*) AS n_total, count_if({c})::BIGINT AS n_violated FROM synth" for n, s, _, c in _BROKEN) + ")"


@query(f"""WITH {BASE_SQL}, b AS (SELECT 'l_quantity' AS "column", count(l_quantity) AS n, count_if(l_quantity < 2 OR l_quantity > 45)::BIGINT AS n_out FROM synth
UNION ALL SELECT 'price', count(price), count_if(price > 90000)::BIGINT FROM synth UNION ALL SELECT 'tax_n', count(tax_n), count_if(tax_n < 0.01)::BIGINT FROM synth)
SELECT "column", n, n_out, round(n_out / n, 6) AS rate, CASE WHEN n_out = 0 THEN NULL WHEN n_out / n > 0.10 THEN 'CRITICAL' WHEN n_out / n > 0.02 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM b""")
def bounds(spark, d):
    return rounded(R.bounds_check(synth(spark, d), BOUNDS))


@query(f"WITH {BASE_SQL}, {_VIOL} SELECT *, round(n_violated / n_total, 6) AS rate FROM v")
def rule_violations(spark, d):
    return rounded(R.rule_violations(synth(spark, d), RULES))


@query(f"""WITH {BASE_SQL}, b AS ({" UNION ALL ".join(f"SELECT '{n}' AS rule, * FROM synth WHERE {c}" for n, _, _, c in _BROKEN)}),
r AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY {", ".join(KEY)}) AS pos FROM b) SELECT rule, pos::INT AS pos, l_orderkey, l_linenumber FROM r WHERE pos <= 3""")
def violation_samples(spark, d):
    return R.violation_samples(synth(spark, d), RULES, KEY).select("rule", F.col("at").alias("pos"), "l_orderkey", "l_linenumber")


@query(f"""WITH {BASE_SQL}, {_VIOL}, w AS (SELECT *, CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END AS w FROM v)
SELECT round(100 * (1 - sum(w * n_violated / n_total) / sum(w)), 2) AS score FROM w""")
def plausibility_score(spark, d):
    return R.plausibility_score(R.rule_violations(synth(spark, d), RULES))


GROUPS = [
    GroupRule("open_costs_more", "l_linestatus", "O", "F", "price", ">", "mean", severity="HIGH"), GroupRule("flags", "flag", {"in": ["A", "R"]}, "N", "l_quantity", "<=", "mean"),
    GroupRule("share_of_open", "flag", {"!=": "N"}, {"==": "N"}, "l_linestatus", ">=", "proportion", ("O",)), GroupRule("untaxed", "tax_n", None, {"not_in": ["nan"]}, "price", "<", "mean"), GroupRule("empty_side", "flag", "none", "N", "price", ">"),
]


@query(f"""WITH {BASE_SQL}, g AS (
SELECT 'open_costs_more' AS rule, 'HIGH' AS severity, '>' AS dir, avg(price) FILTER (l_linestatus = 'O') AS a, avg(price) FILTER (l_linestatus = 'F') AS b FROM synth
UNION ALL SELECT 'flags', 'MEDIUM', '<=', avg(l_quantity) FILTER (flag IN ('A', 'R')), avg(l_quantity) FILTER (flag = 'N') FROM synth
UNION ALL SELECT 'share_of_open', 'MEDIUM', '>=', avg((l_linestatus = 'O')::INT) FILTER (flag <> 'N'), avg((l_linestatus = 'O')::INT) FILTER (flag = 'N') FROM synth
UNION ALL SELECT 'untaxed', 'MEDIUM', '<', avg(price) FILTER (tax_n IS NULL), avg(price) FILTER (tax_n IS NOT NULL) FROM synth)
SELECT rule, severity, round(a, 6) AS a, round(b, 6) AS b, CASE dir WHEN '>' THEN a <= b WHEN '>=' THEN a < b WHEN '<' THEN a >= b ELSE a > b END AS violated FROM g""")
def group_comparison(spark, d):
    return rounded(R.group_comparison(synth(spark, d), GROUPS))


@query(f"WITH {BASE_SQL}, p AS (SELECT avg((flag = 'X')::INT) AS rate FROM synth) SELECT 'X' AS value, round(rate, 6) AS rate, CASE WHEN rate < 0.2 OR rate > 0.4 THEN CASE WHEN rate < 0.02 OR rate > 0.5 THEN 'HIGH' ELSE 'MEDIUM' END END AS severity FROM p")
def prevalence(spark, d):
    return rounded(R.prevalence(synth(spark, d), "flag", "X", 0.2, 0.4))


@query(f"""WITH {BASE_SQL}, c AS (SELECT 'price' AS col_a, 'net' AS col_b, count(*) AS n, corr(price, price * (1 - l_discount)) AS r FROM synth
UNION ALL SELECT 'price', 'minus', count(*), corr(price, -price) FROM synth) SELECT col_a, col_b, n, round(r, 6) AS r, r < 0 AS violated FROM c""")
def expected_corr(spark, d):
    df = synth(spark, d).withColumn("net", F.col("price") * (1 - F.col("l_discount"))).withColumn("minus", -F.col("price"))
    return rounded(R.expected_correlations(df, [("price", "net"), ("price", "minus"), ("price", "not_there")]))


@query(f"""WITH {BASE_SQL}, a AS (SELECT 'mean_price' AS name, avg(price) AS s, (SELECT avg(price) FROM synth) AS y FROM seed UNION ALL SELECT 'mean_tax', avg(tax_n), (SELECT avg(tax_n) FROM synth) FROM seed
UNION ALL SELECT 'share_x', avg((flag = 'X')::INT), (SELECT avg((flag = 'X')::INT) FROM synth) FROM seed)
SELECT name, round(s, 4) AS seed_value, round(y, 4) AS synth_value, round(abs(y - s) / greatest(abs(s), 1e-6), 4) AS drift, abs(y - s) / greatest(abs(s), 1e-6) > 0.20 AS flagged FROM a""")
def seed_drift(spark, d):
    def metrics(df):
        one = df.agg(F.avg("price").alias("a"), F.avg("tax_n").alias("b"), F.avg((F.col("flag") == "X").cast("double")).alias("c"))
        return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(c).alias("value")) for n, c in (("mean_price", "a"), ("mean_tax", "b"), ("share_x", "c"))))).alias("r")).select("r.*")

    return rounded(R.seed_drift(metrics(seed(spark, d)), metrics(synth(spark, d))), 4)


@query("""WITH j AS (SELECT l_shipdate AS t, o_orderdate AS s, CASE WHEN o_orderkey % 50 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c AS (SELECT try_cast(raw AS TIMESTAMP) AS s, raw, t FROM j),
k AS (SELECT 'parse_error' AS "check", count_if(raw IS NOT NULL AND s IS NULL)::BIGINT AS n, 'CRITICAL' AS sv FROM c
UNION ALL SELECT 'out_of_range', count_if(s < TIMESTAMP '1993-01-01' OR s > TIMESTAMP '1997-12-31')::BIGINT, 'HIGH' FROM c
UNION ALL SELECT 'year_out_of_range', count_if(year(s) NOT BETWEEN 1993 AND 1997)::BIGINT, 'HIGH' FROM c
UNION ALL SELECT 'not_first_of_month', count_if(day(s) <> 1)::BIGINT, 'MEDIUM' FROM c
UNION ALL SELECT 'not_last_of_month', count_if(s::DATE <> last_day(s))::BIGINT, 'MEDIUM' FROM c
UNION ALL SELECT 'end_before_start', count_if(t < s)::BIGINT, 'CRITICAL' FROM c)
SELECT "check", n, CASE WHEN n > 0 THEN sv END AS severity FROM k""")
def datetime_checks(spark, d):
    raw = F.when(F.col("o_orderkey") % 50 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    df = read(spark, d, "lineitem").join(read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("raw", raw)
    return R.datetime_checks(df, "raw", "1993-01-01", "1997-12-31", end="l_shipdate", month_start=True, month_end=True, years=(1993, 1997))


_RANGES = [("BUILDING", -500, 2000), ("BUILDING", 4000, 9000), ("MACHINERY", -1000, 10000), ("FURNITURE", 0, 500)]
_RANGES_SQL = "r(area, lo, hi) AS (VALUES " + ", ".join(str(r) for r in _RANGES) + ")"


@query(f"""WITH {_RANGES_SQL}, m AS (SELECT c_mktsegment AS area, EXISTS (SELECT 1 FROM r WHERE r.area = c_mktsegment) AND NOT EXISTS (SELECT 1 FROM r WHERE r.area = c_mktsegment AND c_acctbal BETWEEN lo AND hi) AS bad FROM customer),
g AS (SELECT area, count(*) AS n, count_if(bad)::BIGINT AS n_bad FROM m GROUP BY 1)
SELECT area, n, n_bad, round(n_bad / n, 6) AS rate, CASE WHEN n_bad = 0 THEN NULL WHEN n_bad / n > 0.10 THEN 'CRITICAL' WHEN n_bad / n > 0.02 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM g""")
def geo_range_join(spark, d):
    ranges = spark.createDataFrame(_RANGES, "area string, lo int, hi int")
    return rounded(R.geo_check(read(spark, d, "customer"), ranges, "c_mktsegment", "c_acctbal"))


@query("""WITH i AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'same' WHEN c_custkey % 10 = 1 THEN upper(md5(c_name)) ELSE md5(c_name) END AS id FROM customer)
SELECT round(1 - count(DISTINCT id) / count(id), 6) AS duplicate_rate, count_if(length(id) <> 32)::BIGINT AS n_bad_length, count_if(NOT regexp_matches(id, '^[0-9a-f]*$'))::BIGINT AS n_not_hex FROM i""")
def id_checks(spark, d):
    h = F.md5(F.col("c_name").cast("binary"))
    df = read(spark, d, "customer").select(F.when(F.col("c_custkey") % 10 == 0, "same").when(F.col("c_custkey") % 10 == 1, F.upper(h)).otherwise(h).alias("id"))
    return rounded(R.id_checks(df, "id"))


@query("SELECT count(*) AS n, CASE WHEN count(*) <> 1500 THEN 'HIGH' END AS severity FROM customer")
def row_count_check(spark, d):
    return R.row_count_check(read(spark, d, "customer"), 1500)


@query("SELECT * FROM (VALUES ('CRITICAL', 'schema', 'missing column r_area'), ('LOW', 'schema', 'extra column r_name')) t(severity, \"check\", detail)")
def schema_check(spark, d):
    return R.schema_check(read(spark, d, "region"), ["r_regionkey", "r_area"])


@query("""WITH l AS (SELECT c_custkey AS id, CASE c_custkey % 7 WHEN 0 THEN md5(c_name) || ',' || c_name || ', 5 ,' || c_mktsegment || ',a,b,c' WHEN 1 THEN c_name || ',6,' || c_mktsegment WHEN 2 THEN md5(c_name) || ',x,y,a,b,c'
 WHEN 3 THEN 'name,n,segment,p,q,r' WHEN 4 THEN '"Last, First",7,' || c_mktsegment || ',a,b,c' WHEN 5 THEN 'too,few' ELSE c_name || ',8,' || c_mktsegment || ',a,b,c' END AS line FROM customer)
SELECT id, CASE id % 7 WHEN 0 THEN split_part(line, ',', 2) WHEN 4 THEN 'Last, First' WHEN 1 THEN split_part(line, ',', 1) WHEN 6 THEN split_part(line, ',', 1) END AS name,
 CASE id % 7 WHEN 0 THEN '5' WHEN 4 THEN '7' WHEN 1 THEN '6' WHEN 6 THEN '8' END AS n, CASE WHEN id % 7 IN (0, 4, 6) THEN 'c' WHEN id % 7 = 1 THEN '' END AS r, id % 7 IN (2, 5) AS malformed FROM l WHERE id % 7 <> 3""")
def parse_rows(spark, d):
    k, h = F.col("c_custkey") % 7, F.md5(F.col("c_name").cast("binary"))
    line = (
        F.when(k == 0, F.concat(h, F.lit(","), "c_name", F.lit(", 5 ,"), "c_mktsegment", F.lit(",a,b,c"))).when(k == 1, F.concat("c_name", F.lit(",6,"), "c_mktsegment")).when(k == 2, F.concat(h, F.lit(",x,y,a,b,c")))
        .when(k == 3, "name,n,segment,p,q,r").when(k == 4, F.concat(F.lit('"Last, First",7,'), "c_mktsegment", F.lit(",a,b,c"))).when(k == 5, "too,few").otherwise(F.concat("c_name", F.lit(",8,"), "c_mktsegment", F.lit(",a,b,c")))
    )
    out = text.parse_rows(read(spark, d, "customer").select(F.col("c_custkey").alias("id"), line.alias("line")), ["name", "n", "segment", "p", "q", "r"])
    cell = lambda i: F.get("cells", F.lit(i))
    return out.select("id", cell(0).alias("name"), cell(1).alias("n"), cell(5).alias("r"), "malformed")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 0 WHEN p_partkey % 5 = 2 THEN -1 ELSE p_size END::INT AS zip3, CASE WHEN p_size > 5 AND p_size <= 10 THEN '(5, 10]' WHEN p_size > 10 AND p_size <= 40 THEN '(10, 40]' END AS bin,
 CASE p_type WHEN (SELECT min(p_type) FROM part) THEN 0 ELSE -1 END::INT AS ord, regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g') AS slug FROM part WHERE p_partkey % 5 <> 0
UNION ALL SELECT p_partkey, -1, CASE WHEN p_size > 5 AND p_size <= 10 THEN '(5, 10]' WHEN p_size > 10 AND p_size <= 40 THEN '(10, 40]' END, CASE p_type WHEN (SELECT min(p_type) FROM part) THEN 0 ELSE -1 END::INT, regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g') FROM part WHERE p_partkey % 5 = 0""")
def scalar_functions(spark, d):
    df = read(spark, d, "part")
    first = df.agg(F.min("p_type")).first()[0]
    k = F.col("p_partkey") % 5
    raw = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, " ").when(k == 2, "x1").otherwise(F.concat(F.lit("00"), F.col("p_size").cast("string")))
    return df.select("p_partkey", coerce.zip3(raw).alias("zip3"), coerce.right_closed_bin(F.col("p_size"), [5, 10, 40], ["(5, 10]", "(10, 40]"]).alias("bin"), coerce.ordinal(F.col("p_type"), [first]).alias("ord"), coerce.slug(F.col("p_name")).alias("slug"))


def issues(spark, d):
    """The issues of several checks, as one relation (severity, check, detail)."""
    b = R.bounds_check(synth(spark, d), BOUNDS).where("severity IS NOT NULL").select("severity", F.lit("bounds").alias("check"), F.col("column").alias("detail"))
    v = R.rule_violations(synth(spark, d), RULES).where("n_violated > 0").select("severity", F.lit("rule").alias("check"), F.col("rule").alias("detail"))
    g = R.group_comparison(synth(spark, d), GROUPS).where("violated").select("severity", F.lit("group").alias("check"), F.col("rule").alias("detail"))
    return b.unionByName(v).unionByName(g)


_ISSUES = f"""{BASE_SQL}, {_VIOL}, b AS (SELECT 'l_quantity' AS "column", count(l_quantity) AS n, count_if(l_quantity < 2 OR l_quantity > 45) AS n_out FROM synth
UNION ALL SELECT 'price', count(price), count_if(price > 90000) FROM synth UNION ALL SELECT 'tax_n', count(tax_n), count_if(tax_n < 0.01) FROM synth),
i AS (SELECT CASE WHEN n_out / n > 0.10 THEN 'CRITICAL' WHEN n_out / n > 0.02 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, 'bounds' AS "check", "column" AS detail FROM b WHERE n_out > 0
UNION ALL SELECT severity, 'rule', rule FROM v WHERE n_violated > 0
UNION ALL SELECT 'HIGH', 'group', 'open_costs_more' FROM synth HAVING avg(price) FILTER (l_linestatus = 'O') <= avg(price) FILTER (l_linestatus = 'F')
UNION ALL SELECT 'MEDIUM', 'group', 'flags' FROM synth HAVING avg(l_quantity) FILTER (flag IN ('A', 'R')) > avg(l_quantity) FILTER (flag = 'N')
UNION ALL SELECT 'MEDIUM', 'group', 'share_of_open' FROM synth HAVING avg((l_linestatus = 'O')::INT) FILTER (flag <> 'N') < avg((l_linestatus = 'O')::INT) FILTER (flag = 'N')
UNION ALL SELECT 'MEDIUM', 'group', 'untaxed' FROM synth HAVING avg(price) FILTER (tax_n IS NULL) >= avg(price) FILTER (tax_n IS NOT NULL))"""


@query(f"WITH {_ISSUES} SELECT * FROM i")
def issues_union(spark, d):
    return issues(spark, d)


@query(f"WITH {_ISSUES} SELECT severity, count(*) AS n FROM i GROUP BY 1")
def severity_rollup(spark, d):
    return issues(spark, d).groupBy("severity").agg(F.count("*").alias("n"))


