"""Queries of train-on-synthetic, test-on-real. Scores that need no learner use hashed predictions, so another engine has the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rng import uniform
from ..operators import tstr as T
from .bindings import rounded, read, seed, synth
from .catalog import query
from .q_dp import usql

_O = "o AS (SELECT *, floor(u * 3) AS k, (o_orderkey % 3)::DOUBLE AS y FROM (SELECT *, " + usql("o_orderkey", no=7) + " AS u, " + usql("o_orderkey", no=8) + " AS w FROM orders))"
_PR = f"{_O}, p AS (SELECT y AS label, CASE WHEN w < 0.6 THEN y ELSE k END AS prediction FROM o)"


def _orders(spark, d):
    k = F.col("o_orderkey")
    return read(spark, d, "orders").withColumn("u", uniform(7, k)).withColumn("w", uniform(8, k)).withColumn("y", (k % 3).cast("double"))


def _preds(spark, d):
    return _orders(spark, d).select(F.col("y").alias("label"), F.when(F.col("w") < 0.6, F.col("y")).otherwise(F.floor(F.col("u") * 3).cast("double")).alias("prediction"))


def _scores(spark, d):
    return _orders(spark, d).select("o_orderstatus", (F.round(F.col("u") * 0.5 + F.col("w") * 0.2 + F.col("y") * 0.1, 2)).alias("score"), (F.col("y") == 2).cast("int").alias("label"))


_SC = f"{_O}, s AS (SELECT o_orderstatus, round(u * 0.5 + w * 0.2 + y * 0.1, 2) AS score, (y = 2)::INT AS label FROM o)"


@query(f"""WITH {_O}, h AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {usql('o_orderkey')}, o_orderkey) - 1 AS r, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM o)
SELECT o_orderkey, o_orderstatus, r < floor(n * 0.2::DOUBLE) AS is_test, (r % 5)::INT AS fold FROM h""")
def stratified_split(spark, d):
    df = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return T.folds(T.exact_stratified_split(df, "o_orderstatus", ["o_orderkey"]), "o_orderstatus", ["o_orderkey"]).select("o_orderkey", "o_orderstatus", "is_test", "fold")


@query("SELECT o_orderpriority AS label, count(*) AS n, round((SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderpriority) FROM orders) * count(*)), 6) AS weight FROM orders GROUP BY 1")
def class_weights(spark, d):
    return rounded(T.class_weights(read(spark, d, "orders"), "o_orderpriority"))


@query(f"WITH {_PR} SELECT label, prediction, count(*) AS n FROM p GROUP BY ALL")
def confusion(spark, d):
    return T.confusion(_preds(spark, d))


_F1 = """c AS (SELECT label AS class, count_if(label = prediction) AS tp, count_if(label <> prediction) AS fn, (SELECT count(*) FROM p q WHERE q.prediction = p.label AND q.label <> q.prediction) AS fp FROM p GROUP BY label)"""


@query(f"WITH {_PR}, {_F1} SELECT (SELECT count(*) FROM p) AS n, round((SELECT avg((label = prediction)::INT) FROM p), 6) AS accuracy, round(avg(2 * tp / (2 * tp + fp + fn)), 6) AS macro_f1 FROM c")
def macro_f1(spark, d):
    return rounded(T.macro_f1(_preds(spark, d)))


@query(f"""WITH {_O}, p AS (SELECT y AS label, 0 AS class, CASE WHEN w < 0.05 THEN 1.0::DOUBLE ELSE u END AS p FROM o UNION ALL SELECT y, 1, 1 - u FROM o), e AS (SELECT class, p, (label = class)::INT AS y FROM p),
b AS (SELECT class, floor(p * 10) AS bin, count(*) AS n, sum((p - y) * (p - y)) AS sq, avg(p) AS c, avg(y) AS a FROM e GROUP BY ALL)
SELECT class::DOUBLE AS class, sum(n)::BIGINT AS n, round(sum(sq) / sum(n), 6) AS brier, round(sum(CASE WHEN bin < 10 THEN n * abs(a - c) ELSE 0 END) / sum(n), 6) AS ece FROM b GROUP BY 1""")
def brier_ece(spark, d):
    df = _orders(spark, d).select(F.col("y").alias("label"), F.create_map(F.lit(0.0), F.when(F.col("w") < 0.05, 1.0).otherwise(F.col("u")), F.lit(1.0), 1 - F.col("u")).alias("p"))
    return rounded(T.brier_ece(df))


_CUM = """g AS (SELECT score, sum(label) AS p, count(*) AS n FROM s GROUP BY 1), c AS (SELECT score, p, sum(p) OVER (ORDER BY score DESC) AS cp, sum(n) OVER (ORDER BY score DESC) AS cn, sum(p) OVER () AS ap FROM g)"""


@query(f"WITH {_SC}, {_CUM} SELECT score AS threshold, round(cp / cn, 6) AS precision, round(cp / ap, 6) AS recall, round(cp / cn * (p / ap), 6) AS step FROM c")
def pr_curve(spark, d):
    return rounded(T.pr_curve(_scores(spark, d)))


@query(f"WITH {_SC}, {_CUM} SELECT count(*) AS n_points, round(sum(cp / cn * (p / ap)), 6) AS average_precision FROM c")
def average_precision(spark, d):
    return rounded(T.average_precision(_scores(spark, d)))


_AUC = """SELECT {g} sum(p * (below + n / 2.0)) / (sum(p)::DOUBLE * sum(n)) AS auc, (sum(p) + sum(n))::BIGINT AS n FROM (SELECT *, coalesce(sum(n) OVER ({w} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM
(SELECT {g} score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY ALL)) {gb}"""


@query(f"WITH {_SC}, a AS ({_AUC.replace('{g}', '').replace('{w}', '').replace('{gb}', '')}) SELECT round(auc, 6) AS auc FROM a")
def auroc_ranksum(spark, d):
    return rounded(T.auroc(_scores(spark, d)))


_GRP = _AUC.replace("{g}", "o_orderstatus,").replace("{w}", "PARTITION BY o_orderstatus").replace("{gb}", "GROUP BY o_orderstatus")


@query(f'WITH {_SC}, a AS ({_GRP}) SELECT o_orderstatus AS "group", n, round(auc, 6) AS auc FROM a')
def subgroup_auroc(spark, d):
    return rounded(T.subgroup_auroc(_scores(spark, d), "o_orderstatus"))


@query(f"WITH {_SC}, a AS ({_GRP}) SELECT count(*) AS n_groups, round(max(auc) - min(auc), 6) AS gap FROM a")
def subgroup_parity(spark, d):
    return rounded(T.parity_gap(T.subgroup_auroc(_scores(spark, d), "o_orderstatus")))


@query(f"""WITH {_SC}, g AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY 1) SELECT score AS threshold, round(sum(n) OVER (ORDER BY score DESC) / sum(n) OVER (), 6) AS fpr, round(sum(p) OVER (ORDER BY score DESC) / sum(p) OVER (), 6) AS tpr FROM g""")
def roc_points(spark, d):
    return rounded(T.roc_points(_scores(spark, d)))


@query("""WITH t AS (SELECT (year(o_orderdate) * 12 + month(o_orderdate))::BIGINT AS x, round(avg((o_orderstatus = 'F')::INT) FILTER (o_orderkey % 2 = 0) - avg((o_orderstatus = 'F')::INT) FILTER (o_orderkey % 2 = 1), 6) AS g FROM orders GROUP BY 1),
m AS (SELECT *, coalesce(abs(g) >= 0.02, false) AS on_, coalesce(lag(coalesce(abs(g) >= 0.02, false)) OVER (ORDER BY x), false) AS prev FROM t),
i AS (SELECT *, sum((on_ AND NOT prev)::INT) OVER (ORDER BY x) AS island FROM m) SELECT island::BIGINT AS island, min(x) AS start, max(x) AS "end", count(*) AS n, round(max(abs(g)), 6) AS max_gap FROM i WHERE on_ GROUP BY 1""")
def divergence_regions(spark, d):
    share = lambda rest: F.avg(F.when(F.col("o_orderkey") % 2 == rest, (F.col("o_orderstatus") == "F").cast("double")))
    by_month = read(spark, d, "orders").groupBy((F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("long").alias("x")).agg(F.round(share(0) - share(1), 6).alias("g"))
    return rounded(T.divergence_regions(by_month, "x", "g", 0.02))


@query()
def cross_validation(spark, d):
    return T.cross_summary(T.cross_validated(_encoded(seed(spark, d)), 3, _KEY, "forest"))


@query()
def extended_report(spark, d):
    return T.extended_report(_binary(seed(spark, d)), _binary(synth(spark, d)), 2, _KEY, ("forest", "logistic"))


@query(f"WITH {_SC}, {_CUM}, r AS (SELECT *, row_number() OVER (ORDER BY cp / ap, score) - 1 AS r, count(*) OVER () AS n FROM c), k AS (SELECT DISTINCT round_even(i * (n - 1) / 19.0::DOUBLE, 0)::BIGINT AS r FROM r, range(20) q(i)) SELECT score AS threshold, round(cp / ap, 6) AS recall FROM r WHERE r IN (SELECT r FROM k)")
def thin_curve(spark, d):
    return rounded(T.thin_curve(T.pr_curve(_scores(spark, d)), 20).select("threshold", "recall"))


_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


def _encoded(df, flags=("A", "N", "R")):
    # A label that the features tell of, as raw lineitem columns are independent.
    df = df.withColumn("size", F.when(F.col("price") > 50000, "big").when(F.col("price") > 25000, "mid").otherwise("small"))
    return T.encode(df, "size", ["small", "mid", "big"], {"l_linestatus": ["F", "O"], "flag": flags}, ["l_quantity", "tax_n", "l_discount"], keep=_KEY)


@query()
def three_modes(spark, d):
    return T.evaluate_modes(_encoded(seed(spark, d)), _encoded(synth(spark, d)), 3, _KEY, "forest")


@query()
def fidelity(spark, d):
    return T.fidelity_ratio(T.evaluate_modes(_encoded(seed(spark, d)), _encoded(synth(spark, d)), 3, _KEY, "logistic"))


def _binary(df):
    return T.encode(df.withColumn("size", F.when(F.col("price") > 35000, "big").otherwise("small")), "size", ["small", "big"], {"flag": ["A", "N", "R"]}, ["l_quantity", "tax_n"], keep=_KEY)


@query()
def four_regimes(spark, d):
    return T.four_regimes(_binary(seed(spark, d)), _binary(synth(spark, d)), _KEY, "logistic")


@query()
def calibrated(spark, d):
    df = T.stratified_split(_binary(seed(spark, d)), "label", _KEY)
    m = T.train(df.where("NOT is_test"), "gbt", 2)
    score = T.calibrate(m.transform(df.where("NOT is_test")), 2)
    return T.brier_ece(score(m.transform(df.where("is_test"))))


@query()
def perm_importance(spark, d):
    from pyspark.ml.feature import VectorAssembler

    df = seed(spark, d).withColumn("label", (F.col("price") > 35000).cast("double"))
    va = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features")
    m = T.train(va.transform(df), "logistic", 2)
    return T.permutation_importance(m, df.select("label", "l_quantity", "l_discount", *_KEY, "l_suppkey", "l_extendedprice"), ["l_quantity", "l_discount"], [*_KEY, "l_suppkey", "l_extendedprice"], va.transform)


@query()
def shift_robustness(spark, d):
    from pyspark.ml.functions import vector_to_array

    def both(df):
        parts = T.stratified_split(df.withColumn("label", (F.col("price") > 35000).cast("double")), "label", _KEY)
        from pyspark.ml.feature import VectorAssembler

        va = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features")
        m = T.train(va.transform(parts.where("NOT is_test")), "logistic", 2)
        s = lambda x: T.auroc(m.transform(va.transform(x)).select(vector_to_array("probability")[1].alias("score"), "label"))
        test = parts.where("is_test")
        return s(test).crossJoin(s(T.shifted(test, ["l_quantity"], _KEY)).withColumnRenamed("auc", "shifted_auc"))  # one row each

    return T.shift_robustness(both(seed(spark, d)), both(synth(spark, d)))
