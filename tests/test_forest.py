"""Forests on counts against Spark ML's, and cross-validation by them."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabfidelity.operators import forest, tstr


def _rows(n=3000, seed=5):
    """Few values a feature, many rows alike; the third feature is constant, the first has more values than bins."""
    r = np.random.default_rng(seed)
    x = np.column_stack([r.integers(0, 50, n), r.integers(0, 4, n) / 4, np.zeros(n), r.integers(0, 2, n)]).astype(float)
    y = np.clip((x[:, 0] / 20 + 2 * x[:, 1] * x[:, 3] + r.normal(size=n) * 0.4).astype(int), 0, 2)
    return x, y


@pytest.fixture(scope="module")
def data(spark):
    x, y = _rows()
    df = spark.createDataFrame([(i, float(c), *map(float, v)) for i, (c, v) in enumerate(zip(y, x))], "row_id long, label double, a double, b double, c double, d double")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).select("row_id", "label", "features").cache()


@pytest.mark.parametrize("depth, least", [(8, 20), (5, 1)])
def test_tree_on_counts_is_sparks_tree_on_rows(spark, data, depth, least):
    x, y = _rows()
    weight = len(y) / (3 * np.bincount(y))
    w = data.join(F.broadcast(tstr.class_weights(data, "label").select("label", "weight")), "label")
    model = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=depth, minInstancesPerNode=least, weightCol="weight", seed=1).fit(w)
    want = np.array([r[0] for r in model.transform(data).orderBy("row_id").select(vector_to_array("probability")).collect()])
    kinds, n = np.unique(np.column_stack([x, y]), axis=0, return_counts=True)
    assert len(kinds) < len(y) / 2
    kx, ky = kinds[:, :4], kinds[:, 4].astype(int)
    edges = [forest.thresholds(kx[:, f], n * weight[ky]) for f in range(4)]
    cut = lambda v: np.column_stack([np.searchsorted(e, v[:, f]) for f, e in enumerate(edges)])
    tree = forest.grow(cut(kx), ky, n.astype(float), weight, 4, np.random.default_rng(0), depth, least)
    assert (tree[0] >= 0).sum() > 5
    np.testing.assert_allclose(forest.vote(tree, cut(x)), want, atol=1e-9)


def test_cross_validated_forests_read_rows_once(spark, data):
    """Five forests of Spark ML passed over the rows at each level, and over the ranked folds at each of these: over a hundred jobs."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "cross-validation by counts")
    try:
        got = [r.asDict() for r in tstr.cross_validated(data, 3, ["row_id"]).collect()]
        jobs = len(sc.statusTracker().getJobIdsForGroup("counted"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 40
    sizes = {r["fold"]: r["count"] for r in tstr.folds(data, "label", ["row_id"]).groupBy("fold").count().collect()}
    assert {r["fold"]: r["n"] for r in got} == sizes and sum(sizes.values()) == 3000
    again = [r.asDict() for r in tstr.cross_validated(data.repartition(7, "features"), 3, ["row_id"]).collect()]
    assert again == got


def test_counted_forests_score_as_sparks(spark, data):
    """Also where the kinds of rows are too many for counts, and forests are Spark ML's on the rows."""
    a, b = (tstr.cross_validated(data, 3, ["row_id"], counted=c).collect() for c in (tstr.COUNTED, 0))
    assert [r["n"] for r in a] == [r["n"] for r in b]
    for m in ("accuracy", "macro_f1"):
        assert abs(np.mean([r[m] for r in a]) - np.mean([r[m] for r in b])) < 0.02
        assert min(r[m] for r in (*a, *b)) > 0.6  # by chance a third


def test_rows_of_one_key_fall_alike_on_any_partitioning(spark, data):
    """As lineitem's key repeats: such rows are dealt by their features, not by where they lie."""
    same = data.withColumn("row_id", F.col("row_id") % 5)
    a, b = (tstr.cross_validated(d, 3, ["row_id"]).collect() for d in (same.repartition(3, "features"), same.coalesce(1)))
    assert a == b


def test_odd_rows_of_cross_validation(spark):
    """Rows without label are in no fold, NaN is a value above all, folds may be empty."""
    rows = [(i, None if i % 10 == 9 else float(i % 2), float("nan") if i % 2 else -0.0 if i % 4 else 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, label double, v double")
    df = VectorAssembler(inputCols=["v"], outputCol="features", handleInvalid="keep").transform(df)
    got = tstr.cross_validated(df, 2, ["row_id"]).collect()
    assert [r["n"] for r in got] == [36] * 5 and all(r["accuracy"] == 1.0 for r in got)
    few = tstr.cross_validated(df.where("row_id < 6"), 2, ["row_id"]).collect()
    assert [r["fold"] for r in few] == [0, 1, 2, 3, 4] and [r["n"] for r in few] == [2, 2, 2, 0, 0] and few[4]["macro_f1"] is None
