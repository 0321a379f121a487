"""Train on synthetic, test on real: splits, classifiers, calibration, and their scores as relational expressions.

Learners are Spark ML's, but for forests on counts in cross-validation; scores are aggregates over (label, prediction, probability) rows, exact at any size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import ordinal, to_double
from ..functions.rng import hash32, normal, uniform
from . import forest
from .privacy import auc
from .ranges import by_ranges, ensure_checkpoint_dir


def stratified_split(df: DataFrame, label: str, key: Sequence[str], share: float = 0.2, seed: int | str = 42) -> DataFrame:
    """df with `is_test`: rows whose hashed uniform is under the share, class by class alike and without any shuffle."""
    return df.withColumn("is_test", uniform(seed, *(F.col(k) for k in key)) < share)


def exact_stratified_split(df: DataFrame, label: str, key: Sequence[str], share: float = 0.2, seed: int | str = 42) -> DataFrame:
    """df with `is_test` for floor(share * n) rows of each class exactly, by global hash rank inside the class."""
    from .synth import global_rank

    ranked = global_rank(df.withColumn("_h", hash32(seed, *(F.col(k) for k in key))), "_h", key, [label], "_r")
    sizes = df.groupBy(label).agg(F.floor(F.count("*") * F.lit(share)).alias("_t"))
    return ranked.join(F.broadcast(sizes), label).withColumn("is_test", F.col("_r") < F.col("_t")).drop("_h", "_r", "_t")


def folds(df: DataFrame, label: str, key: Sequence[str], k: int = 5, seed: int | str = 42, ties: Sequence[str] = ()) -> DataFrame:
    """df with `fold` from 0 to k - 1, dealt in turn by hash rank inside each class; rows of one key in the order of `ties`."""
    from .synth import global_rank

    ranked = global_rank(df.withColumn("_h", hash32(seed, *(F.col(c) for c in key))), "_h", [*key, *ties], [label], "_r")
    return ranked.withColumn("fold", F.pmod("_r", F.lit(k)).cast("int")).drop("_h", "_r")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """label, n, weight = total / (classes * n)."""
    n = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    one = n.agg(F.sum("n").alias("t"), F.count("*").alias("k"))
    return n.crossJoin(F.broadcast(one)).select("label", "n", (F.col("t") / (F.col("k") * F.col("n"))).alias("weight"))  # one row


def confusion(preds: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return preds.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count("*").alias("n"))


def class_scores(preds: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """class, tp, fp, fn, precision, recall, f1; 0 where undefined."""
    return cell_scores(confusion(preds, label, pred))


def cell_scores(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """class_scores of a confusion (label, prediction, n), in each group of `by`."""
    sides = F.array(F.struct(F.col("label").alias("class"), F.lit(True).alias("actual")), F.struct(F.col("prediction").alias("class"), F.lit(False).alias("actual")))
    flat = cells.select(*by, "n", (F.col("label") == F.col("prediction")).alias("hit"), F.explode(sides).alias("s")).select(*by, "n", "hit", "s.*")
    a = flat.groupBy(*by, "class").agg(F.sum(F.when(F.col("hit") & F.col("actual"), F.col("n")).otherwise(0)).alias("tp"), F.sum(F.when(~F.col("hit") & ~F.col("actual"), F.col("n")).otherwise(0)).alias("fp"), F.sum(F.when(~F.col("hit") & F.col("actual"), F.col("n")).otherwise(0)).alias("fn"))
    zero = lambda x, y: F.coalesce(F.try_divide(x.cast("double"), y), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return a.select(*by, "class", tp, fp, fn, zero(tp, tp + fp).alias("precision"), zero(tp, tp + fn).alias("recall"), zero(2 * tp, 2 * tp + fp + fn).alias("f1"))


def macro_f1(preds: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """n, accuracy, macro_f1."""
    acc = preds.agg(F.count("*").alias("n"), F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))
    return acc.crossJoin(class_scores(preds, label, pred).agg(F.avg("f1").alias("macro_f1")))  # one row each


def brier_ece(probs: DataFrame, label: str = "label", bins: int = 10, closed_last: bool = False) -> DataFrame:
    """class, n, brier, ece of one-against-rest probabilities: probs has label and `p`, a map from class to probability.

    Bins are closed below. A probability of 1 is in none unless closed_last.
    """
    flat = probs.select(F.col(label).alias("label"), F.explode("p").alias("class", "p")).withColumn("y", (F.col("label") == F.col("class")).cast("double"))
    b = F.floor(F.col("p") * bins)
    b = F.least(b, F.lit(bins - 1)) if closed_last else b
    cells = flat.groupBy("class", b.alias("bin")).agg(F.count("*").alias("n"), F.sum(F.pow(F.col("p") - F.col("y"), 2)).alias("sq"), F.avg("p").alias("conf"), F.avg("y").alias("acc"))
    n = F.sum("n")
    return cells.groupBy("class").agg(n.alias("n"), (F.sum("sq") / n).alias("brier"), (F.sum(F.when(F.col("bin") < bins, F.col("n") * F.abs(F.col("acc") - F.col("conf"))).otherwise(0.0)) / n).alias("ece"))


def pr_curve(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """threshold, precision, recall, step: points of the precision-recall curve, a row per score; the sum of step is the average precision."""
    per = scores.groupBy(F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count("*").alias("n")).withColumn("neg", -F.col("s"))
    ranged = by_ranges(per, "neg")
    sums = ranged.groupBy("_range").agg(F.sum("p").alias("tp"), F.sum("n").alias("tn"))
    before, every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    off = sums.select("_range", F.coalesce(F.sum("tp").over(before), F.lit(0)).alias("bp"), F.coalesce(F.sum("tn").over(before), F.lit(0)).alias("bn"), F.sum("tp").over(every).alias("all_p"))
    w = Window.partitionBy("_range").orderBy("neg")
    cum = ranged.withColumn("cp", F.sum("p").over(w)).withColumn("cn", F.sum("n").over(w)).join(F.broadcast(off), "_range")
    tp, n = F.col("cp") + F.col("bp"), F.col("cn") + F.col("bn")
    return cum.select(F.col("s").alias("threshold"), (tp / n).alias("precision"), F.try_divide(tp.cast("double"), F.col("all_p")).alias("recall"), F.coalesce(F.try_divide(F.col("p").cast("double"), F.col("all_p")), F.lit(0.0)).alias("dr")).withColumn("step", F.col("precision") * F.col("dr")).drop("dr")


def average_precision(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return pr_curve(scores, score, label).agg(F.count("*").alias("n_points"), F.sum("step").alias("average_precision"))


def thin_curve(curve: DataFrame, n: int = 60, order: str = "recall") -> DataFrame:
    """About n evenly spaced points of a curve, its ends among them."""
    from .synth import global_rank

    total = curve.count()
    if total <= n:
        return curve
    ranked = global_rank(curve, order, ["threshold"])
    at = sorted({round(i * (total - 1) / (n - 1)) for i in range(n)})
    return ranked.where(F.col("rank").isin(*at)).drop("rank")


def auroc(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return auc(scores, score, label)


def subgroup_auroc(scores: DataFrame, group: str, score: str = "score", label: str = "label", least_n: int = 10) -> DataFrame:
    """group, n, auc of each group with both classes and enough rows, by counts per (group, score)."""
    per = scores.groupBy(F.col(group).alias("group"), F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))
    ranged = by_ranges(per, "group", "s")
    inside = Window.partitionBy("group", "_range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("below", F.coalesce(F.sum("n").over(inside), F.lit(0))).groupBy("group", "_range").agg(F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)).alias("u"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = local.withColumn("b", before).groupBy("group").agg(F.sum(F.col("u") + F.col("p") * F.col("b")).alias("u"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    return out.where((F.col("p") > 0) & (F.col("n") > 0) & (F.col("p") + F.col("n") >= least_n)).select("group", (F.col("p") + F.col("n")).alias("n"), (F.col("u") / (F.col("p").cast("double") * F.col("n"))).alias("auc"))


def parity_gap(groups: DataFrame) -> DataFrame:
    return groups.agg(F.count("*").alias("n_groups"), (F.max("auc") - F.min("auc")).alias("gap"))


def roc_points(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """threshold, fpr, tpr, a row per score."""
    pr = pr_curve(scores, score, label).select("threshold", "recall")
    flipped = scores.select(F.col(score).alias("score"), (1 - F.col(label)).alias("label"))
    return pr.join(pr_curve(flipped).select("threshold", F.col("recall").alias("fpr")), "threshold").select("threshold", "fpr", F.col("recall").alias("tpr"))


def divergence_regions(gaps: DataFrame, order: str, gap: str, least: float) -> DataFrame:
    """island, start, end, n, max_gap: runs of neighbouring points of a thinned curve whose gap is at least `least`."""
    w = Window.orderBy(order)  # a curve of a few dozen points
    marked = gaps.withColumn("_on", F.coalesce(F.abs(F.col(gap)) >= least, F.lit(False)))
    isle = marked.withColumn("_new", (F.col("_on") & ~F.coalesce(F.lag("_on").over(w), F.lit(False))).cast("int")).withColumn("island", F.sum("_new").over(w))
    return isle.where("_on").groupBy("island").agg(F.min(order).alias("start"), F.max(order).alias("end"), F.count("*").alias("n"), F.max(F.abs(F.col(gap))).alias("max_gap"))


def level_codes(df: DataFrame, column: str, listed: int = 1000) -> list[str] | DataFrame:
    """All levels of a column in order: a list of up to `listed`, else a table (level, code)."""
    from .synth import global_rank

    levels = df.select(F.col(column).cast("string").alias("level")).na.drop().distinct()
    if levels.limit(listed + 1).count() <= listed:
        return sorted(r[0] for r in levels.collect())
    return global_rank(levels, "level", ["level"], name="code")


def encode(df: DataFrame, label: str, label_order: Sequence[str], categorical: Mapping[str, Sequence[str] | DataFrame], numeric: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """label (rank in its order) and features; unseen values are -1 and missing numbers 0 with a flag. Rows without a label go.

    categorical: the levels of each column in order, or a table (level, code) of them, which is joined.
    """
    from pyspark.ml.feature import VectorAssembler

    cols: dict[str, Column] = {}
    for i, (c, order) in enumerate(categorical.items()):
        if isinstance(order, DataFrame):
            codes = order.select(F.col("level").alias(f"_level{i}"), F.col("code").alias(f"_code{i}"))
            df = df.join(codes, F.col(c).cast("string") == codes[f"_level{i}"], "left").drop(f"_level{i}")
            cols[f"x_{c}"] = F.coalesce(F.col(f"_code{i}"), F.lit(-1)).cast("double")
        else:
            cols[f"x_{c}"] = ordinal(F.col(c), list(order)).cast("double")
    for c in numeric:
        x = to_double(F.col(c))
        cols |= {f"x_{c}": F.coalesce(x, F.lit(0.0)), f"x_{c}__null": x.isNull().cast("double")}
    out = df.where(F.col(label).isNotNull()).select(*keep, ordinal(F.col(label), list(label_order)).cast("double").alias("label"), *(v.alias(k) for k, v in cols.items())).where("label >= 0")
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(out)


def train(data: DataFrame, kind: str = "gbt", classes: int = 2, seed: int = 42, iterations: int = 40, depth: int = 5):
    """A fitted classifier with balanced class weights: gbt (one against rest for several classes), forest, logistic or mlp.

    iterations and depth are those of boosting; 300 and 6 are at hand where time is no object (`STRONG`).
    """
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier

    weighted = data.join(F.broadcast(class_weights(data, "label").select("label", "weight")), "label")
    if kind == "gbt":
        base = GBTClassifier(maxIter=iterations, maxDepth=depth, stepSize=0.1, minInstancesPerNode=20, weightCol="weight", seed=seed)
        return base.fit(weighted) if classes == 2 else OneVsRest(classifier=base, weightCol="weight").fit(weighted)
    if kind == "forest":
        return RandomForestClassifier(numTrees=forest.TREES, maxDepth=forest.DEPTH, minInstancesPerNode=forest.LEAST, maxBins=forest.BINS, weightCol="weight", seed=seed).fit(weighted)
    if kind == "logistic":
        return LogisticRegression(weightCol="weight", regParam=1e-3).fit(weighted)
    if kind == "mlp":
        width = len(data.first()["features"])
        return MultilayerPerceptronClassifier(layers=[width, 64, 32, 16, classes], seed=seed, maxIter=80).fit(data)
    raise ValueError(f"learner {kind!r} is not known")


def calibrate(scored: DataFrame, classes: int, method: str = "isotonic"):
    """score(df) adds `p`, a map from class to calibrated probability, from one model per class fitted on scored rows."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    models = []
    for k in range(classes):
        one = scored.select(vector_to_array("probability")[k].alias("x"), (F.col("label") == k).cast("double").alias("label"))
        if method == "isotonic":
            models.append(IsotonicRegression(featuresCol="x", labelCol="label", predictionCol="y").fit(one))
        else:
            models.append(LogisticRegression(featuresCol="v").fit(VectorAssembler(inputCols=["x"], outputCol="v").transform(one)))

    def score(df: DataFrame) -> DataFrame:
        out = df
        for k, m in enumerate(models):
            out = out.withColumn("x", vector_to_array("probability")[k])
            if method == "isotonic":
                out = m.transform(out).withColumnRenamed("y", f"_y{k}").drop("x")
            else:
                made = m.setProbabilityCol("_pp").setRawPredictionCol("_rr").setPredictionCol("_qq").transform(VectorAssembler(inputCols=["x"], outputCol="v").transform(out))
                out = made.withColumn(f"_y{k}", vector_to_array("_pp")[1]).drop("v", "x", "_pp", "_rr", "_qq")
        ys = [F.greatest(F.col(f"_y{k}"), F.lit(0.0)) for k in range(classes)]
        total = sum(ys[1:], ys[0])
        p = F.create_map(*(e for k, y in enumerate(ys) for e in (F.lit(float(k)), F.when(total > 0, y / total).otherwise(1.0 / classes))))
        return out.withColumn("p", p).drop(*(f"_y{k}" for k in range(classes)))

    return score


def evaluate_modes(seed: DataFrame, synth: DataFrame, classes: int, key: Sequence[str], kind: str = "forest") -> DataFrame:
    """mode, n, accuracy, macro_f1 of seed on seed, synthetic on synthetic and synthetic on seed, each on a held-out fifth."""
    parts = {n: stratified_split(d, "label", key) for n, d in (("seed", seed), ("synth", synth))}
    fits = {n: train(d.where("NOT is_test"), kind, classes) for n, d in parts.items()}
    out = None
    for mode, fit, test in (("seed_on_seed", "seed", "seed"), ("synth_on_synth", "synth", "synth"), ("synth_on_seed", "synth", "seed")):
        one = macro_f1(fits[fit].transform(parts[test].where("is_test"))).select(F.lit(mode).alias("mode"), "*")
        out = one if out is None else out.unionByName(one)
    return out


#: Boosting at full strength.
STRONG = {"iterations": 300, "depth": 6}


#: Numbers in the kinds of rows, labels counted with classes, up to which forests are grown from counts: some 100 MB in a task.
COUNTED = 4_000_000


def cross_validated(data: DataFrame, classes: int, key: Sequence[str], kind: str = "forest", k: int = 5, seed: int | str = 42, counted: int = COUNTED, **options) -> DataFrame:
    """fold, n, accuracy, macro_f1: each of k stratified folds scored by a model of the others.

    Forests are grown from the counts of rows alike in label and features (`forest`), where these have up to `counted` numbers;
    other learners and forests of more kinds of rows are Spark ML's, on the rows. Rows of one key are told apart by their features.
    """
    from pyspark.ml.functions import vector_to_array

    if kind == "forest":
        arrays = data.select("label", *(c for c in key if c != "label"), vector_to_array("features").alias("features"))
        whole = (F.col("label") >= 0) & (F.col("label") == F.floor("label"))
        # Kinds by sketch, as the limit is one of memory.
        size = arrays.agg(F.max("label").alias("top"), F.count_if(~whole | F.col("features").isNull()).alias("odd"), F.approx_count_distinct(F.xxhash64("label", "features")).alias("kinds"), F.max(F.size("features")).alias("width"), F.min(F.size("features")).alias("least")).first()
        n_classes = max(classes, int(size["top"]) + 1) if size["top"] is not None and not size["odd"] and size["width"] == size["least"] else 0
        if n_classes and size["kinds"] * (size["width"] + n_classes) <= counted:
            kinds = forest.counted_folds(folds(arrays, "label", key, k, seed, ["features"]), k).checkpoint()
            return _fold_scores(forest.confusion_of_folds(kinds, k, n_classes), k)
    ensure_checkpoint_dir(data.sparkSession)
    dealt = folds(data.withColumn("_x", vector_to_array("features")), "label", key, k, seed, ["_x"]).drop("_x").checkpoint()  # else ranked again at every reading of a fold
    cells = None
    for i in range(k):
        fit = train(dealt.where(F.col("fold") != i).drop("fold"), kind, classes, **options)
        one = confusion(fit.transform(dealt.where(F.col("fold") == i))).select(F.lit(i).alias("fold"), "*")
        cells = one if cells is None else cells.unionByName(one)
    return _fold_scores(cells, k)


def _fold_scores(cells: DataFrame, k: int) -> DataFrame:
    """fold, n, accuracy, macro_f1 of k confusions (fold, label, prediction, n); folds without rows have n 0."""
    cells = cells.checkpoint()  # a row per fold, label and prediction; else every forest is asked twice
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).when(F.col("label").isNotNull(), 0))
    known = F.sum(F.when(F.col("label").isNotNull(), F.col("n")))
    acc = cells.groupBy("fold").agg(F.sum("n").alias("n"), F.try_divide(hits.cast("double"), known).alias("accuracy"))
    f1 = cell_scores(cells, ["fold"]).groupBy("fold").agg(F.avg("f1").alias("macro_f1"))
    every = cells.sparkSession.range(k).select(F.col("id").cast("int").alias("fold"))
    return every.join(acc, "fold", "left").join(f1, "fold", "left").select("fold", F.coalesce("n", F.lit(0)).alias("n"), "accuracy", "macro_f1").orderBy("fold")


def cross_summary(scores: DataFrame) -> DataFrame:
    """k, mean_f1, std_f1 (sample) of the folds."""
    return scores.agg(F.count("*").alias("k"), F.avg("macro_f1").alias("mean_f1"), F.stddev_samp("macro_f1").alias("std_f1"))


def extended_report(seed: DataFrame, synth: DataFrame, classes: int, key: Sequence[str], kinds: Sequence[str] = ("forest", "logistic", "gbt"), **options) -> DataFrame:
    """model, regime, n, accuracy, macro_f1, mean_auc: every learner trained and tested on real (R) and synthetic (S) rows in all four ways.

    mean_auc is the mean over classes of one against the rest; classes without rows on either side are left out of it.
    """
    from pyspark.ml.functions import vector_to_array

    parts = {n: stratified_split(d, "label", key) for n, d in (("R", seed), ("S", synth))}
    out = None
    for kind in kinds:
        fits = {n: train(d.where("NOT is_test"), kind, classes, **(options if kind == "gbt" else {})) for n, d in parts.items()}
        for a in "RS":
            for b in "RS":
                scored = fits[a].transform(parts[b].where("is_test"))
                one = macro_f1(scored)
                score = vector_to_array("probability" if "probability" in scored.columns else "rawPrediction")  # one against the rest has raw scores only
                aucs = None
                for c in range(1 if classes == 2 else 0, classes):
                    got = auc(scored.select(score[c].alias("score"), (F.col("label") == c).cast("int").alias("label")))
                    aucs = got if aucs is None else aucs.unionByName(got)
                row = one.crossJoin(aucs.agg(F.avg("auc").alias("mean_auc"))).select(F.lit(kind).alias("model"), F.lit(f"T{a}T{b}").alias("regime"), "*")  # one row each
                out = row if out is None else out.unionByName(row)
    return out


def fidelity_ratio(modes: DataFrame) -> DataFrame:
    """One row: macro F1 of synthetic on seed over seed on seed."""
    f = lambda m: F.max(F.when(F.col("mode") == m, F.col("macro_f1")))
    return modes.agg(F.try_divide(f("synth_on_seed"), f("seed_on_seed")).alias("fidelity"))


def four_regimes(seed: DataFrame, synth: DataFrame, key: Sequence[str], kind: str = "forest") -> DataFrame:
    """regime, auc of models trained and tested on real and synthetic rows in all four ways, with `faithful`: TRTS within 0.05 of TRTR."""
    from pyspark.ml.functions import vector_to_array

    parts = {n: stratified_split(d, "label", key) for n, d in (("R", seed), ("S", synth))}
    fits = {n: train(d.where("NOT is_test"), kind, 2) for n, d in parts.items()}
    out = None
    for a in "RS":
        for b in "RS":
            s = fits[a].transform(parts[b].where("is_test")).select(vector_to_array("probability")[1].alias("score"), "label")
            one = auc(s).select(F.lit(f"T{a}T{b}").alias("regime"), "auc")
            out = one if out is None else out.unionByName(one)
    base = out.agg(F.max(F.when(F.col("regime") == "TRTR", F.col("auc"))).alias("_r"), F.max(F.when(F.col("regime") == "TRTS", F.col("auc"))).alias("_s"))
    return out.crossJoin(F.broadcast(base)).select("regime", "auc", (F.abs(F.col("_r") - F.col("_s")) <= 0.05).alias("faithful"))  # one row


def shifted(df: DataFrame, columns: Sequence[str], key: Sequence[str], scale: float = 0.1, seed: int | str = 42) -> DataFrame:
    """Numbers plus hashed normal noise of `scale` standard deviations."""
    s = df.agg(*(F.stddev_pop(to_double(F.col(c))).alias(f"_s_{c}") for c in columns))
    wide = df.crossJoin(F.broadcast(s))  # one row
    return wide.withColumns({c: to_double(F.col(c)) + normal(f"{seed}-{c}", *(F.col(k) for k in key)) * F.col(f"_s_{c}") * scale for c in columns}).drop(*(f"_s_{c}" for c in columns))


def shift_robustness(real: DataFrame, synth: DataFrame, least: float = 0.005) -> DataFrame:
    """delta_real, delta_synth, ratio of (auc, shifted_auc) rows; no ratio where the real change is under `least`."""
    a = real.select((F.col("auc") - F.col("shifted_auc")).alias("delta_real"))
    b = synth.select((F.col("auc") - F.col("shifted_auc")).alias("delta_synth"))
    return a.crossJoin(b).withColumn("ratio", F.when(F.abs("delta_real") >= least, F.col("delta_synth") / F.col("delta_real")))  # one row each


def permuted(df: DataFrame, column: str, key: Sequence[str], seed: int | str = 42) -> DataFrame:
    """df with one column's values dealt to rows in another hash order; the key stays."""
    from .synth import global_rank

    a = global_rank(df.withColumn("_h", hash32(f"{seed}a", *(F.col(k) for k in key))), "_h", key, (), "_r").drop("_h", column)
    b = global_rank(df.select(column, *key).withColumn("_h", hash32(f"{seed}b", *(F.col(k) for k in key))), "_h", key, (), "_r").select("_r", column)
    return a.join(b, "_r").select(*df.columns)


def permutation_importance(model, data: DataFrame, features: Sequence[str], key: Sequence[str], assemble, repeats: int = 5, seed: int | str = 42) -> DataFrame:
    """feature, importance: the mean fall of macro F1 when a feature is permuted. assemble(df) makes `features` from columns."""
    base = macro_f1(model.transform(assemble(data))).first()["macro_f1"]
    rows = []
    for f in features:
        drops = [base - macro_f1(model.transform(assemble(permuted(data, f, key, f"{seed}-{f}-{i}")))).first()["macro_f1"] for i in range(repeats)]
        rows.append((f, sum(drops) / repeats))
    return data.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def compare_scores(a: DataFrame, b: DataFrame) -> DataFrame:
    """feature, seed_importance, synth_importance, delta of two importance tables, the greatest change first."""
    met = a.toDF("feature", "seed_importance").join(b.toDF("feature", "synth_importance"), "feature", "full_outer").na.fill(0.0)
    return met.withColumn("delta", F.col("synth_importance") - F.col("seed_importance")).orderBy(F.desc(F.abs("delta")), "feature")
