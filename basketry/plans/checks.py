"""What must hold of fitted models whatever the data, as counts that SQL can give too.

Each job fits once, writes the predictions (cut lineage) and returns a row (rule, model, n_rows,
violations) per rule: n_rows is the number of rows that the rule is about, which SQL counts from the
given tables, and violations the number of them (or 1 for a rule about a sum) that break it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..models import estimators as L
from ..models import prep as Mp
from ..models import search as S
from ..session import cut_lineage
from . import jobs as J

RULES = ("rule", "model", "n_rows", "violations")


def _rule(df: DataFrame, rule: str, model: str, broken: Column) -> DataFrame:
    return df.agg(F.lit(rule).alias("rule"), F.lit(model).alias("model"),
                  F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.count_if(broken), F.lit(0)).alias("violations"))


def _sum_rule(df: DataFrame, rule: str, model: str, holds: Column) -> DataFrame:
    """A rule about one aggregate of all rows."""
    return df.agg(F.lit(rule).alias("rule"), F.lit(model).alias("model"), F.count(F.lit(1)).alias("n_rows"),
                  F.when(holds, 0).otherwise(1).cast("long").alias("violations"))


def _all(frames: Sequence[DataFrame]) -> DataFrame:
    return J._union(frames).select(*RULES)


# ---------------------------------------------------------------- L5–L9, J12
def classifier_checks_job(spark, sf_dir, trees: int = 50, iterations: int = 10) -> DataFrame:
    """Churn classifiers fitted on the stratified training part, on the rows they learned from.

    Each answers every row of both parts once; probabilities lie in [0, 1] and the prediction is the
    likelier class; the weighted gradient of the logistic regression vanishes for the constant and each
    term; a leaf of the decision tree answers the share of its rows; the forest and the
    boosted trees rank their rows better than chance, and the SVM's hinge loss is under that of a zero vector.
    """
    feats = J.churn_features(spark, sf_dir)
    train, test = Mp.stratified_split(feats, ["customer_id"], "churn")
    pipe = Mp.feature_pipeline(J.CHURN_NUMERIC, J.CHURN_CATEGORICAL).fit(train)
    tr = cut_lineage(Mp.balanced_class_weights(pipe.transform(train), "churn").withColumn("part", F.lit("train")))
    te = pipe.transform(test).withColumns({"part": F.lit("test"), "class_weight": F.lit(0.0)})
    every = tr.unionByName(te)
    ests = L.classifiers(label="churn", weight="class_weight", trees=trees, iterations=iterations)
    # to the end, so that the gradient can be told from zero
    ests["logistic_regression"].setMaxIter(500).setTol(1e-12)
    ests["decision_tree"].setLeafCol("leaf")
    out = []
    for name, est in ests.items():
        p = est.fit(tr).transform(every)
        score = vector_to_array("probability")[1] if "probability" in p.columns else vector_to_array("rawPrediction")[1]
        leaf = "leaf" if "leaf" in p.columns else F.lit(None).cast("double").alias("leaf")
        p = cut_lineage(p.select("customer_id", "part", "churn", "class_weight", vector_to_array("features").alias("x"),
                                 score.alias("score"), "prediction", leaf))
        for part in ("train", "test"):
            rows = p.where(F.col("part") == part)
            out.append(rows.agg(F.lit(f"rows {part}").alias("rule"), F.lit(name).alias("model"),
                                F.count(F.lit(1)).alias("n_rows"),
                                (F.count(F.lit(1)) - F.count_distinct("customer_id", "prediction")).alias("violations")))
        learned = p.where("part = 'train'")
        middle = 0.0 if name == "linear_svc" else 0.5
        out.append(_rule(p, "likelier class", name, (F.col("prediction") > 0.5) != (F.col("score") > middle)))
        if name != "linear_svc":
            out.append(_rule(p, "probability", name, ~F.col("score").between(0, 1)))
        if name == "logistic_regression":
            out.append(_gradient(learned, name))
        elif name == "decision_tree":
            shares = learned.groupBy("leaf").agg(F.avg("churn").alias("share"))  # one row per leaf
            out.append(_rule(p.join(F.broadcast(shares), "leaf", "left"), "share of the leaf", name,
                             ~F.coalesce(F.abs(F.col("score") - F.col("share")) < 1e-9, F.lit(False))))
        elif name == "linear_svc":
            sign = 2 * F.col("churn") - 1
            loss = F.sum(F.col("class_weight") * F.greatest(F.lit(0.0), 1 - sign * F.col("score")))
            out.append(_sum_rule(learned, "hinge loss", name, loss <= F.sum("class_weight") * (1 + 1e-6)))
        else:
            mean = lambda c: F.coalesce(F.avg(F.when(F.col("churn") == c, F.col("score"))), F.lit(0.5))
            out.append(_sum_rule(learned, "ranks churners first", name, mean(1) >= mean(0)))
    return _all(out)


def _gradient(p: DataFrame, name: str) -> DataFrame:
    """One violation for each term (the constant is one) whose weighted residuals do not cancel."""
    terms = p.select("class_weight", (F.col("churn") - F.col("score")).alias("r"),
                     F.posexplode(F.concat(F.array(F.lit(1.0)), "x")).alias("term", "v"))
    sums = terms.groupBy("term").agg(
        F.sum(F.col("class_weight") * F.col("r") * F.col("v")).alias("g"),
        F.sum(F.abs(F.col("class_weight") * F.col("v"))).alias("size"))
    broken = sums.select(F.count_if(F.abs("g") > 1e-4 * F.col("size"))).scalar()
    return p.agg(F.lit("gradient").alias("rule"), F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows")).withColumn(
        "violations", broken)


# ---------------------------------------------------------------- L10, L11, M1, M7, E8, W18
def segment_checks_job(spark, sf_dir, k: int = 4, pca_k: int = 2) -> DataFrame:
    """Customer segments: every row belongs to the nearest centre, the squared distances add up to no more
    than the reported cost, one cluster costs the rows' variance and k clusters less; components of the PCA do not
    correlate and carry the variance that the model says; the silhouette is what its definition gives
    from the clusters' sums; performance levels rise with the clusters' means."""
    f = Mp.zscore(J.segment_features(spark, sf_dir), J.SEGMENT_NUMERIC, suffix="_z")
    x = VectorAssembler(inputCols=[f"{c}_z" for c in J.SEGMENT_NUMERIC], outputCol="features").transform(f)
    x = cut_lineage(x.select("customer_id", "monetary", "features"))
    model = L.kmeans(k).fit(x)
    pca = Mp.pca_stage(len(J.SEGMENT_NUMERIC)).fit(x)
    sil = L.silhouette(model.transform(x))
    levels = L.performance_labels(model.transform(x), "cluster", "monetary", [f"level {i}" for i in range(k)])
    c = cut_lineage(pca.transform(levels).select(
        "customer_id", "monetary", "cluster", "performance_level", vector_to_array("features").alias("x"),
        vector_to_array("pca").alias("z")))
    centres = F.array(*[F.array(*[F.lit(float(v)) for v in m]) for m in model.clusterCenters()])
    square = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), F.lit(0.0),
                                      lambda s, v: s + v)
    c = c.withColumn("d", F.transform(centres, lambda m: square(F.col("x"), m)))
    own = F.col("d")[F.col("cluster")]
    total = F.sum(F.array_min("d"))
    cost = float(model.summary.trainingCost)
    dim = len(J.SEGMENT_NUMERIC)
    spread = sum((F.var_pop(F.col("x")[i]) for i in range(dim)), F.lit(0.0)) * F.count(F.lit(1))
    one = {r["k"]: r["inertia"] for r in L.elbow_curve(x, (1, k)).collect()}
    out = [_rule(c, "nearest centre", "kmeans", own > F.array_min("d") * (1 + 1e-9) + 1e-12),
           # MLlib reports the cost before the last move of the centres, which can only lower it
           _sum_rule(c, "cost", "kmeans", total <= cost * (1 + 1e-9)),
           _sum_rule(c, "one cluster", "elbow", F.abs(spread - one[1]) <= 1e-9 * spread),
           _sum_rule(c, "more clusters cost less", "elbow", F.lit(one[k]) <= spread)]
    shares = [float(v) for v in pca.explainedVariance.toArray()]
    var = [F.var_samp(F.col("z")[i]) for i in range(dim)]
    whole = sum(var, F.lit(0.0))
    holds = F.lit(True)
    for i, s in enumerate(shares):
        holds = holds & (F.abs(var[i] - s * whole) <= 1e-9 * whole)
    out.append(_sum_rule(c, "explained variance", "pca", holds))
    apart = F.lit(True)
    for i in range(dim):
        for j in range(i):
            apart = apart & (F.abs(F.covar_samp(F.col("z")[i], F.col("z")[j])) <= 1e-9 * whole)
    out.append(_sum_rule(c, "uncorrelated", "pca", apart))
    out.append(_silhouette_rule(c, sil, dim))
    means = c.groupBy("performance_level").agg(F.avg("monetary").alias("m")).orderBy("m").collect()  # k rows
    rising = [r["performance_level"] for r in means] == sorted(r["performance_level"] for r in means)
    out.append(_sum_rule(c, "levels rise", "performance", F.lit(rising)))
    return _all(out)


def _silhouette_rule(c: DataFrame, reported: float, dim: int) -> DataFrame:
    """Mean distance to a cluster from its count, sum and sum of squares: |x|² − 2·x·Σy/n + Σ|y|²/n."""
    stats = c.groupBy("cluster").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.array(*[F.sum(F.col("x")[i]) for i in range(dim)]).alias("s"),
        F.sum(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)).alias("q"))
    packed = stats.select(F.collect_list(F.struct("cluster", "n", "s", "q"))).scalar()  # k rows
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda t, v: t + v)
    mean = lambda g: dot(F.col("x"), F.col("x")) - 2 * dot(F.col("x"), g["s"]) / g["n"] + g["q"] / g["n"]
    d = c.withColumn("all", packed)
    mine = F.filter("all", lambda g: g["cluster"] == F.col("cluster"))[0]
    d = d.withColumn("mine", mine).withColumn("a", mean(F.col("mine")) * F.try_divide(F.col("mine.n"), F.col("mine.n") - 1))
    d = d.withColumn("b", F.array_min(F.transform(F.filter("all", lambda g: g["cluster"] != F.col("cluster")), mean)))
    s = F.when(F.col("mine.n") == 1, 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return _sum_rule(d, "silhouette", "kmeans", F.abs(F.avg(s) - reported) < 1e-6)


# ---------------------------------------------------------------- E9–E12, IO7
SMALL_FOREST = {"numTrees": [3], "maxDepth": [2, 3]}
SMALL_BOOSTED = {"maxIter": [2], "maxDepth": [2]}


def trial_checks_job(spark, sf_dir, folds: int = 5, cuts: int = 11) -> DataFrame:
    """(study, model, fold, n_settings, n_train, n_valid, violations) of small searches of every kind.

    The studies are those of the search queries with few settings. A fit learns from the rows
    outside its fold (before its cut) and is scored on those inside; each setting is tried once per fold;
    areas lie in [0, 1] and errors are not negative; the setting that a cut of the walk-forward takes is one of the grid.
    """
    c, count = L.classifiers(), F.count(F.lit(1))
    grid = J.grid_search_job(spark, sf_dir, folds, SMALL_FOREST, SMALL_BOOSTED, {"regParam": [0.1]})
    drawn = J.random_search_job(spark, sf_dir, 4, folds, J.QUERY_FOREST_SPACE | {"numTrees": S.IntRange(2, 4)},
                                J.QUERY_BOOSTED_SPACE | {"maxIter": S.IntRange(1, 3)})
    out = []
    for study, trials in (("grid", grid), ("draws", drawn)):
        most = F.when(F.col("task") == "churn", 1.0).otherwise(float("inf"))
        fine = F.coalesce(F.col("metric").between(F.lit(0.0), most), F.lit(False))
        out.append(trials.groupBy(F.concat(F.lit(f"{study} "), "task").alias("study"), "model", "fold").agg(
            count.alias("n_settings"), F.max("n_train").alias("n_train"), F.max("n_valid").alias("n_valid"),
            (count - F.count_distinct("setting") + F.count_if(~fine)
             + F.when((F.min("n_train") < F.max("n_train")) | (F.min("n_valid") < F.max("n_valid")), 1)
             .otherwise(0)).alias("violations")))
    grids = {"logistic_regression": {"regParam": [0.01, 0.1], "maxIter": [5]}, "random_forest": SMALL_FOREST,
             "gradient_boosting": SMALL_BOOSTED}
    walk = J.walk_forward_job(spark, sf_dir, cuts, 3, grids)
    known = F.lit(False)
    for m, g in grids.items():
        known = known | ((F.col("model") == m) & F.col("setting").isin([json.dumps(x) for x in S.grid(g)]))
    out.append(walk.groupBy(F.lit("walk forward").alias("study"), "model", F.col("cut").alias("fold")).agg(
        count.alias("n_settings"), F.max("n_train").alias("n_train"), F.max("n_valid").alias("n_valid"),
        F.count_if(~known | ~F.coalesce(F.col("metric").between(0, 1), F.lit(False))).alias("violations")))
    return J._union(out)


# ---------------------------------------------------------------- E18, IO8, P18
def scoring_checks_job(spark, sf_dir) -> DataFrame:
    """Batch scoring: every customer is scored once, from models saved and loaded again; probabilities
    lie in [0, 1], the tier is that of the probability, and the segment is one of the four."""
    s = cut_lineage(J.scoring_job(spark, sf_dir, iterations=10))
    p = F.col("churn_probability")
    tier = F.when(p <= 0.3, "Low").when(p <= 0.7, "Medium").otherwise("High")
    once = s.agg(F.lit("once each").alias("rule"), F.lit("churn").alias("model"), F.count(F.lit(1)).alias("n_rows"),
                 (F.count(F.lit(1)) - F.count_distinct("customer_id")).alias("violations"))
    return _all([once, _rule(s, "probability", "churn", ~F.coalesce(p.between(0, 1), F.lit(False))),
                 _rule(s, "tier", "churn", ~F.col("risk_tier").eqNullSafe(tier)),
                 _rule(s, "segment", "segments", ~F.coalesce(F.col("segment").between(0, 3), F.lit(False)))])


# ---------------------------------------------------------------- E21, E22
def group_totals(profile: DataFrame, n: str, means: Mapping[str, str]) -> DataFrame:
    """(feature, n_rows, total): what the groups' counts and means add up to."""
    wide = profile.agg(F.sum(n).alias("n_rows"), *[F.sum(F.col(n) * F.col(c)).alias(f) for f, c in means.items()])
    stack = ", ".join(f"'{f}', `{f}`" for f in means)
    return wide.selectExpr("n_rows", f"stack({len(means)}, {stack}) AS (feature, total)")


# ---------------------------------------------------------------- L15, A38, T4
def importance_checks_job(spark, sf_dir, top: int = 15, trees: int = 50, iterations: int = 10) -> DataFrame:
    """(feature, n_models, violations) of the importances of three churn models: the means that are
    ranked, checked against the written table of each model's importances, which add up to one for trees."""
    table = cut_lineage(J.churn_importances(spark, sf_dir, trees, iterations)[1])
    totals = table.groupBy("model").agg(F.sum("importance").alias("total"), F.min("importance").alias("least"))
    bad = totals.where((F.col("least") < 0) | ((F.col("model") != "logistic_regression")
                                                & (F.abs(F.col("total") - 1) > 1e-9)))
    n_bad = bad.select(F.count(F.lit(1))).scalar()
    ranked = L.top_features(table, top).select("feature", "mean_importance")
    own = table.groupBy("feature").agg(F.count(F.lit(1)).alias("n_models"),
                                       (F.sum("importance") / F.count(F.lit(1))).alias("mean"))
    return own.join(ranked, "feature", "left").select(
        "feature", "n_models", (F.when(F.abs(F.col("mean") - F.col("mean_importance")) < 1e-12, 0).otherwise(1)
                                .cast("long") + n_bad).alias("violations"))
