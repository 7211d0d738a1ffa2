"""Classifiers and model inspection (MD1-MD12) on ``pyspark.ml``.

Fitting is distributed ``pyspark.ml``; the wrappers only translate the
reference's parameters (``C``, ``class_weight``, ``scale_pos_weight``...)
into Spark's and add a ``score`` column (probability of class 1).
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions.expr import cut
from riskloom.operators.balance import get_class_weights
from riskloom.operators.forest import Forest, ForestModel
from riskloom.operators.persist import Fitted, Stored
from riskloom.session import written


def with_score(df: DataFrame, probability: str = "probability", out: str = "score") -> DataFrame:
    """Probability of class 1 as a double column."""
    return df.withColumn(out, vector_to_array(probability)[1])


# --------------------------------------------------------------------- MD1
class MajorityModel(Model, HasPredictionCol, Fitted):
    def __init__(self, majority=0):
        super().__init__()
        self._set(state=[majority])

    @property
    def majority(self):
        return self.learnt()[0]

    def _transform(self, df: DataFrame) -> DataFrame:
        p1 = 1.0 if self.majority == 1 else 0.0
        return df.withColumns({
            "prediction": F.lit(float(self.majority)),
            "probability": array_to_vector(F.array(F.lit(1.0 - p1), F.lit(p1))),
            "score": F.lit(p1)})


class MajorityClassifier(Estimator, HasLabelCol, Stored):
    """MD1: always the most frequent class (lowest on ties), probability 1 for it."""

    @keyword_only
    def __init__(self, labelCol="label"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MajorityModel:
        lab = self.getLabelCol()
        counts = df.where(F.col(lab).isNotNull()).groupBy(lab).count()
        best = counts.agg(F.min_by(lab, F.struct(-F.col("count"), F.col(lab)))).first()[0]
        return MajorityModel(best)


# --------------------------------------------------------------------- MD2
class _LRParams(Params):
    C = Param(Params._dummy(), "C", "inverse regularisation strength", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "l1 or l2", TypeConverters.toString)
    classWeight = Param(Params._dummy(), "classWeight", "'balanced', none or 'p1=w1,p0=w0'",
                        TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "max iterations", TypeConverters.toInt)


class SkLogisticRegression(Estimator, HasFeaturesCol, HasLabelCol, _LRParams, Stored):
    """MD2: logistic regression with ``C`` / ``penalty`` / ``class_weight``.

    The reference minimises ``C * sum(w_i loss_i) + penalty``; Spark
    minimises ``sum(w_i loss_i) / sum(w) + regParam * penalty``, hence
    ``regParam = 1 / (C * sum(w))`` (``sum(w)`` is one aggregation).  The
    intercept is not penalised in Spark.
    """

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", C=1.0, penalty="l2",
                 classWeight="balanced", maxIter=1000):
        super().__init__()
        self._setDefault(C=1.0, penalty="l2", classWeight="balanced", maxIter=1000)
        self._set(**self._input_kwargs)

    def class_weights(self, counts: dict) -> tuple[float, float]:
        """Weights of the classes 0 and 1, of which ``counts`` has the rows."""
        cw = self.getOrDefault(self.classWeight)
        if cw in ("", "none", None):
            return 1.0, 1.0
        if cw == "balanced":
            return tuple(sum(counts.values()) / (2 * counts[k]) for k in (0, 1))
        given = {float(k): float(v) for k, v in (p.split("=") for p in cw.split(","))}
        return given.get(0.0, 1.0), given.get(1.0, 1.0)

    def _weights(self, df: DataFrame):
        lab = self.getLabelCol()
        cw = self.getOrDefault(self.classWeight)
        if cw in ("", "none", None):
            return df.withColumn("_w", F.lit(1.0))
        if cw == "balanced":
            w = get_class_weights(df, lab)
        else:
            w = {float(k): float(v) for k, v in (p.split("=") for p in cw.split(","))}
        expr = None
        for k, v in w.items():
            cond = F.col(lab) == F.lit(k)
            expr = F.when(cond, F.lit(float(v))) if expr is None else expr.when(cond, F.lit(float(v)))
        return df.withColumn("_w", expr.otherwise(F.lit(1.0)))

    def _fit(self, df: DataFrame):
        data = self._weights(df.withColumn(self.getLabelCol(), F.col(self.getLabelCol()).cast("double")))
        total_w = data.agg(F.sum("_w")).first()[0] or 1.0
        reg = 1.0 / (self.getOrDefault(self.C) * total_w)
        lr = LogisticRegression(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
                                weightCol="_w", regParam=reg,
                                elasticNetParam=1.0 if self.getOrDefault(self.penalty) == "l1" else 0.0,
                                standardization=False, maxIter=self.getOrDefault(self.maxIter),
                                tol=1e-4)  # the reference solver's default tolerance
        return lr.fit(data)


class SolvedLogisticModel(Model):
    """MD2's scores by given coefficients."""

    def __init__(self, coefficients, intercept, features: str = "features"):
        super().__init__()
        self.coefficients, self.intercept, self.features = DenseVector(coefficients), float(intercept), features

    def _transform(self, df: DataFrame) -> DataFrame:
        x = vector_to_array(self.features) if dict(df.dtypes)[self.features] == "vector" else F.col(self.features)
        products = F.zip_with(x, F.array(*(F.lit(float(c)) for c in self.coefficients)), lambda a, b: a * b)
        z = F.aggregate(products, F.lit(self.intercept), lambda s, v: s + v)
        out = df.withColumn("rawPrediction", array_to_vector(F.array(-z, z)))
        p = 1 / (1 + F.exp(vector_to_array("rawPrediction")[0]))
        return out.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn(
            "prediction", (vector_to_array("probability")[1] > 0.5).cast("double"))


def logistic_model(**kw) -> SkLogisticRegression:
    p = dict(config.LOGISTIC_REGRESSION_PARAMS)
    p.update(kw)
    return SkLogisticRegression(C=p["C"], penalty=p["penalty"],
                                classWeight=p.get("class_weight") or "none", maxIter=p["max_iter"],
                                featuresCol=p.get("featuresCol", "features"),
                                labelCol=p.get("labelCol", "label"))


# --------------------------------------------------------------------- MD3
def forest_depth(max_depth: int | None) -> int:
    """The depth that stands for ``max_depth`` (None: unlimited): Spark's limit where it is beyond that, with a warning."""
    if max_depth is not None and max_depth <= config.MAX_TREE_DEPTH:
        return max_depth
    if max_depth is not None:
        warnings.warn(f"trees of depth {max_depth} are grown to Spark's limit of {config.MAX_TREE_DEPTH}", stacklevel=3)
    return config.MAX_TREE_DEPTH


def random_forest_model(label: str = "label", features: str = "features", weight: str | None = None,
                        n_estimators: int = config.RANDOM_FOREST_PARAMS["n_estimators"],
                        max_depth: int | None = None,
                        min_samples_leaf: int = config.RANDOM_FOREST_PARAMS["min_samples_leaf"],
                        bootstrap: bool = True, criterion: str = "gini",
                        seed: int = config.RANDOM_STATE) -> Forest:
    """MD3: ``max_depth`` as in `forest_depth`."""
    depth = forest_depth(max_depth)
    # more node statistics per pass and cached node ids: fewer passes over the data
    kw = dict(labelCol=label, featuresCol=features, numTrees=n_estimators, maxDepth=depth,
              minInstancesPerNode=min_samples_leaf, bootstrap=bootstrap, impurity=criterion,
              featureSubsetStrategy="sqrt", seed=seed, maxMemoryInMB=1024, cacheNodeIds=True,
              checkpointInterval=10)
    if weight:
        kw["weightCol"] = weight
    return Forest(**kw)


# --------------------------------------------------------------------- MD4/MD5
def boosting_model(label: str = "label", features: str = "features", weight: str | None = None,
                   learning_rate: float = config.XGBOOST_PARAMS["learning_rate"],
                   max_depth: int = config.XGBOOST_PARAMS["max_depth"],
                   n_estimators: int = 100,
                   subsample: float = config.XGBOOST_PARAMS["subsample"],
                   colsample: float | str = config.XGBOOST_PARAMS["colsample_bytree"],
                   min_child_weight: int = config.XGBOOST_PARAMS["min_child_weight"],
                   gamma: float = config.XGBOOST_PARAMS["gamma"],
                   validation_col: str | None = None,
                   seed: int = config.RANDOM_STATE) -> GBTClassifier:
    """MD4/MD5: gradient-boosted trees (logistic loss).

    ``colsample`` is applied per split node in Spark (per tree in the
    reference); ``min_child_weight`` maps to ``minInstancesPerNode`` and
    ``gamma`` to ``minInfoGain``; early stopping via ``validation_col``.
    """
    kw = dict(labelCol=label, featuresCol=features, stepSize=learning_rate, maxDepth=max_depth,
              maxIter=n_estimators, subsamplingRate=subsample,
              featureSubsetStrategy=str(colsample) if not isinstance(colsample, str) else colsample,
              minInstancesPerNode=int(min_child_weight), minInfoGain=float(gamma), seed=seed)
    if weight:
        kw["weightCol"] = weight
    if validation_col:
        kw["validationIndicatorCol"] = validation_col
    return GBTClassifier(**kw)


# --------------------------------------------------------------------- MD6-MD9
def analyze_coefficients(lr_model, names: Sequence[str]) -> DataFrame:
    """MD6: ``feature, coefficient, absolute_value`` sorted by absolute value."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    coef = lr_model.coefficients.toArray().tolist()
    rows = [(n, float(c), abs(float(c))) for n, c in zip(names, coef)]
    return spark.createDataFrame(rows, "feature string, coefficient double, absolute_value double"
                                 ).orderBy(F.desc("absolute_value"))


def feature_importance(tree_model, names: Sequence[str]) -> DataFrame:
    """MD7 (gini) / MD8: ``feature, importance`` sorted descending."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    imp = tree_model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def permutation_importance(model, df: DataFrame, names: Sequence[str], label: str = "label",
                           features: str = "features", seed: int = config.RANDOM_STATE) -> DataFrame:
    """MD7 ``'permutation'``: recall drop when one vector slot is shuffled.

    The shuffle pairs each row with the row of equal rank under a second
    hash order (two exact bucketed ranks and an equi-join on the rank), so it
    is a distributed permutation, reproducible by seed.  All rows are shuffled;
    recall is a share of the rows of class 1, so only these are scored.
    """
    from riskloom.operators.metrics import confusion, rates
    from riskloom.plans.running import exact_rank

    base = df.withColumn("_arr", vector_to_array(features))
    h = F.xxhash64(F.lit(seed), F.col("_arr").cast("string"))
    base = base.withColumn("_h", h).withColumn("_h2", F.xxhash64(F.lit(seed + 7), F.col("_arr").cast("string")))
    a = exact_rank(base, [], [("_h", True), ("_h2", True)], "_ra")
    b = exact_rank(base.select("_arr", "_h", "_h2"), [], [("_h2", True), ("_h", True)], "_rb")

    donors = b.select(F.col("_rb").alias("_ra"), F.col("_arr").alias("_donor"))
    pairs = written(a.join(donors, on="_ra").select(label, "_arr", "_donor"))
    # every row of class 1 once per slot, and once as it is (slot -1); all slots are scored and counted in one job
    slots = pairs.where(F.col(label) == 1).withColumn("_slot", F.explode(F.sequence(F.lit(-1), F.lit(len(names) - 1))))
    mixed = F.transform("_arr", lambda x, i: F.when(i == F.col("_slot"), F.get("_donor", i)).otherwise(x))
    pred = model.transform(slots.select(label, "_slot", array_to_vector(mixed).alias(features)))
    pred = pred.withColumn("prediction", F.col("prediction").cast("int"))
    recall = {r["_slot"]: r["recall"] for r in rates(confusion(pred, label, "prediction", ["_slot"])).collect()}
    recall = recall or dict.fromkeys(range(-1, 0 if pairs.isEmpty() else len(names)), 0.0)  # 0 without rows of class 1
    out = [(name, float(recall[-1] - recall[j])) for j, name in enumerate(names) if j in recall]
    spark = df.sparkSession
    return spark.createDataFrame(out, "feature string, importance double").orderBy(F.desc("importance"))


def analyze_tree_paths(rf_model, names: Sequence[str], path: str, top: int = 10) -> DataFrame:
    """MD9: split count per feature and mean node id (depth proxy) over all trees, in two rankings.

    ``ranking`` is ``split_count`` (most splits first) or ``depth`` (smallest
    mean node id first, features without a split left out); ``top`` rows each.
    A Spark model is written to ``path`` (a shared folder) and its node table is
    read back with Spark, so the per-node work is a distributed group-by; the
    tasks that grow a `ForestModel` have counted its splits.
    """
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    if isinstance(rf_model, ForestModel):
        stats = s.createDataFrame(rf_model.path_stats(), "idx int, split_count long, mean_node_id double")
    else:
        rf_model.write().overwrite().save(path)
        nodes = s.read.parquet(f"{path}/data")
        splits = nodes.where(F.col("nodeData.split.featureIndex") >= 0).select(
            F.col("nodeData.split.featureIndex").alias("idx"), F.col("nodeData.id").alias("node_id"))
        stats = splits.groupBy("idx").agg(F.count(F.lit(1)).alias("split_count"),
                                          F.avg("node_id").alias("mean_node_id"))
    names_df = s.createDataFrame([(i, n) for i, n in enumerate(names)], "idx int, feature string")
    full = names_df.join(stats, on="idx", how="left").select(
        "feature", F.coalesce("split_count", F.lit(0)).cast("long").alias("split_count"),
        F.coalesce("mean_node_id", F.lit(0.0)).alias("mean_node_id"))
    most = full.orderBy(F.desc("split_count"), "feature").limit(top)
    nearest = full.where("split_count > 0").orderBy("mean_node_id", "feature").limit(top)
    return most.withColumn("ranking", F.lit("split_count")).unionByName(nearest.withColumn("ranking", F.lit("depth")))


# --------------------------------------------------------------------- MD10
def interpret_predictions(scored: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    """MD10: probability, prediction (``>= threshold``) and the 5 risk levels ``(lo, hi]``."""
    return scored.withColumns({
        "prediction_t": (F.col(score) >= F.lit(threshold)).cast("int"),
        "risk_level": cut(score, config.RISK_LEVEL_BINS, config.RISK_LEVEL_LABELS, right=True)})


def risk_level_counts(scored: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    return interpret_predictions(scored, threshold, score).groupBy("risk_level").count()


# --------------------------------------------------------------------- MD11/MD12
def score_with(models: dict, df: DataFrame) -> DataFrame:
    """Apply several fitted models to one frame; adds ``score_<name>`` and ``pred_<name>``."""
    out = df
    for name, m in models.items():
        t = m.transform(out)
        t = with_score(t).withColumnRenamed("score", f"score_{name}").withColumn(
            f"pred_{name}", F.col("prediction").cast("int"))
        out = t.drop("prediction", "probability", "rawPrediction")
    return out


def voting(scored: DataFrame, names: Sequence[str], weights: Sequence[float] | None = None,
           voting: str = "soft") -> DataFrame:
    """MD11: weighted soft vote (mean probability) or weighted hard vote.

    Uses the already-fitted members (no refit).  Ties go to class 0.
    """
    w = list(weights) if weights else [1.0] * len(names)
    tot = float(sum(w))
    if voting == "soft":
        avg = sum((F.col(f"score_{n}") * F.lit(float(wi)) for n, wi in zip(names, w)), F.lit(0.0)) / tot
        return scored.withColumns({"score": avg, "prediction": (avg > 0.5).cast("int")})
    votes1 = sum((F.col(f"pred_{n}") * F.lit(float(wi)) for n, wi in zip(names, w)), F.lit(0.0))
    return scored.withColumns({"score": votes1 / tot, "prediction": (votes1 > tot - votes1).cast("int")})


def stacking(train: DataFrame, estimators: dict, label: str = "label", fold: str = "fold",
             features: str = "features"):
    """MD12: out-of-fold member probabilities -> balanced logistic meta-model.

    For each fold the members are fit on the other folds and score this fold;
    the meta-model learns from those out-of-fold scores; the members are then
    refit on all rows.  Returns ``(members, meta_model, names)``; score new
    rows with ``stack_score``.
    """
    from pyspark.ml.feature import VectorAssembler

    names = list(estimators)
    k = train.select(F.max(fold)).first()[0] + 1
    oof = None
    for i in range(k):
        fitted = {n: e.fit(train.where(F.col(fold) != i)) for n, e in estimators.items()}
        part = score_with(fitted, train.where(F.col(fold) == i))
        oof = part if oof is None else oof.unionByName(part)
    asm = VectorAssembler(inputCols=[f"score_{n}" for n in names], outputCol="_meta_x")
    meta = SkLogisticRegression(featuresCol="_meta_x", labelCol=label, classWeight="balanced").fit(
        asm.transform(oof))
    members = {n: e.fit(train) for n, e in estimators.items()}
    return members, meta, names


def stack_score(df: DataFrame, members: dict, meta, names: Sequence[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    s = score_with(members, df)
    s = VectorAssembler(inputCols=[f"score_{n}" for n in names], outputCol="_meta_x").transform(s)
    return with_score(meta.transform(s)).withColumn("prediction", F.col("prediction").cast("int")).drop(
        "_meta_x", "rawPrediction", "probability")
