"""Encoding and feature-vector assembly (EN1-EN7, IM6, IM7) as pyspark.ml stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators.impute import fill, mode_values
from riskloom.operators.persist import Fitted, Stored
from riskloom.plans.quantiles import exact_median
from riskloom.session import cut_lineage, discard, written


class _Strategy(Params):
    strategy = Param(Params._dummy(), "strategy", "median | mean | most_frequent",
                     typeConverter=TypeConverters.toString)


class ExactImputerModel(Model, HasInputCols, HasOutputCols, Fitted):
    def __init__(self, values: dict | None = None):
        super().__init__()
        self._set(state=values or {})

    @property
    def values(self) -> dict:
        return self.learnt()

    def _transform(self, df: DataFrame) -> DataFrame:
        ins, outs = self.getInputCols(), self.getOutputCols()
        filled = fill(df.withColumns({o: F.col(i) for i, o in zip(ins, outs) if o != i}),
                      {o: self.values.get(i) for i, o in zip(ins, outs)})
        return filled


class ExactImputer(Estimator, HasInputCols, HasOutputCols, _Strategy, Stored):
    """IM6/IM7: median (exact, interpolated), mean, or most frequent (strings too).

    Spark's ``Imputer`` gives an element of the data for the median and
    rejects strings; this one matches the usual semantics.
    """

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, strategy="median"):
        super().__init__()
        self._setDefault(strategy="median")
        kwargs = self._input_kwargs
        if kwargs.get("outputCols") is None and kwargs.get("inputCols") is not None:
            kwargs["outputCols"] = kwargs["inputCols"]
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> ExactImputerModel:
        cols = self.getInputCols()
        s = self.getOrDefault(self.strategy)
        if s == "median":
            values = exact_median(df, cols)
        elif s == "mean":
            r = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
            values = {c: r[c] for c in cols}
        else:
            values = mode_values(df, cols)
        m = ExactImputerModel(values)
        m._set(inputCols=cols, outputCols=self.getOutputCols())
        return m


class PopulationScalerModel(Model, HasInputCols, HasOutputCols, Fitted):
    def __init__(self, stats: dict | None = None):
        super().__init__()
        self._set(state=stats or {})

    @property
    def stats(self) -> dict:
        return self.learnt()

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for i, o in zip(self.getInputCols(), self.getOutputCols()):
            mean, std = self.stats[i]
            scale = std if std and std > 0 else 1.0
            new[o] = (F.col(i).cast("double") - F.lit(mean or 0.0)) / F.lit(scale)
        return df.withColumns(new)


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, Stored):
    """EN2: z-score with the population std; a constant column scales to 0.

    (Spark's ``StandardScaler`` divides by the sample std.)  One aggregation
    fits every column.
    """

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        cols = self.getInputCols()
        r = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        m = PopulationScalerModel({c: (r[f"m{i}"], r[f"s{i}"]) for i, c in enumerate(cols)})
        m._set(inputCols=cols, outputCols=self.getOutputCols())
        return m


def preprocessing_pipeline(numeric: Sequence[str], categorical: Sequence[str],
                           output: str = "features") -> Pipeline:
    """EN1: median-impute + population-scale numerics, mode-impute + one-hot categoricals.

    One-hot keeps every level in alphabetical order and maps unseen levels
    to all zeros (indexer ``keep`` + encoder ``dropLast`` drops exactly the
    unseen slot).  Columns not listed are left out of the vector.
    """
    numeric, categorical = list(numeric), list(categorical)
    stages = []
    num_out = [f"{c}__scaled" for c in numeric]
    if numeric:
        stages += [ExactImputer(inputCols=numeric, outputCols=[f"{c}__imp" for c in numeric],
                                strategy="median"),
                   PopulationScaler(inputCols=[f"{c}__imp" for c in numeric], outputCols=num_out)]
    cat_out = [f"{c}__onehot" for c in categorical]
    if categorical:
        imp = [f"{c}__imp" for c in categorical]
        idx = [f"{c}__idx" for c in categorical]
        stages += [ExactImputer(inputCols=categorical, outputCols=imp, strategy="most_frequent"),
                   StringIndexer(inputCols=imp, outputCols=idx, handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=idx, outputCols=cat_out, dropLast=True)]
    stages.append(VectorAssembler(inputCols=num_out + cat_out, outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """EN5: vector slot -> name (``num__x`` / ``cat__x_level``), generic names as fallback."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs += group
    if not attrs:
        n = meta.get("num_attrs", 0)
        return [f"feature_{i}" for i in range(n)]
    names = [""] * (max(a["idx"] for a in attrs) + 1)
    for a in attrs:
        raw = a.get("name", f"feature_{a['idx']}")
        if "__scaled" in raw:
            names[a["idx"]] = "num__" + raw.split("__scaled")[0]
        elif "__onehot_" in raw:
            col, level = raw.split("__onehot_", 1)
            names[a["idx"]] = f"cat__{col}_{level}"
        else:
            names[a["idx"]] = raw
    return [n or f"feature_{i}" for i, n in enumerate(names)]


def get_dummies(df: DataFrame, col: str, drop_first: bool = True, levels: Sequence[str] | None = None
                ) -> DataFrame:
    """EN4: one 0/1 column per sorted level (the first dropped); the source column is removed."""
    lv = sorted(levels) if levels is not None else [
        r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]
    use = lv[1:] if drop_first else lv
    return df.withColumns({f"{col}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in use}).drop(col)


def select_features_with_model(df: DataFrame, label: str, features: str = "features",
                               threshold: str | float = "mean", max_features: int | None = None,
                               num_trees: int = 100, seed: int = 42):
    """EN6: keep vector slots whose forest importance >= threshold (at most ``max_features``).

    Returns ``(sliced_df, kept_indices)``; a failing fit raises.
    """
    from pyspark.ml.classification import RandomForestClassifier

    rf = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees, seed=seed)
    imp = rf.fit(df).featureImportances.toArray()
    cut = imp.mean() if threshold == "mean" else float(threshold)
    keep = [i for i in range(len(imp)) if imp[i] >= cut]
    if max_features is not None:
        keep = sorted(sorted(keep, key=lambda i: -imp[i])[:max_features])
    sliced = VectorSlicer(inputCol=features, outputCol=f"{features}__sel", indices=keep).transform(df)
    return sliced.drop(features).withColumnRenamed(f"{features}__sel", features), keep


def select_features_with_rfe(df: DataFrame, label: str, feature_cols: Sequence[str], fold: str = "fold",
                             k: int | None = None, step: int = 1, min_features_to_select: int = 5,
                             num_trees: int = 100, seed: int = 42):
    """EN7: recursive elimination scored by cross-validated recall.

    Each round fits a forest on the current columns (importances) and
    cross-validates it over the ``fold`` column; the ``step`` least important
    columns go, down to ``min_features_to_select`` (honoured, unlike the
    reference which overwrites it).  Returns ``(best_columns, scores)``.  A fit
    reads its rows several times, so the columns that count are kept once for all.
    """
    rows = df.select(*dict.fromkeys([label, fold, *feature_cols]))
    if rows.count() <= config.ROWS_PER_BUCKET:
        return _eliminated(cut_lineage(rows), label, feature_cols, fold, k, step, min_features_to_select, num_trees, seed)
    kept = written(rows, rows_per_file=config.ROWS_PER_FILE)
    try:
        return _eliminated(kept, label, feature_cols, fold, k, step, min_features_to_select, num_trees, seed)
    finally:
        discard(kept)


def _eliminated(df: DataFrame, label: str, feature_cols: Sequence[str], fold: str, k: int | None, step: int,
                min_features_to_select: int, num_trees: int, seed: int):
    from pyspark.ml.classification import RandomForestClassifier

    from riskloom.operators.metrics import confusion

    k = k or df.select(F.max(fold)).first()[0] + 1
    current = list(feature_cols)
    scores = {}
    while True:
        asm = VectorAssembler(inputCols=current, outputCol="_rfe_x", handleInvalid="keep")
        data = asm.transform(df)
        rf = RandomForestClassifier(labelCol=label, featuresCol="_rfe_x", numTrees=num_trees, seed=seed)
        preds = None
        for i in range(k):
            m = rf.fit(data.where(F.col(fold) != i))
            p = m.transform(data.where(F.col(fold) == i)).select(label, "prediction", F.lit(i).alias("_f"))
            preds = p if preds is None else preds.unionByName(p)
        conf = confusion(preds.withColumn("prediction", F.col("prediction").cast("int")), label,
                         "prediction", ["_f"])
        rec = conf.select(F.avg(F.when(F.col("true_positives") + F.col("false_negatives") > 0,
                                       F.col("true_positives") / (F.col("true_positives") + F.col("false_negatives")))
                                .otherwise(0.0))).first()[0]
        scores[tuple(current)] = rec
        if len(current) <= min_features_to_select:
            break
        imp = rf.fit(data).featureImportances.toArray()
        order = sorted(range(len(current)), key=lambda i: imp[i])
        drop = set(order[:min(step, len(current) - min_features_to_select)])
        current = [c for i, c in enumerate(current) if i not in drop]
    best = max(scores, key=lambda s: (scores[s], -len(s)))
    return list(best), scores
