"""Row-local feature derivation (PR1-PR3, FE1-FE14).

Each function adds columns with one ``select``/``withColumns`` of JVM-side
expressions and skips a feature whose inputs are absent, like the
reference.  Input column names default to the snake_case medical names in
``riskloom.config``; pass ``cols={"age": "l_quantity", ...}`` to run the same
rules on any table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations, combinations_with_replacement

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasOutputCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import config
from riskloom.functions.expr import (
    cut,
    null_propagating_sum,
    null_skipping_sum,
    numeric_columns,
    value_map,
    yes_no,
)
from riskloom.operators.persist import Stored


def _name(cols: Mapping[str, str] | None, role: str) -> str:
    return (cols or {}).get(role, role)


def _is_string(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def flag(df: DataFrame, col: str) -> Column:
    """PR2: Yes/No string -> 1/0 (other -> null); numeric columns pass through."""
    return yes_no(col) if _is_string(df, col) else F.col(col)


def encode_target(df: DataFrame, target: str = config.TARGET) -> DataFrame:
    """PR1: map the Yes/No target to 1/0 in place (other values -> null)."""
    if target not in df.columns or not _is_string(df, target):
        return df
    return df.withColumn(target, yes_no(target))


def create_age_bands(df: DataFrame, cols: Mapping[str, str] | None = None,
                     bands: Sequence[tuple[float, float]] = config.AGE_BANDS,
                     out: str = "age_band") -> DataFrame:
    """FE1: half-open age bands ``[lo, hi)`` labelled ``"lo-hi"``; outside -> null."""
    age = _name(cols, "age")
    if age not in df.columns:
        return df
    edges = [b[0] for b in bands] + [bands[-1][1]]
    labels = [f"{lo}-{hi}" for lo, hi in bands]
    return df.withColumn(out, cut(age, edges, labels, right=False))


def create_interaction_features(df: DataFrame, cols: Mapping[str, str] | None = None,
                                numeric_only: bool = False) -> DataFrame:
    """FE2 (4 features) / FE3 (``numeric_only=True``: the two numeric ones)."""
    age, bp, bmi = _name(cols, "age"), _name(cols, "blood_pressure"), _name(cols, "bmi")
    chol, dia, smk = (_name(cols, "cholesterol_level"), _name(cols, "diabetes"),
                      _name(cols, "smoking"))
    have = set(df.columns)
    new: dict[str, Column] = {}
    if age in have and bp in have:
        new["age_bp_interaction"] = F.col(age) * F.col(bp) / 100
    if bmi in have and chol in have:
        new["bmi_cholesterol_interaction"] = F.col(bmi) * F.col(chol) / 100
    if not numeric_only:
        if age in have and dia in have:
            new["age_diabetes_interaction"] = F.col(age) * flag(df, dia)
        if smk in have and chol in have:
            new["smoking_cholesterol_interaction"] = flag(df, smk) * F.col(chol)
    return df.withColumns(new) if new else df


def compute_lipid_ratio(df: DataFrame, cols: Mapping[str, str] | None = None) -> DataFrame:
    """FE4: ``chol * (1 + low_hdl) * (1 + high_ldl) / 100`` -> ``lipid_risk_factor``."""
    chol, hdl, ldl = (_name(cols, "cholesterol_level"), _name(cols, "low_hdl_cholesterol"),
                      _name(cols, "high_ldl_cholesterol"))
    if not {chol, hdl, ldl} <= set(df.columns):
        return df
    expr = F.col(chol) * (1 + flag(df, hdl)) * (1 + flag(df, ldl)) / 100
    return df.withColumn("lipid_risk_factor", expr)


def framingham_score(df: DataFrame, cols: Mapping[str, str] | None = None) -> DataFrame:
    """FE5: placeholder score ``age/10 + chol/50 + bp/20 + 2*smoking`` (not clinically valid)."""
    age, chol, bp, smk = (_name(cols, "age"), _name(cols, "cholesterol_level"),
                          _name(cols, "blood_pressure"), _name(cols, "smoking"))
    if not {age, chol, bp, smk} <= set(df.columns):
        return df
    expr = null_propagating_sum([F.col(age) / 10, F.col(chol) / 50, F.col(bp) / 20,
                                 flag(df, smk) * 2])
    return df.withColumn("framingham_score_est", expr)


def ascvd_score(df: DataFrame, cols: Mapping[str, str] | None = None) -> DataFrame:
    """FE6: placeholder ``age/10 + chol/60 + bp/15 + 1.5*diabetes + 1.5*smoking``."""
    age, chol, bp, dia, smk = (_name(cols, "age"), _name(cols, "cholesterol_level"),
                               _name(cols, "blood_pressure"), _name(cols, "diabetes"),
                               _name(cols, "smoking"))
    if not {age, chol, bp, dia, smk} <= set(df.columns):
        return df
    expr = null_propagating_sum([F.col(age) / 10, F.col(chol) / 60, F.col(bp) / 15,
                                 flag(df, dia) * 1.5, flag(df, smk) * 1.5])
    return df.withColumn("ascvd_score_est", expr)


def _poly_terms(names: Sequence[str], degree: int, interaction_only: bool):
    combos = combinations if interaction_only else combinations_with_replacement
    for d in range(2, degree + 1):
        for idx in combos(range(len(names)), d):
            powers: dict[int, int] = {}
            for i in idx:
                powers[i] = powers.get(i, 0) + 1
            label = " ".join(names[i] if e == 1 else f"{names[i]}^{e}" for i, e in powers.items())
            expr = None
            for i in idx:
                expr = F.col(names[i]) if expr is None else expr * F.col(names[i])
            yield label, expr


def add_polynomial_features(df: DataFrame, cols: Sequence[str], degree: int = 2,
                            interaction_only: bool = False) -> DataFrame:
    """FE7: powers and cross-products of ``cols`` up to ``degree``.

    Names follow the usual ``"a^2"`` / ``"a b"`` convention, in
    combinations-with-replacement order; the inputs are not repeated.  One
    ``select`` (not a ``withColumn`` chain) keeps the plan flat.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    terms = list(_poly_terms(cols, degree, interaction_only))
    return df.select("*", *[e.alias(n) for n, e in terms])


def create_polynomial_features(df: DataFrame, degree: int = 2, interaction_only: bool = True,
                               exclude: Sequence[str] = ()) -> DataFrame:
    """FE8: polynomial terms of every numeric column (cross-products only by default)."""
    return add_polynomial_features(df, numeric_columns(df, exclude), degree, interaction_only)


def health_risk_score(df: DataFrame, cols: Mapping[str, str] | None = None,
                      factors=config.HEALTH_RISK_FACTORS, out: str = "health_risk_score") -> DataFrame:
    """FE9: weighted count of risk factors; null or absent factors add 0."""
    terms = [F.lit(0.0)]
    for role, weight, rule, operand in factors:
        col = _name(cols, role)
        if col not in df.columns:
            continue
        c = F.col(col)
        cond = c > operand if rule == ">" else c < operand if rule == "<" else c == operand
        terms.append(F.when(cond, F.lit(float(weight))).otherwise(F.lit(0.0)))
    expr = terms[0]
    for t in terms[1:]:
        expr = expr + t
    return df.withColumn(out, expr)


def medical_risk_score(df: DataFrame, cols: Mapping[str, str] | None = None,
                       thresholds=config.MEDICAL_RISK_THRESHOLDS,
                       outputs=config.MEDICAL_RISK_OUTPUTS) -> DataFrame:
    """FE10: 0/1/2 per factor (``>=`` moderate/high, null -> 0), combined scores.

    ``diabetes_combined_risk = glucose_risk + diabetes`` propagates nulls;
    ``cv_risk_score`` is a null-skipping row sum.
    """
    new: dict[str, Column] = {}
    for role, out in outputs.items():
        col = _name(cols, role)
        if col not in df.columns:
            continue
        high, moderate = thresholds[role]
        c = F.col(col)
        new[out] = F.when(c >= high, 2).when(c >= moderate, 1).otherwise(0)
    dia = _name(cols, "diabetes")
    if "glucose_risk" in new and dia in df.columns:
        new["diabetes_combined_risk"] = new["glucose_risk"] + flag(df, dia)
    risk = [new[k] for k in ("age_risk", "bp_risk", "cholesterol_risk", "bmi_risk",
                             "diabetes_combined_risk") if k in new]
    if risk:
        new["cv_risk_score"] = null_skipping_sum(risk)
    return df.withColumns(new) if new else df


class _Roles(Params):
    cols = Param(Params._dummy(), "cols", "column of each role, where it isn't the role's name")


class HealthRiskScore(Transformer, _Roles, HasOutputCol, Stored):
    """FE9 as a pipeline stage."""

    @keyword_only
    def __init__(self, cols=None, outputCol="health_risk_score"):
        super().__init__()
        self._setDefault(cols={}, outputCol="health_risk_score")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return health_risk_score(df, self.getOrDefault(self.cols), out=self.getOutputCol())


class MedicalRiskScore(Transformer, _Roles, Stored):
    """FE10 as a pipeline stage."""

    @keyword_only
    def __init__(self, cols=None):
        super().__init__()
        self._setDefault(cols={})
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return medical_risk_score(df, self.getOrDefault(self.cols))


def create_risk_clusters(df: DataFrame, cols: Mapping[str, str] | None = None,
                         mapping=config.BINARY_MAP) -> DataFrame:
    """FE11: ordinal-mapped lifestyle/medical factors and their row sums.

    ``<col>_numeric``: mapped level, unknown string -> 0, null stays null;
    sums skip nulls; ``age_family_history_risk = age * map(family)`` where an
    unknown level gives null.
    """
    new: dict[str, Column] = {}

    def numeric(col: str) -> Column:
        return value_map(col, mapping, unknown=0.0) if _is_string(df, col) else F.col(col)

    for group, factors in (("lifestyle_risk_score", config.LIFESTYLE_FACTORS),
                           ("medical_risk_score", config.MEDICAL_FACTORS)):
        present = [_name(cols, f) for f in factors if _name(cols, f) in df.columns]
        if present:
            for c in present:
                new[f"{c}_numeric"] = numeric(c)
            new[group] = null_skipping_sum([new[f"{c}_numeric"] for c in present])
    fam, age = _name(cols, "family_heart_disease"), _name(cols, "age")
    if fam in df.columns and age in df.columns:
        fam_num = value_map(fam, mapping, unknown=None) if _is_string(df, fam) else F.col(fam)
        new["age_family_history_risk"] = F.col(age) * fam_num
    return df.withColumns(new) if new else df


def notebook_age_groups(df: DataFrame, cols: Mapping[str, str] | None = None,
                        out: str = "age_group") -> DataFrame:
    """FE12: six half-open groups ``<30 ... 70+``."""
    age = _name(cols, "age")
    if age not in df.columns:
        return df
    return df.withColumn(out, cut(age, config.NOTEBOOK_AGE_BINS, config.NOTEBOOK_AGE_LABELS))


def risk_factor_count(df: DataFrame, cols: Mapping[str, str] | None = None,
                      flags=config.RISK_FACTOR_FLAGS, out: str = "risk_factor_count") -> DataFrame:
    """FE13: null-skipping count of Yes flags."""
    present = [_name(cols, f) for f in flags if _name(cols, f) in df.columns]
    if not present:
        return df
    return df.withColumn(out, null_skipping_sum([flag(df, c) for c in present]))


def engineer_features(df: DataFrame, cols: Mapping[str, str] | None = None,
                      poly_inputs: Sequence[str] | None = None) -> DataFrame:
    """The main flow's feature block: bands, interactions, lipid, two scores, polynomials."""
    out = create_age_bands(df, cols)
    out = create_interaction_features(out, cols)
    out = compute_lipid_ratio(out, cols)
    out = framingham_score(out, cols)
    out = ascvd_score(out, cols)
    inputs = poly_inputs if poly_inputs is not None else [
        _name(cols, c) for c in config.NUMERICAL_FEATURES]
    return add_polynomial_features(out, [c for c in inputs if c in numeric_columns(out)], 2)
