"""Registered feature queries (PR1-PR3, FE1-FE14)."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement


from riskloom import config
from riskloom.catalog.registry import register, view, view_sql
from riskloom.functions.expr import cut, value_map, yes_no
from riskloom.operators import features as FE

P = view_sql("patients")
NUM = config.NUMERICAL_FEATURES


def _yn(c):
    return f"(CASE WHEN {c} = 'Yes' THEN 1 WHEN {c} = 'No' THEN 0 END)"


def _map_sql(c, unknown="0.0"):
    whens = " ".join(f"WHEN {c} = '{k}' THEN CAST({v} AS DOUBLE)" for k, v in config.BINARY_MAP.items())
    tail = f"ELSE CAST({unknown} AS DOUBLE)" if unknown is not None else ""
    return f"(CASE WHEN {c} IS NULL THEN NULL {whens} {tail} END)"


def _cut_sql(c, edges, labels, right=False):
    parts = []
    for (lo, hi), lab in zip(zip(edges[:-1], edges[1:]), labels):
        cond = f"{c} > {lo} AND {c} <= {hi}" if right else f"{c} >= {lo} AND {c} < {hi}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "(CASE " + " ".join(parts) + " END)"


@register("encode_flags",
          f"SELECT age, {_yn('heart_disease_status')} AS heart_disease_status, "
          f"{_yn('smoking')} AS smoking_flag, {_map_sql('exercise_habits')} AS exercise_habits_num, "
          f"{_map_sql('alcohol_consumption')} AS alcohol_num FROM {P} AS p", operators="PR1, PR2, PR3")
def encode_flags(spark, sf):
    df = FE.encode_target(view(spark, sf, "patients"), "heart_disease_status")
    return df.select("age", "heart_disease_status", yes_no("smoking").alias("smoking_flag"),
                     value_map("exercise_habits", config.BINARY_MAP).alias("exercise_habits_num"),
                     value_map("alcohol_consumption", config.BINARY_MAP).alias("alcohol_num"))


_bands = [0, 40, 60, 100]
_band_labels = ["0-40", "40-60", "60-100"]


@register("age_bands",
          f"SELECT age, {_cut_sql('age', _bands, _band_labels)} AS age_band, "
          f"{_cut_sql('crp_level', [0, 2, 4, 6, 8, 10], ['a', 'b', 'c', 'd', 'e'], True)} AS crp_band "
          f"FROM {P} AS p", operators="FE1, FE14")
def age_bands(spark, sf):
    df = FE.create_age_bands(view(spark, sf, "patients"))
    return df.select("age", "age_band",
                     cut("crp_level", [0, 2, 4, 6, 8, 10], ["a", "b", "c", "d", "e"], right=True)
                     .alias("crp_band"))


@register("notebook_age_groups",
          f"SELECT age, {_cut_sql('age', config.NOTEBOOK_AGE_BINS, config.NOTEBOOK_AGE_LABELS)} "
          f"AS age_group FROM {P} AS p", operators="FE12")
def notebook_age_groups(spark, sf):
    return FE.notebook_age_groups(view(spark, sf, "patients")).select("age", "age_group")


@register("interaction_features",
          f"SELECT age * blood_pressure / 100 AS age_bp_interaction, "
          f"bmi * cholesterol_level / 100 AS bmi_cholesterol_interaction, "
          f"age * {_yn('diabetes')} AS age_diabetes_interaction, "
          f"{_yn('smoking')} * cholesterol_level AS smoking_cholesterol_interaction FROM {P} AS p",
          operators="FE2")
def interaction_features(spark, sf):
    df = FE.create_interaction_features(view(spark, sf, "patients"))
    return df.select("age_bp_interaction", "bmi_cholesterol_interaction",
                     "age_diabetes_interaction", "smoking_cholesterol_interaction")


@register("interaction_features_numeric",
          f"SELECT age * blood_pressure / 100 AS age_bp_interaction, "
          f"bmi * cholesterol_level / 100 AS bmi_cholesterol_interaction FROM {P} AS p",
          operators="FE3")
def interaction_features_numeric(spark, sf):
    df = FE.create_interaction_features(view(spark, sf, "patients"), numeric_only=True)
    return df.select("age_bp_interaction", "bmi_cholesterol_interaction")


@register("lipid_and_scores",
          f"SELECT cholesterol_level * (1 + {_yn('low_hdl_cholesterol')}) * "
          f"(1 + {_yn('high_ldl_cholesterol')}) / 100 AS lipid_risk_factor, "
          f"age / 10 + cholesterol_level / 50 + blood_pressure / 20 + {_yn('smoking')} * 2 "
          f"AS framingham_score_est, "
          f"age / 10 + cholesterol_level / 60 + blood_pressure / 15 + {_yn('diabetes')} * 1.5 + "
          f"{_yn('smoking')} * 1.5 AS ascvd_score_est FROM {P} AS p",
          ["ascvd_score_est"], "FE4, FE5, FE6")
def lipid_and_scores(spark, sf):
    df = view(spark, sf, "patients")
    df = FE.ascvd_score(FE.framingham_score(FE.compute_lipid_ratio(df)))
    return df.select("lipid_risk_factor", "framingham_score_est", "ascvd_score_est")


def _poly_sql(names, interaction_only):
    combos = combinations if interaction_only else combinations_with_replacement
    out = []
    for a, b in combos(names, 2):
        label = f"{a}^2" if a == b else f"{a} {b}"
        out.append(f'{a} * {b} AS "{label}"')
    return out


@register("polynomial_features",
          "SELECT age, " + ", ".join(_poly_sql(NUM, False)) + f" FROM {P} AS p", operators="FE7")
def polynomial_features(spark, sf):
    df = view(spark, sf, "patients").select(*NUM)
    return FE.add_polynomial_features(df, NUM, 2).drop(*[c for c in NUM if c != "age"])


@register("polynomial_interactions",
          "SELECT p_partkey, p_size, p_retailprice, p_weight, "
          + ", ".join(_poly_sql(["p_partkey", "p_size", "p_retailprice", "p_weight"], True))
          + f" FROM {view_sql('part_n')} AS p", operators="FE8")
def polynomial_interactions(spark, sf):
    df = view(spark, sf, "part_n").select("p_partkey", "p_size", "p_retailprice", "p_weight")
    return FE.create_polynomial_features(df)


def _health_sql():
    terms = ["CAST(0.0 AS DOUBLE)"]
    for col, w, rule, operand in config.HEALTH_RISK_FACTORS:
        op = "=" if rule == "==" else rule
        rhs = f"'{operand}'" if isinstance(operand, str) else operand
        terms.append(f"CASE WHEN {col} {op} {rhs} THEN CAST({w} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END")
    return " + ".join(terms)


@register("health_risk_score", f"SELECT age, {_health_sql()} AS health_risk_score FROM {P} AS p",
          ["health_risk_score"], "FE9")
def health_risk_score(spark, sf):
    return FE.health_risk_score(view(spark, sf, "patients")).select("age", "health_risk_score")


def _risk_sql(c, high, mod):
    return f"(CASE WHEN {c} >= {high} THEN 2 WHEN {c} >= {mod} THEN 1 ELSE 0 END)"


_T = config.MEDICAL_RISK_THRESHOLDS
_med = {o: _risk_sql(r, *_T[r]) for r, o in config.MEDICAL_RISK_OUTPUTS.items()}


@register("medical_risk_score",
          "SELECT " + ", ".join(f"{e} AS {o}" for o, e in _med.items())
          + f", {_med['glucose_risk']} + {_yn('diabetes')} AS diabetes_combined_risk, "
          + " + ".join(f"CAST(coalesce({e}, 0) AS DOUBLE)" for e in
                       [_med["age_risk"], _med["bp_risk"], _med["cholesterol_risk"], _med["bmi_risk"],
                        f"({_med['glucose_risk']} + {_yn('diabetes')})"])
          + f" AS cv_risk_score FROM {P} AS p", operators="FE10")
def medical_risk_score(spark, sf):
    df = FE.medical_risk_score(view(spark, sf, "patients"))
    return df.select("age_risk", "bp_risk", "cholesterol_risk", "bmi_risk", "glucose_risk",
                     "diabetes_combined_risk", "cv_risk_score")


_life = config.LIFESTYLE_FACTORS
_medf = config.MEDICAL_FACTORS


@register("risk_clusters",
          "SELECT " + ", ".join(f"{_map_sql(c)} AS {c}_numeric" for c in _life + _medf)
          + ", " + " + ".join(f"coalesce({_map_sql(c)}, CAST(0 AS DOUBLE))" for c in _life)
          + " AS lifestyle_risk_score, "
          + " + ".join(f"coalesce({_map_sql(c)}, CAST(0 AS DOUBLE))" for c in _medf)
          + f" AS medical_risk_score, age * {_map_sql('family_heart_disease', None)} "
          f"AS age_family_history_risk FROM {P} AS p", operators="FE11")
def risk_clusters(spark, sf):
    df = FE.create_risk_clusters(view(spark, sf, "patients"))
    return df.select(*[f"{c}_numeric" for c in _life + _medf], "lifestyle_risk_score",
                     "medical_risk_score", "age_family_history_risk")


@register("risk_factor_count",
          "SELECT " + " + ".join(f"CAST(coalesce({_yn(c)}, 0) AS DOUBLE)" for c in config.RISK_FACTOR_FLAGS)
          + f" AS risk_factor_count FROM {P} AS p", operators="FE13")
def risk_factor_count(spark, sf):
    return FE.risk_factor_count(view(spark, sf, "patients")).select("risk_factor_count")
