"""Defaults and rule sets.

Column names are snake_case versions of the reference dataset's display
names (``Blood Pressure`` -> ``blood_pressure``).  Operators never hard-code these names: they take them as arguments
with the values below as defaults, so every operator runs on any table.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for equal results.
# (names, thresholds, weights, bins, labels, grids, constants)
# ---------------------------------------------------------------------------

TARGET = "heart_disease_status"

CATEGORICAL_FEATURES = [
    "gender", "exercise_habits", "smoking", "family_heart_disease",
    "diabetes", "high_blood_pressure", "low_hdl_cholesterol",
    "high_ldl_cholesterol", "alcohol_consumption", "stress_level",
    "sugar_consumption",
]
NUMERICAL_FEATURES = [
    "age", "blood_pressure", "cholesterol_level", "bmi", "sleep_hours",
    "triglyceride_level", "fasting_blood_sugar", "crp_level",
    "homocysteine_level",
]

RANDOM_STATE = 42
CV_FOLDS = 5
TEST_SIZE = 0.2

# Yes/No target and flag encoding
YES, NO = "Yes", "No"

# Ordinal map used by the risk clusters (unknown strings -> 0)
BINARY_MAP = {"Yes": 1.0, "No": 0.0, "High": 1.0, "Medium": 0.5, "Low": 0.0, "None": 0.0}

# Health risk score: (column, weight, rule, operand); rule is ">" , "<" or "=="
HEALTH_RISK_FACTORS = [
    ("age", 0.05, ">", 50),
    ("blood_pressure", 0.1, ">", 140),
    ("cholesterol_level", 0.1, ">", 200),
    ("bmi", 0.1, ">", 25),
    ("smoking", 0.15, "==", "Yes"),
    ("family_heart_disease", 0.15, "==", "Yes"),
    ("diabetes", 0.15, "==", "Yes"),
    ("high_blood_pressure", 0.1, "==", "Yes"),
    ("sleep_hours", 0.05, "<", 7),
    ("stress_level", 0.05, "==", "High"),
]

# Medical risk score: column -> (high, moderate); score 2 if >= high, 1 if >= moderate
MEDICAL_RISK_THRESHOLDS = {
    "age": (65, 45),
    "blood_pressure": (140, 120),
    "cholesterol_level": (240, 200),
    "bmi": (30, 25),
    "triglyceride_level": (200, 150),  # defined, never used by the score
    "fasting_blood_sugar": (126, 100),
}
MEDICAL_RISK_OUTPUTS = {
    "age": "age_risk",
    "blood_pressure": "bp_risk",
    "cholesterol_level": "cholesterol_risk",
    "bmi": "bmi_risk",
    "fasting_blood_sugar": "glucose_risk",
}

LIFESTYLE_FACTORS = ["smoking", "alcohol_consumption", "exercise_habits", "stress_level"]
MEDICAL_FACTORS = ["high_blood_pressure", "high_ldl_cholesterol", "low_hdl_cholesterol", "diabetes"]

# Notebook risk-factor count
RISK_FACTOR_FLAGS = ["smoking", "high_blood_pressure", "diabetes", "family_heart_disease"]

# Age bands [lo, hi) and their labels "lo-hi"
AGE_BANDS = [(0, 40), (40, 60), (60, 100)]
# Notebook age groups, half-open [lo, hi)
NOTEBOOK_AGE_BINS = [0, 30, 40, 50, 60, 70, 100]
NOTEBOOK_AGE_LABELS = ["<30", "30-40", "40-50", "50-60", "60-70", "70+"]
# Logistic risk levels, (lo, hi]
RISK_LEVEL_BINS = [0, 0.2, 0.4, 0.6, 0.8, 1.0]
RISK_LEVEL_LABELS = ["Very Low", "Low", "Moderate", "High", "Very High"]

# Evaluation
F_BETA = 2.0
SCORING = ["recall", "precision", "f1", "roc_auc", "average_precision"]
THRESHOLD_MIN_PRECISION_CONSTRAINTS = [0.21, 0.25, 0.3, 0.35, 0.4, 0.45, 0.6]
FAIRNESS_SLICES = ["age_band", "gender", "diabetes"]
VOTING_WEIGHTS = {"Logistic Regression": 0.2, "Random Forest": 0.4, "XGBoost": 0.4}

# Models
LOGISTIC_REGRESSION_PARAMS = {"C": 1.0, "penalty": "l2", "class_weight": "balanced", "max_iter": 1000}
LOGISTIC_REGRESSION_GRID = {
    "C": [0.01, 0.1, 1.0, 10.0, 100.0],
    "penalty": ["l1", "l2"],
    "solver": ["liblinear", "saga"],
    "class_weight": ["balanced", {0: 1, 1: 5}, {0: 1, 1: 10}],
}
RANDOM_FOREST_PARAMS = {"n_estimators": 300, "max_depth": None, "min_samples_split": 2,
                        "min_samples_leaf": 2, "bootstrap": True, "class_weight": "balanced"}
RANDOM_FOREST_GRID = {"max_depth": [10, 50, None], "min_samples_leaf": [2, 4]}
XGBOOST_PARAMS = {"learning_rate": 0.1, "max_depth": 5, "min_child_weight": 1, "gamma": 0,
                  "subsample": 0.8, "colsample_bytree": 0.8, "scale_pos_weight": 1}
XGBOOST_GRID = {
    "learning_rate": [0.01, 0.05, 0.1, 0.3],
    "max_depth": [3, 5, 7, 9],
    "min_child_weight": [1, 3, 5],
    "scale_pos_weight": [1, 4, 5],
}

# Library random searches (20 draws from these spaces)
RANDOM_SEARCH_DRAWS = 20
RF_SEARCH_SPACE = {
    "n_estimators": [100, 200, 300],
    "max_depth": [None, 10, 20, 30],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "bootstrap": [True, False],
    "criterion": ["gini", "entropy"],
}
XGB_SEARCH_SPACE = {
    "n_estimators": [100, 200, 300],
    "max_depth": [3, 5, 7, 9],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "min_child_weight": [1, 3, 5],
    "gamma": [0, 0.1, 0.2],
    "subsample": [0.6, 0.8, 1.0],
    "colsample_bytree": [0.6, 0.8, 1.0],
}
GB_SEARCH_SPACE = {
    "n_estimators": [100, 200, 300],
    "max_depth": [3, 5, 7],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "subsample": [0.6, 0.8, 1.0],
    "max_features": ["sqrt", "log2", None],
}
LR_TUNE_C = [0.001, 0.01, 0.1, 1, 10, 100]

# ---------------------------------------------------------------------------
# Our own defaults (not from the reference)
# ---------------------------------------------------------------------------

# Spark's limit of a tree's depth; stands for "unlimited" and for anything deeper in single fits.
MAX_TREE_DEPTH = 30
# Depth without a limit, in searches.
UNLIMITED_DEPTH = 2**31 - 1
# Rows per bucket in the two-level rank / running-sum plans.
ROWS_PER_BUCKET = 1 << 20
# Rows beyond which model rows are prepared, and forests grown, in the ways that are made for many rows.
LARGE_ROWS = 1 << 17
# Rows per file of a table whose readers should be of even size.
ROWS_PER_FILE = 1 << 17
