"""Input views derived from the supplied tables.

The supplied tables hold no nulls and no Yes/No columns, so the views below
derive patient-like rows from them with plain SQL expressions (null
injection included).  The same expression strings feed Spark's
``selectExpr`` and the DuckDB oracle, so both sides see identical rows, and
each view grows with its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# patients: one row per lineitem row, columns of the reference's dataset.
PATIENT_EXPRS = [
    ("age", "CAST(20 + l_quantity AS DOUBLE)"),
    ("blood_pressure",
     "CASE WHEN l_orderkey % 50 = 7 THEN NULL ELSE CAST(90 + l_partkey % 91 AS DOUBLE) END"),
    ("cholesterol_level",
     "CASE WHEN l_partkey % 20 = 3 THEN NULL ELSE CAST(150 + l_orderkey % 151 AS DOUBLE) END"),
    ("bmi", "CASE WHEN l_suppkey % 9 = 4 THEN NULL ELSE 18 + l_discount * 200 END"),
    ("sleep_hours", "CASE WHEN l_orderkey % 4 = 1 THEN NULL ELSE 4 + l_tax * 60 END"),
    ("triglyceride_level", "CAST(100 + (l_partkey * 7) % 201 AS DOUBLE)"),
    ("fasting_blood_sugar", "CAST(70 + (l_orderkey * 3 + l_linenumber) % 91 AS DOUBLE)"),
    ("crp_level", "l_extendedprice / CAST(10000 AS DOUBLE)"),
    ("homocysteine_level", "CAST(5 + l_linenumber * 2 AS DOUBLE)"),
    ("gender", "CASE WHEN l_orderkey % 2 = 0 THEN 'Male' ELSE 'Female' END"),
    ("exercise_habits",
     "CASE WHEN l_orderkey % 40 = 11 THEN NULL WHEN l_partkey % 3 = 0 THEN 'Low' "
     "WHEN l_partkey % 3 = 1 THEN 'Medium' ELSE 'High' END"),
    ("smoking",
     "CASE WHEN l_partkey % 30 = 2 THEN NULL WHEN l_linestatus = 'O' THEN 'Yes' ELSE 'No' END"),
    ("family_heart_disease", "CASE WHEN l_suppkey % 3 = 0 THEN 'Yes' ELSE 'No' END"),
    ("diabetes", "CASE WHEN l_partkey % 5 = 0 THEN 'Yes' ELSE 'No' END"),
    ("high_blood_pressure", "CASE WHEN l_orderkey % 4 = 2 THEN 'Yes' ELSE 'No' END"),
    ("low_hdl_cholesterol", "CASE WHEN (l_orderkey + l_partkey) % 3 = 0 THEN 'Yes' ELSE 'No' END"),
    ("high_ldl_cholesterol", "CASE WHEN (l_partkey + l_suppkey) % 4 = 0 THEN 'Yes' ELSE 'No' END"),
    ("alcohol_consumption",
     "CASE WHEN l_suppkey % 4 = 0 THEN 'None' WHEN l_suppkey % 4 = 1 THEN 'Low' "
     "WHEN l_suppkey % 4 = 2 THEN 'Medium' ELSE 'High' END"),
    ("stress_level",
     "CASE WHEN l_orderkey % 3 = 0 THEN 'Low' WHEN l_orderkey % 3 = 1 THEN 'Medium' ELSE 'High' END"),
    ("sugar_consumption",
     "CASE WHEN l_partkey % 3 = 2 THEN 'Low' WHEN l_partkey % 3 = 0 THEN 'Medium' ELSE 'High' END"),
    ("heart_disease_status",
     "CASE WHEN (l_returnflag = 'R' AND l_quantity > 15) OR (l_quantity > 45 AND l_discount > 0.07) "
     "THEN 'Yes' ELSE 'No' END"),
]

# events with injected nulls; label = purchase (about 20% positive)
EVENT_EXPRS = [
    ("event_id", "event_id"),
    ("user_id", "user_id"),
    ("event_type", "CASE WHEN event_id % 17 = 5 THEN NULL ELSE event_type END"),
    ("value", "CASE WHEN event_id % 10 = 3 THEN NULL ELSE value END"),
    ("props", "CASE WHEN event_id % 23 = 7 THEN NULL ELSE props END"),
    ("label", "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END"),
]

# part with injected nulls and one derived numeric (for the imputers)
PART_EXPRS = [
    ("p_partkey", "p_partkey"),
    ("p_brand", "CASE WHEN p_partkey % 7 = 2 THEN NULL ELSE p_brand END"),
    ("p_type", "CASE WHEN p_partkey % 11 = 5 THEN NULL ELSE p_type END"),
    ("p_size", "CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END"),
    ("p_retailprice", "CASE WHEN p_partkey % 9 = 4 THEN NULL ELSE p_retailprice END"),
    ("p_weight",
     "CASE WHEN p_partkey % 4 = 1 THEN NULL ELSE CAST(p_size * 3 + p_partkey % 13 AS DOUBLE) END"),
]

# scored rows: label and several model scores (with ties) over lineitem
SCORED_EXPRS = [
    ("l_orderkey", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    ("l_linestatus", "l_linestatus"),
    ("qty_band",
     "CASE WHEN l_quantity < 10 THEN 'q<10' WHEN l_quantity < 30 THEN 'q10-30' ELSE 'q30+' END"),
    ("label", "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"),
    ("score_discount", "ROUND(l_discount * 10, 6)"),
    ("score_tax", "ROUND(l_tax * 10 + l_quantity / CAST(100 AS DOUBLE), 6)"),
    ("score_mix", "ROUND((l_quantity * 2 + l_linenumber) / CAST(110 AS DOUBLE), 6)"),
]

VIEWS = {
    "patients": ("lineitem", PATIENT_EXPRS),
    "events_n": ("events", EVENT_EXPRS),
    "part_n": ("part", PART_EXPRS),
    "scored": ("lineitem", SCORED_EXPRS),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, exprs = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS {n}" for n, e in exprs])


def view_sql(name: str) -> str:
    """The view as a DuckDB sub-select over the pre-registered tables."""
    source, exprs = VIEWS[name]
    return "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in exprs) + f" FROM {source})"
