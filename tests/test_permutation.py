"""Permutation importance: recall needs the rows of class 1, the shuffle all rows."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskloom.operators.models import permutation_importance


class FirstSlot:
    """Predicts class 1 where the first slot is above 0.5 and keeps the number of rows it scored."""

    def transform(self, df):
        self.rows = df.count()
        return df.withColumn("prediction", (vector_to_array("features")[0] > 0.5).cast("double"))


def rows(spark, labels):
    data = [(y, [float(i % 3), float(i)]) for i, y in enumerate(labels)]
    return spark.createDataFrame(data, "label double, x array<double>").select("label", array_to_vector(F.col("x")).alias("features"))


def test_only_rows_of_class_one_are_scored(spark):
    model = FirstSlot()
    labels = [1.0, 0.0, None, 0.0, 1.0, 1.0, 0.0, 1.0, None, 0.0, 0.0, 1.0]
    got = {r.feature: r.importance for r in permutation_importance(model, rows(spark, labels), ["a", "b"]).collect()}
    assert model.rows == labels.count(1.0) * 3
    assert got["b"] == 0.0
    # four of the five rows of class 1 are above 0.5; their donors come from all rows
    found = (0.8 - got["a"]) * 5
    assert abs(found - round(found)) < 1e-9 and 0 <= round(found) <= 5


def test_without_class_one_all_is_zero(spark):
    got = [tuple(r) for r in permutation_importance(FirstSlot(), rows(spark, [0.0, None, 0.0]), ["a", "b"]).collect()]
    assert sorted(got) == [("a", 0.0), ("b", 0.0)]


def test_no_rows_give_no_rows(spark):
    assert permutation_importance(FirstSlot(), rows(spark, [0.0]).limit(0), ["a", "b"]).collect() == []
