"""Our pipeline stages saved and loaded again."""

from pyspark.ml import Pipeline, PipelineModel

from riskloom.operators.encode import ExactImputer, PopulationScaler
from riskloom.operators.features import HealthRiskScore, MedicalRiskScore
from riskloom.operators.models import MajorityClassifier, SkLogisticRegression


def test_fitted_stages_come_back(spark, tmp_path):
    df = spark.createDataFrame([(50.0, 1.0, "a", 0), (None, 3.0, None, 0), (61.0, None, "a", 1), (70.0, 8.0, "b", 0)],
                               "age double, x double, s string, label int")
    pipe = Pipeline(stages=[ExactImputer(inputCols=["age", "x"]), ExactImputer(inputCols=["s"], strategy="most_frequent"),
                            HealthRiskScore(cols={"bmi": "x"}, outputCol="score_"), MedicalRiskScore(cols={"bmi": "x"}),
                            PopulationScaler(inputCols=["x"], outputCols=["z"]), MajorityClassifier(labelCol="label")])
    model = pipe.fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    back = PipelineModel.load(str(tmp_path / "model"))
    key = lambda r: str(r)
    assert sorted(back.transform(df).collect(), key=key) == sorted(model.transform(df).collect(), key=key)
    assert back.stages[0].values == {"age": 61.0, "x": 3.0} and back.stages[-1].majority == 0
    pipe.write().overwrite().save(str(tmp_path / "pipe"))
    again = Pipeline.load(str(tmp_path / "pipe")).fit(df)
    assert sorted(again.transform(df).collect(), key=key) == sorted(model.transform(df).collect(), key=key)


def test_an_estimator_keeps_its_parameters(spark, tmp_path):
    SkLogisticRegression(C=0.5, penalty="l1", classWeight="none").write().overwrite().save(str(tmp_path / "lr"))
    back = SkLogisticRegression.load(str(tmp_path / "lr"))
    assert (back.getOrDefault("C"), back.getOrDefault("penalty"), back.getOrDefault("classWeight")) == (0.5, "l1", "none")
