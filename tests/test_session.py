"""Observed job counters must not break MLlib in the caller's session."""

from conftest import SF


def test_observation_then_mllib_same_session(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from quarry.plans import registry
    assert registry.queries()["load_stats"](spark, SF).first()["runs"] == 2  # registers an Observation
    df = spark.createDataFrame([(0.1, 0.0), (0.9, 1.0), (0.8, 1.0), (0.3, 0.0)], "rawPrediction double, label double")
    assert BinaryClassificationEvaluator().evaluate(df) == 1.0
