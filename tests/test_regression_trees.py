"""Boosted regression trees on packed rows: MLlib's trees, fewer bytes and tasks."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from quarry.operators import models as M
from quarry.operators import regression_trees as T


def _rows(spark, n, parts=3):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 3))
    x[:, 1] = rng.integers(0, 60, n)  # more values than bins, zeros among them
    x[:, 2] = rng.integers(0, 4, n)
    y = np.sin(x[:, 0]) + 0.05 * x[:, 1] + rng.normal(size=n) * 0.1
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double").repartition(parts).persist()
    return M.feature_stages([], ["a", "b", "c"], scale=False)[0].transform(df).select("features", "y")


@pytest.mark.parametrize("n, params", [(600, {"maxIter": 7, "maxDepth": 3, "subsamplingRate": 0.8}), (11_500, {"maxIter": 3, "maxDepth": 4, "subsamplingRate": 0.8}),
                                       (300, {"maxIter": 2, "maxDepth": 7, "subsamplingRate": 1.0})])
def test_the_trees_are_those_of_mllib(spark, n, params, monkeypatch):
    monkeypatch.setattr(T, "_BLOCK", 128)
    rows = _rows(spark, n)
    ours = M.regressor("gbt", "y", **params).setPredictionCol("p").fit(rows)
    theirs = GBTRegressor(labelCol="y", predictionCol="q", seed=42, stepSize=0.1, **params).fit(rows)
    far = theirs.transform(ours.transform(rows)).agg(F.count(F.lit(1)), F.max(F.abs(F.col("p") - F.col("q")))).first()
    assert far[0] == n and far[1] < 1e-9


def test_a_pass_starts_few_tasks_over_packed_rows(spark, monkeypatch):
    held, whole, few = [], T.reliable_checkpoint, []
    monkeypatch.setattr(T, "reliable_checkpoint", lambda df: held.append(out := whole(df)) or out)
    coalesce = type(spark.range(0)).coalesce
    monkeypatch.setattr(type(spark.range(0)), "coalesce", lambda self, n: few.append(n) or coalesce(self, n))
    seen, sums = [], T._histograms
    monkeypatch.setattr(T, "_histograms", lambda *a: seen.append(a) or sums(*a))
    M.regressor("gbt", "y", maxIter=2, maxDepth=2).fit(_rows(spark, 2000, parts=40))
    assert [len(r.codes) // 3 for r in held[0].collect()] == [len(r.residual) // 8 for r in held[0].collect()]
    assert held[0].count() == 40 and len(seen) == 4  # a block a partition; a pass a level
    assert few == [2 * spark.sparkContext.defaultParallelism]
    assert sum(len(c) + len(r) + len(d) for c, r, d in held[0].collect()) == 2000 * (3 + 8 + 8)


def test_odd_input(spark, tmpdir_path):
    rows = _rows(spark, 50)
    flat = M.regressor("gbt", "y", maxIter=2).fit(rows.withColumn("y", F.lit(7.0)))
    assert flat.setPredictionCol("p").transform(rows).where("abs(p - 7) > 1e-9").count() == 0
    flat.save(tmpdir_path + "/model")
    assert T.PackedGBTModel.load(tmpdir_path + "/model").transform(rows).where("abs(p - 7) > 1e-9").count() == 0
    for name, odd in (("y", F.lit(None).cast("double")), ("features", M.array_to_vector(F.array(*[F.lit(float("nan"))] * 3)))):
        with pytest.raises(Exception, match="must be numbers"):
            M.regressor("gbt", "y", maxIter=1).fit(rows.withColumn(name, odd))
    with pytest.raises(ValueError):
        M.regressor("gbt", "y", maxIter=1).fit(rows.limit(0))


def test_kept_columns_stay_beside_the_predictions(spark):
    df = spark.createDataFrame([(i, float(i), 2.0 * i) for i in range(20)], "_row_id long, a double, y double")
    out = M.regression_average(M.feature_stages([], ["a"]), df.select("a", "y"), df, "y", [("linear", {"regParam": 0.1}), ("gbt", {"maxIter": 2})], keep=("y",))
    assert out.columns == ["_row_id", "y", "p0", "p1", "log_prediction", "prediction"]
    assert [r.y for r in out.orderBy("_row_id").collect()] == [2.0 * i for i in range(20)]
