"""Kernel machine by random Fourier features."""

import numpy as np
from pyspark.ml import PipelineModel

from quarry.operators import models as M


def test_features_approach_the_kernel():
    x = np.random.default_rng(3).normal(size=(40, 5))
    z = M.fourier(x, 20_000, 0.3, 7)
    kernel = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - kernel).max() < 0.05
    assert (M.fourier(x[5:9], 64, 0.0, 1) == M.fourier(x, 64, 0.2, 1)[5:9]).all()  # any batch, default width


def test_ring_beyond_a_line(spark, tmpdir_path):
    xy = np.random.default_rng(5).uniform(-1, 1, size=(1500, 2))
    rows = [(i, float(a), float(b), float(a * a + b * b < 0.6)) for i, (a, b) in enumerate(xy)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label double").repartition(3).cache()
    train, test = df.where("id < 1000"), df.where("id >= 1000")
    score = {}
    for kind in ("svc", "rbf_svc"):
        model = M.fit_pipeline(M.feature_stages([], ["a", "b"]), M.classifier(kind), train)
        score[kind] = M.evaluator().evaluate(model.transform(test))
    assert score["rbf_svc"] > 0.93 and score["svc"] < 0.7
    path = tmpdir_path + "/model"
    model.write().save(path)
    again = PipelineModel.load(path).transform(test).select("id", "prediction").collect()
    assert sorted(again) == sorted(model.transform(test).select("id", "prediction").collect())
    assert model.transform(test.limit(0)).count() == 0


def test_fit_keeps_no_features_and_comes_near_mllib(spark):
    """The machine's loss is that of MLlib's on the same features, whose 2 KB a row it never writes."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC
    xy = np.random.default_rng(6).uniform(-1, 1, size=(600, 2))
    df = spark.createDataFrame([(float(a), float(b), float(a * a + b * b < 0.6)) for a, b in xy], "a double, b double, label double").repartition(2)
    df = M.fit_pipeline(M.feature_stages([], ["a", "b"]), M.FourierFeatures(size=64), df).transform(df).cache()
    machine = M.classifier("rbf_svc", size=64, regParam=0.01)
    assert not isinstance(machine, Pipeline)
    ours = machine.fit(df.drop("rawPrediction", "prediction")).transform(df)
    theirs = LinearSVC(featuresCol="fourier", maxIter=100, regParam=0.01).fit(df).transform(df)
    hinge = [np.mean([max(0, 1 - (2 * r.label - 1) * r.rawPrediction[1]) for r in out.select("label", "rawPrediction").collect()]) for out in (ours, theirs)]
    assert abs(hinge[0] - hinge[1]) < 0.02
    same = ours.select("a", "b", "prediction").join(theirs.select("a", "b", "prediction"), ["a", "b", "prediction"]).count()
    assert same >= 590
