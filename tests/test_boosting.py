"""Second-order boosting against a plain version, MLlib's trees and odd data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import models as M
from quarry.operators.boosting import fit_boosted


def table(spark, x, y):
    names = [f"f{j}" for j in range(x.shape[1])]
    rows = [(*[None if np.isnan(v) else float(v) for v in r], float(t)) for r, t in zip(x, y)]
    return names, spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", y double").repartition(3).cache()


def plain(x, y, loss, trees, depth, rate, l2, min_child):
    """Every threshold between distinct values, row by row."""
    share = y.mean()
    raw = np.full(len(y), np.log(share / (1 - share)) if loss == "logistic" else share)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw)) if loss == "logistic" else raw
        g, h = p - y, p * (1 - p) if loss == "logistic" else np.ones(len(y))

        def grow(rows, level):
            best = (1e-9, None)
            for j in range(x.shape[1]) if level < depth else ():
                v = x[rows, j]
                for cut in np.unique(v[~np.isnan(v)]):
                    for missing_right in (False, True) if np.isnan(v).any() else (False,):
                        right = np.where(np.isnan(v), missing_right, v > cut)
                        hl, hr = h[rows][~right].sum(), h[rows][right].sum()
                        if hl < min_child or hr < min_child:
                            continue
                        gl, gr = g[rows][~right].sum(), g[rows][right].sum()
                        gain = 0.5 * (gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - (gl + gr) ** 2 / (hl + hr + l2))
                        if gain > best[0] + 1e-12:
                            best = (gain, right)
            if best[1] is None:
                raw[rows] += -rate * g[rows].sum() / (h[rows].sum() + l2)
            else:
                grow(rows[~best[1]], level + 1)
                grow(rows[best[1]], level + 1)
        grow(np.arange(len(y)), 0)
    return 1 / (1 + np.exp(-raw)) if loss == "logistic" else raw


@pytest.mark.parametrize("loss", ["logistic", "squared"])
def test_same_trees_as_a_plain_version(spark, loss):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 8, size=(300, 3)).astype(float)
    x[rng.random(x.shape) < 0.1] = np.nan
    score = np.nan_to_num(x[:, 0], nan=6) - np.nan_to_num(x[:, 1], nan=0) + rng.normal(size=300)
    y = (score > 1).astype(float) if loss == "logistic" else score
    names, df = table(spark, x, y)
    options = {"trees": 5, "depth": 2, "rate": 0.3, "l2": 1.0, "min_child": 1.0}
    model = fit_boosted(df, names, "y", loss, keep_every=2, **options)
    want = plain(x, y, loss, **options)
    assert np.allclose(model.predict(x), want, atol=1e-9)
    got = df.select("y", model.column().alias("p")).toPandas()
    assert np.allclose(np.sort(got["p"]), np.sort(want), atol=1e-9)
    assert model.table(spark).count() == 5
    share = {r.feature: r.importance for r in model.importances(spark).collect()}
    assert abs(sum(share.values()) - 1) < 1e-9 and share["f2"] < min(share["f0"], share["f1"])


def test_held_out_error_is_not_above_mllib(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(2000, 4))
    clean = np.sin(2 * x[:, 0]) + x[:, 1] * x[:, 2]
    y = clean + rng.normal(size=2000) * 0.3
    names, df = table(spark, x, y)
    df = df.withColumn("c", (F.col("y") > 0.2).cast("double")).withColumn("test", F.pmod(F.xxhash64("f0"), F.lit(4)) == 0)
    train, test = df.where("NOT test"), df.where("test")
    stages = M.feature_stages([], names, scale=False)
    ours = test.select(F.pow(fit_boosted(train, names, "y", "squared", trees=25).column() - F.col("y"), 2).alias("e")).agg(F.avg("e")).first()[0]
    theirs = M.fit_pipeline(stages, M.regressor("gbt", "y"), train).transform(test).agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]
    assert ours <= theirs * 1.02
    hit = test.select(((fit_boosted(train, names, "c", trees=25).column() > 0.5) == (F.col("c") > 0.5)).cast("int").alias("hit")).agg(F.avg("hit")).first()[0]
    fit = M.fit_pipeline(stages, M.classifier("gbt", "c"), train).transform(test)
    assert hit >= fit.agg(F.avg((F.col("prediction") == F.col("c")).cast("int"))).first()[0] - 0.015


def test_degenerate_tables(spark):
    names, df = table(spark, np.array([[1.0, np.nan], [2.0, np.nan]]), np.array([1.0, 1.0]))
    assert np.allclose(fit_boosted(df, names, "y", trees=2).predict(np.array([[1.0, 2.0]])), 1, atol=1e-3)
    assert fit_boosted(df.limit(0), names, "y", trees=2).predict(np.array([[1.0, 2.0]])) == [0.5]
    assert np.allclose(fit_boosted(df.withColumn("y", F.lit(7)), names, "y", "squared", trees=2).predict(np.zeros((1, 2))), 7)
    null = df.withColumn("y", F.when(F.col("f0") > 1, F.col("y")))
    assert len(fit_boosted(null, names, "y", "squared", trees=1).value) == 1
    with pytest.raises(ValueError):
        fit_boosted(df, names, "y", "other")
