"""Multi-feature imputation by boxes: same values as all pairs, fewer pairs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators import knn


def table(spark, n, seed, clusters=0, patterns=()):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    if clusters:
        x = (x * 0.05 + rng.uniform(-20, 20, size=(clusters, 4))[rng.integers(0, clusters, n)]).round(3)
    for where, cols in patterns:
        x[np.ix_(rng.random(n) < where, cols)] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(id=np.arange(n), note="kept")
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    return x, spark.createDataFrame(rows, "a double, b double, c double, d double, id long, note string")


def brute(x, k):
    out, means = x.copy(), np.nanmean(x, axis=0)
    for i in range(len(x)):
        gap = (x - x[i]) ** 2
        shared = (~np.isnan(gap)).sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            d = np.sqrt(x.shape[1] / shared * np.nansum(gap, axis=1))
        d[shared == 0] = np.inf
        for c in np.flatnonzero(np.isnan(x[i])):
            ok = np.flatnonzero(~np.isnan(x[:, c]) & np.isfinite(d))
            best = ok[np.lexsort((ok, d[ok]))][:k]
            out[i, c] = x[best, c].mean() if len(best) else means[c]
    return out


PATTERNS = [(0.1, [0]), (0.1, [1, 2]), (0.05, [3]), (0.01, [0, 1, 2, 3])]


@pytest.mark.parametrize("clusters, block, few", [(0, 40, False), (12, 25, False), (12, 25, True)])
def test_same_as_all_pairs(spark, monkeypatch, clusters, block, few):
    if few:  # rare sets of known columns share loose boxes; boxes are cut into slices
        monkeypatch.setattr(knn, "_PATTERNS", 3)
        monkeypatch.setattr(knn, "_BOXES", 8)
    x, df = table(spark, 700, 5, clusters, PATTERNS)
    got = knn.knn_impute(df, list("abcd"), "id", 4, block_rows=block).orderBy("id").toPandas()
    assert np.allclose(got[list("abcd")].to_numpy(float), brute(x, 4), atol=1e-9) and set(got["note"]) == {"kept"}


def test_far_boxes_are_not_sent(spark):
    x, df = table(spark, 3000, 6, 30, [(0.1, [0]), (0.1, [3])])
    left, right = knn.donor_visits(df, list("abcd"), "id", 5, block_rows=25)
    receivers = int(np.isnan(x).any(axis=1).sum())
    met = left.groupBy("_p", "_b", "_s").count().withColumnRenamed("count", "l").join(
        right.groupBy("_p", "_b", "_s").count().withColumnRenamed("count", "r"), ["_p", "_b", "_s"]).selectExpr("sum(l * r)").first()[0]
    assert met < 0.25 * receivers * 3000
    assert right.count() < 0.6 * 3000 * left.select("_p").distinct().count()  # not every box to every part


def test_few_rows(spark):
    schema = "a double, b double, id long"
    assert knn.knn_impute(spark.createDataFrame([], schema), ["a", "b"], "id").count() == 0
    df = spark.createDataFrame([(1.0, None, 1), (None, None, 2), (float("nan"), 4.0, 3)], schema)
    got = {r.id: (r.a, r.b) for r in knn.knn_impute(df, ["a", "b"], "id").collect()}
    assert got == {1: (1.0, 4.0), 2: (1.0, 4.0), 3: (1.0, 4.0)}
    whole = spark.createDataFrame([(1.0, 2.0, 1)], schema)
    assert knn.knn_impute(whole, ["a", "b"], "id").first() == (1.0, 2.0, 1)


def test_tasks_and_visits_do_not_grow_with_the_rows(spark, monkeypatch):
    """Rows that repeat compress well: a task must not get more of them for that."""
    monkeypatch.setattr(knn, "_TASK_ROWS", 5000, raising=False)
    x, df = table(spark, 1000, 7, 0, [(0.1, [0]), (0.1, [3])])
    many = df.crossJoin(spark.range(6).toDF("copy")).withColumn("id", F.col("id") + 1000 * F.col("copy")).drop("copy")
    left, right = knn.donor_visits(many, list("abcd"), "id", 5, block_rows=25)
    most = [max(rows.groupBy(F.spark_partition_id()).count().toPandas()["count"]) for rows in (left, right)]
    assert right.count() > 20_000 and max(most) <= 10_000
    # bounds come from donors, not only from the corners of their boxes
    assert left.count() < 0.25 * left.select("_id").distinct().count() * right.select("_b").distinct().count()
    got = knn.knn_impute(many, list("abcd"), "id", 4, block_rows=25).orderBy("id").toPandas()
    assert np.allclose(got[list("abcd")].to_numpy(float), brute(np.concatenate([x] * 6), 4), atol=1e-9)
