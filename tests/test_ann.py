"""Inverted-file search: recall against the exact way, blocks, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import ann
from quarry.operators.neighbors import knn_classify


def table(spark, x, labels=None):
    rows = [(i, [float(c) for c in v], int(labels[i]) if labels is not None else 0) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(x, asked, k):
    x = x.astype(np.float32).astype(float)
    d = np.sqrt(((x[asked][:, None] - x[None]) ** 2).sum(2))
    d[np.arange(len(asked)), asked] = np.inf
    return {int(q): [int(i) for i in np.lexsort((np.arange(len(x)), row))[:k]] for q, row in zip(asked, d)}


@pytest.mark.parametrize("shape", ["isotropic", "clusters"])
def test_recall_and_exact_way(spark, shape):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16))
    if shape == "clusters":
        x = x * 0.1 + rng.normal(size=(30, 16))[rng.integers(0, 30, 3000)]
    df = table(spark, x)
    queries = df.where("vec_id % 100 = 0")
    want = brute(x, np.arange(0, 3000, 100), 10)
    exact = ann.exact_search(queries, df, "vec_id", "embedding", 10, block_rows=700, query_rows=11)
    got = {}
    for r in exact.orderBy("rank").collect():
        got.setdefault(r.query, []).append(r.id)
    assert got == want
    q = ann.fit_quantiser(df, "vec_id", "embedding", k=10, sample_rows=2000)
    found = ann.search(queries, df, "vec_id", "embedding", q, 10, block_rows=90, query_rows=7).collect()
    assert len(found) == 300 and all(r.query != r.id for r in found)
    hits = sum(r.id in want[r.query] for r in found)
    assert hits >= 270
    if shape == "clusters":
        assert q.probes < len(q.centres) / 2 and q.finalists_per_row < 0.6
    assert ann.recall(ann.search(queries, df, "vec_id", "embedding", q, 10), exact).first()["recall"] >= 0.9


def test_frequent_vectors_null_vectors_and_few_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8))
    x[:250] = x[0]
    df = table(spark, x).withColumn("embedding", F.when(F.col("vec_id") != 599, F.col("embedding")))
    q = ann.fit_quantiser(df, "vec_id", "embedding", k=5)
    got = ann.search(df.where("vec_id IN (0, 7, 300, 599)"), df, "vec_id", "embedding", q, 5, block_rows=40).orderBy("query", "rank").collect()
    assert [r.id for r in got if r.query == 0] == [1, 2, 3, 4, 5] and [r.id for r in got if r.query == 7] == [0, 1, 2, 3, 4]
    assert {r.query for r in got} == {0, 7, 300}
    assert ann.build_index(df, "vec_id", "embedding", q).count() == 599
    for n in (0, 1, 3):
        few = table(spark, x[300:300 + n])
        q = ann.fit_quantiser(few, "vec_id", "embedding", k=5)
        assert ann.search(few, few, "vec_id", "embedding", q, 5).count() == n * max(0, n - 1)


def test_classes_agree_with_the_exact_classifier(spark):
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 5, 800)
    x = rng.normal(size=(800, 8)) * 0.3 + np.eye(5, 8)[labels] * 2
    df = table(spark, x, labels)
    near = {r.vec_id: r.pred for r in ann.ann_classify(df, "vec_id", "embedding", "label", 7).collect()}
    exact = {r.vec_id: r.pred for r in knn_classify(df, "vec_id", "embedding", "label", 7, tile_rows=50).collect()}
    assert len(near) == 800 and np.mean([near[i] == exact[i] for i in near]) > 0.98
