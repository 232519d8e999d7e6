"""Quality classifier: learns, leaves the held-out fold alone, odd rows."""

import zlib

import numpy as np

from quarry.llm.common import read_table
from quarry.llm.quality_gbt import N_FEATURES, fit_trees, keep_quality, quality_scores, statistics, statistics_matrix

SF = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def walk(model, t, x):
    node = 0
    for _ in range(model.depth):
        node = 2 * node + 1 + int(x[model.feature[t, node]] > model.threshold[t, node])
    return model.value[t, node]


def test_flat_trees_walk_like_trees():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 6)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = fit_trees(x, y, trees=30, min_hessian=1.0)
    assert auc(model.score(x), y) > 0.98
    raw = model.raw(x[:20], rows=7)
    assert np.allclose(raw, [model.base + sum(walk(model, t, r) for t in range(30)) for r in x[:20]])


def test_one_class_and_no_rows():
    x = np.ones((5, N_FEATURES), np.float32)
    assert np.allclose(fit_trees(x, np.ones(5)).score(x), 0.999, atol=1e-3)
    assert np.allclose(fit_trees(x[:0], np.ones(0)).score(x), 0.5)
    assert (statistics(None) == statistics(b"")).all() and np.isfinite(statistics_matrix([b" ", b"\n\n", b"x" * 10_000])).all()


def test_held_out_accuracy(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    got = {r.id: r for r in quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    y = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [i for i in y if got[i].held_out]
    assert auc(np.array([got[i].score for i in held]), np.array([y[i] for i in held])) > 0.95
    assert np.mean([got[i].predicted == y[i] for i in held]) > 0.93
    # labels of the held-out fold make no difference
    flipped = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(cast(cast(doc_id AS string) AS binary)), 3) = 1 THEN 1 - quality ELSE quality END AS quality")
    assert {r.id: r.score for r in quality_scores(docs, flipped).collect()} == {i: r.score for i, r in got.items()}


def test_odd_rows(spark):
    rows = [(1, "good words here. " * 30, 0.0), (2, None, 1.0), (None, "", 2.0), (4, "x" * 200_000, 3.0), (4, "x" * 200_000, 3.0),
            *[(i, "%%% $$$ !! " * 20 if i % 2 else "plain words go on. " * 20, 4.0) for i in range(10, 60)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(10, 60)] + [(None, 1), (10, None), (999, 0)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in got if r.id and r.id >= 10 and r.id % 2 == 0} == {1}
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns and not any(r.doc_id and r.doc_id >= 10 and r.doc_id % 2 for r in kept.collect())
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(docs.limit(0), labels).count() == 0
