"""Whitening against numpy on all rows, copies, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm.common import read_table
from quarry.llm.whitening import whitened_rows

SF = "/root/testdata/sf0.01"


def plain(rows, components=8):
    """Every row by itself, in numpy; integers exact."""
    kept = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    s = [sum(x[j] for _, x in kept) for j in range(d)]
    deviation = [sum((n * x[j] - s[j]) ** 2 for j in range(d)) for _, x in kept]
    c = np.array([[(n * x[j] - s[j]) / n for j in range(d)] for _, x in kept])
    cov = c.T @ c / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return kept, n, deviation, c @ v / np.sqrt(e), e / np.trace(cov)


def same(got, rows, components=8):
    kept, n, deviation, z, share = plain(rows, components)
    by = {}
    for r in got:
        by.setdefault(r.id, {}).setdefault(r.component, []).append(r)
    assert sum(len(v) for c in by.values() for v in c.values()) == len(kept) * len(share)
    sign = {}
    for (i, _), dev, row in zip(kept, deviation, z):
        assert sorted(by[i]) == list(range(1, len(share) + 1))
        for k, r in ((k, x) for k, x in by[i].items()):
            r = r[0]
            assert r.deviation == dev and r.n == n and r.identity_error < 1e-9 and math.isclose(r.explained, share[k - 1], rel_tol=1e-9)
            sign.setdefault(k, np.sign(r.whitened * row[k - 1]) or 1)
            assert abs(sign[k] * r.whitened - row[k - 1]) < 1e-6


def test_all_rows_of_a_table(spark):
    table = read_table(spark, SF, "embeddings")
    same(whitened_rows(table).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_copies_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 5)) * [5, 4, 3, 2, 1]
    rows = [(i, base[i % 300 if i < 700 else 7].round(3).tolist(), 1.0, 2) for i in range(1200)]  # a vector holds almost half
    odd = [(5000, None, 1.0, 0), (5001, [], 1.0, 0), (5002, [1.0, None, 2.0, 3.0, 4.0], 1.0, 0), (5003, [float("nan")] * 5, 1.0, 0),
           (5004, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1.0, 0), (5005, [1e300, 0.0, 0.0, 0.0, 0.0], 1.0, 0), (5006, [1.0, 2.0], 1.0, 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, whitened double, n int")
    got = whitened_rows(table).collect()
    same(got, [r[:2] for r in rows])
    assert {r.component for r in got} == {1, 2, 3, 4, 5}
    once = whitened_rows(table, weights="one").collect()
    assert {r.n for r in once} == {300} and {(r.id, r.component) for r in once} == {(r.id, r.component) for r in got}
    assert once[0].identity_error < 1e-9
    with pytest.raises(ValueError):
        whitened_rows(table, weights="none")


@pytest.mark.parametrize("n, step", [(40, 3e9), (3000, 7e11)])
def test_exact_deviation_of_large_entries(spark, n, step):
    table = spark.createDataFrame([(i, [float(i % 7) * step, float(i)]) for i in range(n)], "vec_id long, embedding array<double>")
    got = whitened_rows(table).collect()
    kept, n, deviation, *_ = plain([(r.vec_id, r.embedding) for r in table.collect()])
    want = {i: v if v < 2 ** 63 else None for (i, _), v in zip(kept, deviation)}
    assert None in want.values() and {r.id: r.deviation for r in got} == want


def test_degenerate_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitened_rows(spark.createDataFrame([], schema)).count() == 0
    assert whitened_rows(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).count() == 0  # no variance at all
    flat = spark.createDataFrame([(i, [float(i), 1.0, 2.0 * i]) for i in range(10)], schema)  # of rank 1
    got = whitened_rows(flat).collect()
    assert {r.component for r in got} == {1} and len(got) == 10 and abs(got[0].explained - 1) < 1e-9
    null_id = flat.withColumn("vec_id", F.when(F.col("vec_id") > 3, F.col("vec_id")))
    assert whitened_rows(null_id).count() == 10
