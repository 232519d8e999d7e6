"""Exact quantiles against numpy: ties, small and hot groups, missing values, and the plan."""

import numpy as np
import pytest

from quarry.operators.quantiles import fit_quantiles, quantiles


def expected(values, p):
    v = np.sort(np.array([x for x in values if x is not None and not np.isnan(x)], float))
    pos = p * (len(v) - 1)
    a, b = v[int(np.floor(pos))], v[int(np.ceil(pos))]
    return a if a == b else a + (b - a) * (pos - np.floor(pos))


@pytest.mark.parametrize("accuracy", [10000, 20])
def test_groups_ties_and_missing(spark, accuracy):
    rng = np.random.default_rng(3)
    rows = []
    for g, n in (("hot", 4000), ("tied", 900), ("two", 2), ("one", 1), (None, 37), ("none", 5)):
        for i in range(n):
            x = {"tied": float(rng.integers(0, 3)), "none": None}.get(g, float(rng.normal()) if g != "none" else None)
            x = float("nan") if g == "hot" and i % 50 == 0 else x
            rows.append((g, x, int(rng.integers(-5, 5)) if i % 7 else None))
    df = spark.createDataFrame(rows, "g string, x double, y int")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.column_name, r.prob): r.value for r in quantiles(df, ["x", "y"], probs, ["g"], accuracy=accuracy).collect()}
    for g in ("hot", "tied", "two", "one", None, "none"):
        for i, c in ((1, "x"), (2, "y")):
            values = [r[i] for r in rows if r[0] == g and r[i] is not None and not np.isnan(r[i])]
            for p in probs:
                assert got.get((g, c, p)) == (pytest.approx(expected(values, p)) if values else None), (g, c, p)
    whole = fit_quantiles(df, ["x", "y"], probs)
    assert whole["x"] == {p: pytest.approx(expected([r[1] for r in rows], p)) for p in probs}


def test_infinite_values_and_odd_names(spark):
    df = spark.createDataFrame([(float("-inf"),), (float("-inf"),), (1.0,), (float("inf"),)], "`a b` double").withColumnRenamed("a b", "_i")
    assert fit_quantiles(df, ["_i"], [0.0, 1 / 3, 1.0])["_i"] == {0.0: float("-inf"), 1 / 3: float("-inf"), 1.0: float("inf")}
    assert fit_quantiles(df.limit(0), ["_i"], [0.5])["_i"] == {}
