"""Edge and brute-force checks of the operators against pandas/numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.functions import columns as X
from quarry.operators import clean as C
from quarry.operators import quality as Q
from quarry.operators.encode import apply_label_encoder, fit_label_encoder
from quarry.operators.evaluate import roc_auc
from quarry.operators.knn import knn_impute_1d
from quarry.operators.quantiles import quantiles
from quarry.operators.ranking import group_positions, prefix_sums
from quarry.operators.windows import DuplicateEdges, fit_quantile_edges, rank_quantile_bins


def _skewed_frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c"], n))  # one group holds ~40%
    v = np.round(rng.normal(50, 20, n), 1)  # rounded: many ties
    v[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v, "w": rng.integers(0, 5, n).astype(float)})
    rows = [(r.g, None if math.isnan(r.v) else float(r.v), float(r.w)) for r in pdf.itertuples()]
    return spark.createDataFrame(rows, "g string, v double, w double"), pdf


def test_exact_quantiles_match_pandas_with_hot_group(spark):
    df, pdf = _skewed_frame(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["g"], r["column_name"], r["prob"]): r["value"]
           for r in quantiles(df, ["v", "w"], probs, ["g"]).collect()}
    for g, sub in pdf.groupby("g"):
        for col in ("v", "w"):
            for p in probs:
                want = sub[col].quantile(p)
                assert got[(g, col, p)] == pytest.approx(want, rel=1e-12, abs=1e-9)


def test_exact_quantiles_global_and_nan_only(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,), (2.0,)], "x double")
    r = {row["prob"]: row["value"] for row in quantiles(df, ["x"], [0.25, 0.5]).collect()}
    assert r[0.5] == 2.0 and r[0.25] == 1.5
    empty = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert quantiles(empty, ["x"], [0.5]).count() == 0


def test_group_positions_hot_group(spark):
    df, pdf = _skewed_frame(spark)
    df = df.withColumn("id", F.monotonically_increasing_id())
    got = group_positions(df, ["g"], [F.col("w"), F.col("id")]).toPandas()
    for g, sub in got.groupby("g"):
        s = sub.sort_values(["w", "id"])
        assert list(s["_pos"]) == list(range(len(s)))
        assert (s["_n"] == len(s)).all()


def test_prefix_sums(spark):
    pdf = pd.DataFrame({"k": np.arange(500) % 97, "id": np.arange(500), "x": np.arange(500) % 3})
    df = spark.createDataFrame(pdf)
    got = prefix_sums(df, ["k", "id"], ["x"]).toPandas().sort_values(["k", "id"])
    want = pdf.sort_values(["k", "id"])["x"].cumsum().values
    assert list(got["x_cum"]) == list(want)


def test_rank_quantile_bins_match_pandas_qcut(spark):
    for n in (7, 418, 891):
        rng = np.random.default_rng(n)
        x = np.round(rng.random(n) * 10, 0)  # heavy ties
        pdf = pd.DataFrame({"id": np.arange(n), "x": x})
        want = pd.qcut(pdf["x"].rank(method="first"), 4, labels=False).astype(int).values
        got = rank_quantile_bins(spark.createDataFrame(pdf), "x", 4, ["id"]).toPandas().sort_values("id")
        assert list(got["rank_bin"]) == list(want), n


def test_quantile_edges_duplicate_raise(spark):
    df = spark.createDataFrame([(1.0,)] * 10 + [(2.0,)], "x double")
    with pytest.raises(DuplicateEdges):
        fit_quantile_edges(df, "x", 4)


def test_categorize_all_labels_kept(spark):
    rules = {"low": {"rules": [{"lt": 100}]}, "medium": {"rules": [{"between": [100, 1000]}]},
             "high": {"rules": [{"between": [1000, 100000]}]}}
    df = spark.createDataFrame([(50.0,), (100.0,), (999.99,), (1000.0,), (100000.0,), (None,)], "a double")
    got = [r[0] for r in df.select(X.categorize("a", rules)).collect()]
    assert got == ["low", "medium", "medium", "high", None, None]


def test_fixed_bins_right_closed_and_clip_null(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.5,), (50.0,), (51.0,), (None,)], "x double")
    got = [r[0] for r in df.select(X.fixed_bins("x", [0, 10, 50], ["lo", "hi"])).collect()]
    assert got == [None, "lo", "hi", "hi", None, None]
    clipped = [r[0] for r in df.select(X.clip("x", 5, 20)).collect()]
    assert clipped == [5.0, 10.0, 10.5, 20.0, 20.0, None]


def test_value_map_null_key_and_default(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    got = [r[0] for r in df.select(X.value_map("k", {"a": 1}, 0)).collect()]
    assert got == [1, 0, 0]


def test_dedup_keys_deterministic_latest(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 9, "y"), (1, 9, "z"), (2, 1, "w")], "k int, ts int, v string")
    got = sorted(tuple(r) for r in C.dedup_keys(df, ["k"], ["ts"]).collect())
    assert got == [(1, 9, "z"), (2, 1, "w")]


def test_median_fill_keeps_int_type_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (None, float("nan")), (4, 3.0), (2, None)], "a int, b double")
    out = C.median_fill(df)
    assert dict(out.dtypes) == {"a": "int", "b": "double"}
    rows = out.collect()
    assert [r["a"] for r in rows] == [1, 2, 4, 2] and [r["b"] for r in rows] == [1.0, 2.0, 3.0, 2.0]


def test_group_median_fill_null_group_gets_global(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 10.0), (None, None), ("b", 20.0)], "g string, x double")
    got = {(r["g"], r["x"]) for r in C.group_median_fill(df, "x", ["g"]).collect()}
    assert ("a", 1.0) in got and (None, 10.0) in got


def test_label_encoder_unseen_and_null(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    vocab = fit_label_encoder(fit, "c")
    got = {r["c"]: r["c_code"] for r in
           apply_label_encoder(spark.createDataFrame([("a",), ("b",), ("q",), (None,)], "c string"), "c", vocab).collect()}
    assert got == {None: 0, "a": 1, "b": 2, "q": -1}


def test_knn_impute_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    n = 400
    x = np.round(rng.random(n) * 20, 0)  # many equal distances
    y = rng.integers(0, 50, n).astype(float)
    y[rng.random(n) < 0.15] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "y": y})
    df = spark.createDataFrame([(int(r.id), float(r.x), None if math.isnan(r.y) else float(r.y))
                                for r in pdf.itertuples()], "id long, x double, y double")
    got = knn_impute_1d(df, "y", "x", "id", k=5).toPandas().set_index("id")["y"]
    donors = pdf[~pdf.y.isna()]
    for r in pdf[pdf.y.isna()].itertuples():
        d = donors.assign(dist=(donors.x - r.x).abs()).sort_values(["dist", "id"]).head(5)
        assert got[r.id] == pytest.approx(d.y.mean())


def test_roc_auc_ties_half(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (1, 0.7), (0, 0.7)]
    df = spark.createDataFrame(rows, "y int, s double")
    # Mann-Whitney with ties counted one half.
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert roc_auc(df, "y", "s").first()[0] == pytest.approx(want)


def test_quality_score_formula(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, s string")
    r = Q.quality_summary(df).first()
    comp = (1.0 + round(1 - 1 / 3, 4)) / 2
    uniq = (round(2 / 3, 4) + round(1 / 3, 4)) / 2
    assert r["duplicate_rows"] == 1
    assert r["quality_score"] == round(comp * 40 + uniq * 20 + 18 + 20, 1)


def test_approx_quantiles_within_rank_error(spark):
    df = spark.range(20000).select((F.col("id") * 7 % 20000).cast("double").alias("x"))
    got = {r["prob"]: r["value"] for r in quantiles(df, ["x"], [0.1, 0.5, 0.9], method="approx").collect()}
    for p, v in got.items():  # accuracy 10000 -> rank error <= n / 10000
        assert abs(v - p * 19999) <= 20000 / 10000 + 1
