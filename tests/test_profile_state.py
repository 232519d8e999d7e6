"""Mergeable profiles: error bounds, new files only, odd columns."""

import os

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import profile_state as PS


def test_estimates_are_within_their_bounds(spark, tmpdir_path):
    rng = np.random.default_rng(11)
    n = 40_000
    x = rng.lognormal(size=n)
    df = spark.createDataFrame([(i, float(v) if i % 10 else None, f"t{i % 3000}", int(v * 3)) for i, v in enumerate(x)], "id long, x double, t string, k int")
    folder = tmpdir_path + "/in"
    df.repartition(16, "id").write.parquet(folder)
    state = PS.ProfileState(tmpdir_path + "/state")
    assert state.refresh(spark, folder) == 16
    got = {r.column_name: r for r in state.profile(spark).collect()}
    known = np.sort(x[np.arange(n) % 10 > 0])
    for name, exact in (("id", n), ("x", len(known)), ("t", 3000), ("k", len(set((x * 3).astype(int)))), (PS.ROW, n)):
        assert abs(got[name].distinct - exact) <= PS.DISTINCT_ERROR * exact + 0.5
    for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        assert abs(np.searchsorted(known, got["x"][q]) / len(known) - p) <= PS.RANK_ERROR
    r = got["x"]
    assert (r.rows, r.nulls) == (n, n // 10) and (r.min, r.max) == (known[0], known[-1])
    assert np.isclose(r["mean"], known.mean()) and np.isclose(r["std"], known.std(ddof=1))
    q1, q3 = np.quantile(known, [0.25, 0.75])
    outside = ((known < q1 - 1.5 * (q3 - q1)) | (known > q3 + 1.5 * (q3 - q1))).sum()
    assert abs(r.outliers - outside) <= 3 * PS.RANK_ERROR * len(known)
    assert got["t"].median is None and got["t"].outliers is None and list(got)[:2] == ["id", "x"] and list(got)[-1] == PS.ROW


def test_a_second_run_reads_new_files_only(spark, tmpdir_path):
    folder, state = tmpdir_path + "/in", PS.ProfileState(tmpdir_path + "/state")
    spark.range(100).coalesce(2).write.parquet(folder)
    assert state.refresh(spark, folder) == 2 and state.refresh(spark, folder) == 0
    for name in os.listdir(folder):  # what was profiled may be unreadable now; its time and length are the same
        if name.startswith("part-"):
            path, times = f"{folder}/{name}", os.stat(f"{folder}/{name}")
            with open(path, "r+b") as f:
                f.write(b"\0" * times.st_size)
            os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
    spark.range(1000, 1005).withColumn("more", F.lit("x")).coalesce(1).write.mode("append").parquet(folder)
    assert state.refresh(spark, folder) == 1
    got = {r.column_name: r for r in state.profile(spark).collect()}
    assert (got["id"].rows, got["id"].min, got["id"].max) == (105, 0, 1004)
    assert (got["more"].rows, got["more"].nulls, got["more"].distinct) == (105, 100, 1)  # older files lack it
    assert sorted(r.rows for r in state.by_file(spark).where("column_name = 'id'").collect()) == [5, 50, 50]


def test_merging_is_the_same_as_one_file(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("k"), F.when(F.col("id") % 2 == 0, float("nan")).otherwise(F.col("id") * 1.0).alias("v"),
                                  F.array("id").alias("a"), F.lit(None).cast("double").alias("none"))
    one, many = (PS.merged_profile(PS.file_profiles(df, by)).collect() for by in (F.lit("f"), F.concat(F.lit("f"), F.col("k") % 7)))
    for a, b in zip(one, many):
        assert a.column_name == b.column_name and (a.rows, a.nulls, a["min"], a["max"]) == (b.rows, b.nulls, b["min"], b["max"])
        assert abs(a.distinct - b.distinct) <= PS.DISTINCT_ERROR * a.distinct
    by = {r.column_name: r for r in one}
    assert by["v"].nulls == 2500 and by["none"].nulls == 5000 and by["none"].median is None and by["none"].distinct == 0
    empty = PS.merged_profile(PS.file_profiles(df.limit(0), F.lit("f"))).collect()
    assert empty == []
