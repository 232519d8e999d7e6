"""Model jobs use every core, fit shared feature stages once, and score folds once."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from quarry.operators import models as M
from quarry.operators.boosting import fit_boosted
from quarry.session import reliable_checkpoint, right_size


def _rows(spark, n=400):
    x = np.random.default_rng(1).normal(size=(n, 2))
    return spark.createDataFrame([(i, float(a), float(b), float(a + b > 0), i % 3) for i, (a, b) in enumerate(x)],
                                 "id long, a double, b double, label double, fold int").coalesce(1)


def test_one_row_group_is_dealt_to_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    df = reliable_checkpoint(spark.range(400, numPartitions=1).toDF("id"))
    out = right_size(df, rows_per_partition=1000, least_rows=50)
    assert out.rdd.getNumPartitions() == cores
    assert sorted(r.id for r in out.collect()) == list(range(400))
    assert right_size(df).rdd.getNumPartitions() == 1
    many = reliable_checkpoint(spark.range(400, numPartitions=100).toDF("id"))
    assert right_size(many, rows_per_partition=1, least_rows=400).rdd.getNumPartitions() == 16 * cores


def test_feature_stages_are_fitted_once_a_fold(spark, monkeypatch):
    df, fitted = _rows(spark), []
    whole = Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, *a: fitted.append(1) or whole(self, *a))
    stages = M.feature_stages([], ["a", "b"])
    models = {"l": M.classifier("logreg"), "s": M.classifier("svc")}
    by = M.cv_scores_by(spark, stages, models, df, k=3)
    assert len(fitted) == 3
    for name, model in models.items():
        want = [M.evaluator().evaluate(Pipeline(stages=[*stages, model]).fit(df.where(F.col("fold") != i)).transform(df.where(F.col("fold") == i))) for i in range(3)]
        assert [r.score for r in by[name].orderBy("fold").collect()] == want
    fitted.clear()
    out = M.regression_average(stages, df.select("a", "b", "label"), df.withColumnRenamed("id", "_row_id"), "label", [("linear", {"regParam": 0.1})] * 3)
    assert len(fitted) == 1 and out.count() == 400 and out.columns == ["_row_id", "p0", "p1", "p2", "log_prediction", "prediction"]


def test_boosting_deals_one_partition_to_the_cores(spark, monkeypatch):
    from quarry.operators import boosting
    seen, whole = [], boosting.reliable_checkpoint
    monkeypatch.setattr(boosting, "reliable_checkpoint", lambda df: seen.append(out := whole(df)) or out)
    monkeypatch.setattr(boosting, "_ROWS", 20)
    fit_boosted(_rows(spark), ["a", "b"], "label", trees=1, depth=1)
    assert seen[-1].count() == 20 and seen[-1].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_the_texts_are_read_once_for_a_split(spark, monkeypatch):
    from quarry.plans import catalog_ml as C
    reads = spark.sparkContext.accumulator(0)
    texts = spark.createDataFrame([(i, "en", "a", f"Text {i}\n", 7) for i in range(60)], "doc_id long, lang string, source string, text string, n_chars int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")

    def read(batches):
        for pdf in batches:
            reads.add(len(pdf))
            yield pdf
    tables = {"documents": texts.mapInPandas(read, texts.schema), "labels": labels}
    monkeypatch.setattr(C, "table", lambda spark, sf, name: tables[name])
    train, test = C._split_folds(spark, "")
    assert (train.count(), test.count(), reads.value) == (48, 12, 60)


def test_fits_keep_features_and_label_only(spark):
    df = _rows(spark)
    _, kept, other = M.fold_features(M.feature_stages([], ["a", "b"]), df, df)
    try:
        assert kept.columns == ["features", "label"] and kept.storageLevel.useMemory
        assert {"id", "features", "label"} <= set(other.columns)
    finally:
        kept.unpersist()


def test_folds_of_a_large_table_run_one_at_a_time(spark, monkeypatch):
    import threading
    cores, held, most, lock, whole = spark.sparkContext.defaultParallelism, [], [], threading.Lock(), M.fold_features

    class Kept:
        """A fold's training rows, counted until they are given back."""

        def __init__(self, df):
            self.df = df

        def __getattr__(self, name):
            return getattr(self.df, name)

        def unpersist(self):
            with lock:
                held.pop()
            return self.df.unpersist()

    def features(*args, **kw):
        prep, tr, *others = whole(*args, **kw)
        with lock:
            held.append(1)
            most.append((len(held), tr.storageLevel.useMemory))
        return prep, Kept(tr), *others

    df = reliable_checkpoint(_rows(spark, 60).repartition(4 * cores))
    monkeypatch.setattr(M, "fold_features", features)
    monkeypatch.setattr(M.LogisticRegression, "fit", lambda self, tr: _Majority())
    scores = M.cv_scores(spark, M.feature_stages([], ["a", "b"]), M.classifier("logreg"), df, k=3)
    assert scores.count() == 3 and most == [(1, False)] * 3
    assert M.folds_at_once(_rows(spark)) == 4 and M.folds_at_once(df.coalesce(2 * cores)) == 2


class _Majority:
    def transform(self, df):
        return df.withColumn("prediction", F.lit(1.0))


def test_tabular_job_fits_on_partitions_of_bounded_rows(spark, monkeypatch):
    from quarry.plans import tabular_job as J
    orders = spark.createDataFrame([(i, i % 7, "FOP"[i % 3], 100.0 + i, 1 + i % 5, i % 4 == 0) for i in range(400)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, p int, late boolean").coalesce(1)
    orders = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.concat(F.col("p"), F.lit("-URGENT")).alias("o_orderpriority"),
                           F.when(F.col("late"), F.lit("1999-05-01")).otherwise(F.lit("1998-03-01")).cast("timestamp_ntz").alias("o_orderdate"))
    customer = spark.createDataFrame([(i, "AB"[i % 2] + "UILDING", 900.0 * i) for i in range(7)], "c_custkey long, c_mktsegment string, c_acctbal double")
    seen, whole = [], M.cv_scores_by
    monkeypatch.setattr(J, "TASK_ROWS", 30, raising=False)
    monkeypatch.setattr(M, "cv_scores_by", lambda spark, stages, models, df, *a, **kw: seen.append(df) or whole(spark, stages, models, df, *a, **kw))
    out = J.run(spark, orders, customer, "1999-01-01", members=("logreg",), k=2).collect()
    assert sorted(r.o_orderkey for r in out) == list(range(0, 400, 4)) and {r.prediction for r in out} <= {0, 1}
    (train,) = seen
    assert train.count() == 300 and train.rdd.getNumPartitions() >= 300 / 30
