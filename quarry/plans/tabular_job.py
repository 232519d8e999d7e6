"""End-to-end tabular classification job, the shape of the model scripts:
train and test tagged in one table -> features -> fills -> encoding ->
cross-validated members -> weighted soft vote -> prediction table.

Every step is an operator from this package; fitting is MLlib.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import models as M
from ..operators.clean import group_median_fill
from ..operators.encode import apply_label_encoder, fit_label_encoder, fold_assign
from ..operators.evaluate import soft_vote
from ..operators.joins import union_tagged
from ..operators.windows import fit_quantile_edges, group_count, quantile_bins
from ..session import reliable_checkpoint, right_size


def build_features(both: DataFrame, id_col: str, label: str) -> DataFrame:
    """Order-level features from orders joined with customers."""
    df = group_count(both, ["o_custkey"], "o_custkey", out="cust_orders")  # G2/I1
    df = df.withColumn("price_per_order", X.safe_divide("o_totalprice", "cust_orders"))  # F19
    df = df.withColumn("priority_code", X.value_map("o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2}, 0))  # F10
    df = df.withColumn("segment_initial", X.regex_extract("c_mktsegment", r"^([A-Z])"))  # F9
    df = df.withColumn("rich", X.flag(F.col("c_acctbal") > 5000))  # F20
    df = df.withColumn("acct_bin", X.fixed_bins("c_acctbal", [-1000, 0, 2500, 5000, 7500, 10000]))  # F18
    df = df.withColumn("order_month", F.month("o_orderdate"))
    df = group_median_fill(df, "c_acctbal", ["c_mktsegment"])  # E9
    edges = fit_quantile_edges(df.where(F.col("src") == "train"), "o_totalprice", 4)  # I4 fitted on train
    df = quantile_bins(df, "o_totalprice", 4, out="price_band", edges=edges)
    vocab = fit_label_encoder(df.select("c_mktsegment"), "c_mktsegment")  # K3: shared vocabulary
    return apply_label_encoder(df, "c_mktsegment", vocab, "segment_code")


NUMERIC = ["o_totalprice", "cust_orders", "price_per_order", "priority_code", "rich", "acct_bin",
           "order_month", "c_acctbal", "price_band", "segment_code"]
#: Training rows of a partition at most, on average.
TASK_ROWS = 200_000


def run(spark: SparkSession, orders: DataFrame, customer: DataFrame, cutoff: str,
        members: Sequence[str] = ("logreg", "rf"), k: int = 5) -> DataFrame:
    """Train on orders before ``cutoff``, predict later ones: ``o_orderkey,
    prediction, prob``.  Member weights are their CV accuracies (K15)."""
    o = orders.join(customer.select("c_custkey", "c_mktsegment", "c_acctbal"),
                    orders.o_custkey == customer.c_custkey, "left").drop("c_custkey")
    o = o.withColumn("label", (F.col("o_orderstatus") == "F").cast("double"))
    ts = F.lit(cutoff).cast("timestamp_ntz")
    both = union_tagged({"train": o.where(F.col("o_orderdate") < ts),
                         "test": o.where(F.col("o_orderdate") >= ts).drop("label")})  # J5
    feats = build_features(both, "o_orderkey", "label")
    feats = reliable_checkpoint(feats.select("o_orderkey", "src", "label", *NUMERIC))
    # the folds' shuffle goes by bytes; the fits need partitions of bounded rows
    train = right_size(fold_assign(feats.where(F.col("src") == "train"), "label", "o_orderkey", k), most_rows=TASK_ROWS)  # K8
    test = feats.where(F.col("src") == "test")
    stages = M.feature_stages([], [c for c in NUMERIC])
    models = {kind: M.classifier(kind, numTrees=30) for kind in members}
    scores = M.cv_scores_by(spark, stages, models, train, k=k)  # K9
    weights, probs = [], None
    for kind, est in models.items():
        weights.append(M.cv_summary(scores[kind]).first()["cv_mean"])
        fitted = M.fit_pipeline(stages, est, train)
        p = M.positive_probability(fitted.transform(test), kind).select("o_orderkey", kind)
        probs = p if probs is None else probs.join(p, "o_orderkey")
    prob = soft_vote([F.col(m) for m in members], weights)
    return probs.select("o_orderkey", (prob > 0.5).cast("int").alias("prediction"), prob.alias("prob"))
