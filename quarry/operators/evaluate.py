"""Ensembling and evaluation metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import prefix_sums


def soft_vote(probs: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    """Weighted mean probability (equal weights by default)."""
    w = list(weights) if weights is not None else [1.0] * len(probs)
    total = sum(w)
    acc = None
    for p, wi in zip(probs, w):
        term = p * F.lit(wi / total)
        acc = term if acc is None else acc + term
    return acc


def hard_vote(preds: Sequence[Column]) -> Column:
    """Majority of 0/1 votes; a tie goes to the smaller label (0)."""
    s = None
    for p in preds:
        s = p if s is None else s + p
    return (s * 2 > len(preds)).cast("int")


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """K19."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, label: str, pred: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Counts on the full label x prediction grid (zeros included)."""
    cells = [(a, b) for a in classes for b in classes]
    one = df.agg(*[F.count_if((F.col(label) == a) & (F.col(pred) == b)).alias(f"c_{a}_{b}") for a, b in cells])
    arr = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"),
                             F.col(f"c_{a}_{b}").alias("n")) for a, b in cells])
    return one.select(F.inline(arr))


def _score_table(df: DataFrame, label: str, score: str) -> DataFrame:
    # One row per distinct score; repeated scores combine map-side.
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC AUC, ties count one half (Mann-Whitney).

    AUC = sum_s pos(s) * (neg(< s) + neg(s) / 2) / (P * N); the running
    negative count comes from distributed prefix sums over distinct scores.
    """
    t = _score_table(df, label, score)
    c = prefix_sums(t, ["score"], ["neg"], suffix="_below", inclusive=False)
    return c.agg((F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
                  / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score threshold, descending: ``threshold,
    tpr, fpr`` (cumulative counts of rows scoring >= threshold)."""
    t = _score_table(df, label, score)
    tot = t.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()  # two fitted scalars
    c = prefix_sums(t, [F.col("score").desc()], ["pos", "neg"], suffix="_cum", inclusive=True)
    return c.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("pos_cum"), F.lit(tot["P"])).alias("tpr"),
                    F.try_divide(F.col("neg_cum"), F.lit(tot["N"])).alias("fpr"))


def rmse(df: DataFrame, label: str, pred: str) -> DataFrame:
    """RMSE and RMSLE, from one aggregate."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    return df.agg(F.sqrt(F.avg(F.pow(p - y, 2))).alias("rmse"),
                  F.sqrt(F.avg(F.pow(F.log1p(p) - F.log1p(y), 2))).alias("rmsle"))
