"""Encoders, scalers and deterministic splits (K1-K8).

Vocabularies are DataFrames (they grow with the data), numbered by the
distributed position helper and applied with a join that AQE broadcasts
only when the materialised vocabulary is small.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import group_positions


def fit_label_encoder(df: DataFrame, column: str) -> DataFrame:
    """K1 fit: sorted distinct values -> codes 0..n-1 (``value``, ``code``).
    NULL is its own category and sorts first."""
    vocab = df.select(F.col(column).alias("value")).distinct()
    coded = group_positions(vocab, [], [F.col("value").asc_nulls_first()], "code", None)
    return coded.select("value", F.col("code").cast("int").alias("code"))


def apply_label_encoder(df: DataFrame, column: str, vocab: DataFrame, out: str | None = None,
                        unseen: int = -1) -> DataFrame:
    """K2: encode with a fitted vocabulary; unseen values get ``unseen``."""
    out = out or f"{column}_code"
    from .joins import size_checked
    v = size_checked(vocab.select(F.col("value").alias("_v"), F.col("code").alias("_code")))
    j = df.join(v, df[column].eqNullSafe(v["_v"]), "left")
    return j.select(*[df[c] for c in df.columns], F.coalesce(F.col("_code"), F.lit(unseen)).alias(out))


def label_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    return apply_label_encoder(df, column, fit_label_encoder(df, column), out)


@dataclass
class ScalerParams:
    mean: dict[str, float]
    std: dict[str, float]


def fit_standard_scaler(df: DataFrame, columns: Sequence[str]) -> ScalerParams:
    """K4 fit: mean and *population* std (sklearn), zero std -> 1; one pass."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
                 *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns]).first()
    std = {}
    for c in columns:
        s = row[f"s_{c}"]
        std[c] = 1.0 if s is None or s == 0 else s
    return ScalerParams({c: row[f"m_{c}"] for c in columns}, std)


def apply_standard_scaler(df: DataFrame, p: ScalerParams) -> DataFrame:
    return df.select(*[((F.col(c) - F.lit(p.mean[c])) / F.lit(p.std[c])).alias(c) if c in p.mean else F.col(c)
                       for c in df.columns])


def stratified_positions(df: DataFrame, label: str, order: Column) -> DataFrame:
    """Position of each row within its class in a hash order (``_pos``, ``_n``)."""
    return group_positions(df, [label], [order], "_pos", "_n")


def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = 0.2,
                     out: str = "is_test") -> DataFrame:
    """K7: deterministic stratified hold-out; per class the first
    round(fraction * n_class) rows in md5(id) order are the test part."""
    order = F.md5(F.col(id_col).cast("string"))
    p = stratified_positions(df, label, order)
    return p.select(*df.columns, (F.col("_pos") < F.round(F.col("_n") * test_fraction)).cast("int").alias(out))


def fold_assign(df: DataFrame, label: str | None, id_col: str, k: int = 5, out: str = "fold") -> DataFrame:
    """K8: stratified (or plain, ``label=None``) k-fold ids: position mod k."""
    order = F.md5(F.col(id_col).cast("string"))
    p = group_positions(df, [label] if label else [], [order], "_pos", None)
    return p.select(*df.columns, (F.col("_pos") % k).cast("int").alias(out))
