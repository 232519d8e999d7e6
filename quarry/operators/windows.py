"""Group-broadcast columns and rank/quantile binning.

Group-broadcast columns (pandas ``groupby().transform``) are computed as
an aggregate joined back on the key rather than a window: the aggregate is
combined map-side and the join lets AQE broadcast a small result or split a
skewed key, whereas a window sends a hot group to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fixed_bins
from .quantiles import fit_quantiles
from .ranking import group_positions


def group_broadcast(df: DataFrame, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Attach per-group aggregates to every row (NULL keys get NULL)."""
    from .joins import size_checked_join
    by = list(by)
    stats = df.groupBy(*by).agg(*aggs)
    return size_checked_join(df, stats, by, "left")


def group_count(df: DataFrame, by: Sequence[str], column: str | None = None,
                out: str = "group_size") -> DataFrame:
    """Non-null count per group on every row, plus ``<out>_alone`` flag."""
    cnt = F.count(F.col(column)) if column else F.count(F.lit(1))
    j = group_broadcast(df, by, [cnt.alias(out)])
    return j.withColumn(f"{out}_alone", (F.coalesce(F.col(out), F.lit(0)) <= 1).cast("int"))


def loo_target_rate(labelled: DataFrame, unlabelled: DataFrame | None, by: Sequence[str],
                    target: str, default: float = 0.5, out: str = "loo_rate",
                    count_out: str = "group_count") -> DataFrame:
    """Leave-one-out target rate.

    Labelled rows: n > 1 ? (sum - y) / (n - 1) : default, clipped to [0, 1].
    Unlabelled rows: the labelled group's mean, else ``default``; their
    count is the labelled group size, else 1.
    """
    by = list(by)
    from .joins import size_checked
    stats = size_checked(labelled.groupBy(*by).agg(F.count(F.col(target)).alias("_n"),
                                                   F.sum(F.col(target).cast("double")).alias("_s")))
    lab = labelled.join(stats, by, "left")
    y = F.col(target).cast("double")
    rate = F.when(F.col("_n") > 1, (F.col("_s") - y) / (F.col("_n") - 1)).otherwise(F.lit(default))
    rate = F.least(F.greatest(rate, F.lit(0.0)), F.lit(1.0))
    lab = lab.select(*labelled.columns, rate.alias(out), F.col("_n").alias(count_out)).drop("_s")
    if unlabelled is None:
        return lab
    un = unlabelled.join(stats, by, "left")
    un = un.select(*unlabelled.columns,
                   F.coalesce(F.col("_s") / F.col("_n"), F.lit(default)).alias(out),
                   F.coalesce(F.col("_n"), F.lit(1)).cast("bigint").alias(count_out))
    return lab.unionByName(un, allowMissingColumns=True)


def rank_quantile_bins(df: DataFrame, column: str, q: int, tie_break: Sequence[str],
                       out: str = "rank_bin") -> DataFrame:
    """Pandas ``qcut(x.rank(method='first'), q)`` codes.

    Rank r (1-based, ties by ``tie_break``) of n rows falls in bin
    ``max(ceil((r-1)*q/(n-1)), 1) - 1`` (integer arithmetic).  Ranks come
    from the distributed position helper, not a global window.
    """
    pos = group_positions(df, [], [F.col(column).asc_nulls_last(), *tie_break], "_r0", "_rn")
    r1 = F.col("_r0")  # r - 1
    n1 = F.col("_rn") - 1
    ceil_div = F.when(n1 > 0, F.floor((r1 * q + n1 - 1) / n1)).otherwise(F.lit(0))
    code = (F.greatest(ceil_div, F.lit(1)) - 1).cast("int")
    return pos.select(*df.columns, F.when(F.col(column).isNotNull(), code).alias(out))


class DuplicateEdges(ValueError):
    pass


def fit_quantile_edges(df: DataFrame, column: str, q: int, method: str = "exact") -> list[float]:
    """I4 fit: q+1 linear-interpolated edges; duplicate edges are an error."""
    probs = [i / q for i in range(q + 1)]
    vals = fit_quantiles(df, [column], probs, method)[column]
    edges = [vals[p] for p in probs]
    if len(set(edges)) != len(edges):
        raise DuplicateEdges(f"Bin edges must be unique: {edges}")
    return edges


def quantile_bins(df: DataFrame, column: str, q: int, labels: Sequence | None = None,
                  out: str = "quantile_bin", edges: Sequence[float] | None = None) -> DataFrame:
    """I4 apply: right-closed bins on the fitted edges, first bin includes the minimum."""
    e = list(edges) if edges is not None else fit_quantile_edges(df, column, q)
    return df.withColumn(out, fixed_bins(column, e, labels, include_lowest=True))
