"""Aggregations (H1-H11): grouped stats, frequency tables, histograms,
box summaries, correlation, distinct listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number
from ..functions.types import numeric_columns
from .quantiles import quantile_table


def group_stats(df: DataFrame, by: Sequence[str], spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """H1: named aggregates, ``{out: (column, fn)}`` with fn in
    mean/avg/count/sum/min/max/std/median; partial aggregation is automatic."""
    fns = {"mean": F.avg, "avg": F.avg, "count": F.count, "sum": F.sum, "min": F.min, "max": F.max,
           "std": F.stddev_samp, "nunique": F.count_distinct, "median": F.median}
    return df.groupBy(*by).agg(*[fns[fn](F.col(c)).alias(out) for out, (c, fn) in spec.items()])


def value_counts(df: DataFrame, columns: Sequence[str] | str, count_col: str = "count") -> DataFrame:
    """H2/H3: frequency table over one or more columns."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))


def crosstab_wide(df: DataFrame, row: str, col: str, values: Sequence | None = None,
                  max_values: int = 1000) -> DataFrame:
    """H3 (pivot form): one row per ``row`` value, one count column per
    ``col`` value (0 when absent).  Without ``values`` the distinct column
    values are listed first and must stay within ``max_values``."""
    if values is None:
        distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
        vals = [r[0] for r in distinct.limit(max_values + 1).collect()]
        if len(vals) > max_values:
            raise ValueError(f"{col} has more than {max_values} values; pass values= explicitly")
        values = sorted(vals)
    return df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1))).na.fill(0, [str(v) for v in values])


def fit_range(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    x = number(column).cast("double")
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    return r["lo"], r["hi"]


def histogram(df: DataFrame, column: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """H4: equal-width histogram over [min, max] (the maximum falls in the
    last bin), optionally per class: ``by..., bin, bin_lo, bin_hi, count``."""
    lo, hi = fit_range(df, column)
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, count bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    x = F.col(column).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*by, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    return counted.select(*by, "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                          (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), "count")


def box_summary(df: DataFrame, column: str, by: Sequence[str], factor: float = 1.5,
                method: str = "exact") -> DataFrame:
    """H5: quartiles per group, 1.5*IQR whiskers (most extreme values inside
    the fences) and the outlier count.  Quartiles come from the skew-safe
    quantile operator; the fences are joined back (small per-group table)."""
    by = list(by)
    q = quantile_table(df, [column], [0.25, 0.5, 0.75], by, method, names=["q1", "median", "q3"]).drop("column_name")
    x = number(column)
    from .joins import size_checked_join
    j = size_checked_join(df.select(*by, column), q, by, "inner")
    lo_f = F.col("q1") - factor * (F.col("q3") - F.col("q1"))
    hi_f = F.col("q3") + factor * (F.col("q3") - F.col("q1"))
    return j.groupBy(*by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(x >= lo_f, x)).alias("whisker_lo"), F.max(F.when(x <= hi_f, x)).alias("whisker_hi"),
        F.count_if((x < lo_f) | (x > hi_f)).alias("outliers"))


def one_row_agg(df: DataFrame, exprs: Sequence, per_agg: int) -> DataFrame:
    """A one-row aggregate of many named expressions, split into chunks of
    ``per_agg`` so each aggregate stays under whole-stage codegen's field
    limit (``spark.sql.codegen.maxFields``; a correlation keeps 6 buffer
    fields).  Chunks are unioned and folded into one row (no join)."""
    chunks = [list(exprs[i:i + per_agg]) for i in range(0, len(exprs), per_agg)]
    if len(chunks) <= 1:
        return df.agg(*exprs)
    parts = [df.agg(*c) for c in chunks]
    names = [n for p in parts for n in p.columns]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    return u.agg(*[F.max(F.col(f"`{n}`")).alias(n) for n in names])


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None,
                      include_diagonal: bool = False) -> DataFrame:
    """H6: Pearson correlation of every column pair, pairwise-complete, long form ``col_a, col_b, corr``."""
    cols = list(columns or numeric_columns(df))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + (0 if include_diagonal else 1):]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    # NaN is made missing once; chunks stay inside whole-stage codegen, which
    # measured faster than one interpreted aggregate over a single scan.
    clean = df.select(*[number(c).cast("double").alias(c) for c in cols])
    one = one_row_agg(clean, [F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"{a}__{b}") for a, b in pairs], per_agg=14)
    cells = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"`{a}__{b}`").alias("corr"))
                      for a, b in pairs])
    return one.select(F.inline(cells))


def correlation_with(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                     top: int | None = 10) -> DataFrame:
    """H7: correlation of each column with ``target``, top by |corr| (ties by name)."""
    cols = [c for c in (columns or numeric_columns(df)) if c != target]
    clean = df.select(*[number(c).cast("double").alias(c) for c in [*cols, target]])
    one = one_row_agg(clean, [F.corr(F.col(f"`{c}`"), F.col(f"`{target}`")).alias(c) for c in cols], per_agg=14)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("corr")) for c in cols])
    out = one.select(F.inline(cells))
    if top is not None:
        out = out.orderBy(F.desc(F.abs("corr")), F.asc("column_name")).limit(top)
    return out


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values (NULL excluded)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
