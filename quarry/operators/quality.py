"""Profiling and data-quality metrics (one scan per metric family).

The reference scans once per column for nulls and once per column for
medians; here each family is a single aggregate over all columns, and
results come back as small DataFrames in long form.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import number
from ..functions.types import is_fractional, numeric_columns, string_columns
from .quantiles import fit_quantiles


def missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for float/double columns."""
    dt = df.schema[c].dataType
    cond = F.col(c).isNull()
    if is_fractional(dt):
        cond = cond | F.isnan(F.col(c))
    return cond


def _long(one_row: DataFrame, cols: Sequence[str], name: str, value_type: str) -> DataFrame:
    """Turn a one-row aggregate with one field per column into (column, name)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast(value_type).alias(name))
                      for c in cols])
    return one_row.select(F.inline(cells))


def profile_rows(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("int").alias("columns"))


def dtypes(df: DataFrame) -> list[tuple[str, str]]:
    return list(df.dtypes)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)`` for every column, NULL or NaN, in one pass."""
    cols = list(columns or df.columns)
    one = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in cols])
    return _long(one, cols, "nulls", "bigint")


def null_ranking(df: DataFrame, top: int = 20) -> DataFrame:
    """D3: the ``top`` columns with most missing values (ties by name)."""
    return null_counts(df).orderBy(F.desc("nulls"), F.asc("column_name")).limit(top)


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None,
                    approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct non-null values per (string) column.

    Exact mode aggregates each column by itself (a hot value is combined
    map-side); approx uses HyperLogLog++.
    """
    cols = list(columns or string_columns(df))
    if approx:
        return _long(df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols]), cols, "distinct", "bigint")
    return _distinct_per_column(df, cols).withColumnRenamed("_d", "distinct")


def _distinct_per_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, _d)``: exact distinct non-missing values, one small
    aggregate per column.  Each reads its own column only, repeated values
    combine map-side, and no row is expanded once per column."""
    out = None
    for c in cols:
        values = df.where(~missing(df, c)).select(F.col(f"`{c}`").alias("v")).distinct()
        one = values.agg(F.count(F.lit(1)).alias("_d")).select(F.lit(c).alias("column_name"), "_d")
        out = one if out is None else out.unionByName(one)
    return out


def numeric_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, min, max, mean, std, nulls)``; sample std; all-missing -> NULL."""
    cols = list(columns or numeric_columns(df))
    aggs = []
    for c in cols:
        v = F.when(~missing(df, c), F.col(c).cast("double"))
        aggs += [F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max"),
                 F.avg(v).alias(f"{c}__mean"), F.stddev_samp(v).alias(f"{c}__std"),
                 F.count_if(missing(df, c)).alias(f"{c}__nulls")]
    from .aggregates import one_row_agg
    one = one_row_agg(df, aggs, per_agg=5 * 8)  # ~8 buffer fields per column
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(f"`{c}__min`").alias("min"), F.col(f"`{c}__max`").alias("max"),
                               F.col(f"`{c}__mean`").alias("mean"), F.col(f"`{c}__std`").alias("std"),
                               F.col(f"`{c}__nulls`").alias("nulls")) for c in cols])
    return one.select(F.inline(cells))


def ten_thousandths(part: Column, whole: Column) -> Column:
    """``part / whole`` in ten-thousandths, rounded to the nearest; ties go up.

    Integer arithmetic on the counts, so that the result depends neither on
    how the quotient is stored in binary nor on its decimal text (exact up
    to 4e14 rows).  NULL where ``whole`` is 0."""
    part, whole = part.cast("bigint"), whole.cast("bigint")
    return F.call_function("div", part * 20_000 + whole, F.nullif(whole * 2, F.lit(0)))


def _share(part: Column, whole: Column) -> Column:
    """The rounded share as a double with four decimals."""
    return ten_thousandths(part, whole) / F.lit(10_000.0)


def completeness(df: DataFrame) -> DataFrame:
    """``(column, completeness)``: share of present values, four decimals,
    ties up (:func:`ten_thousandths`)."""
    cols = df.columns
    n = F.count(F.lit(1))
    one = df.agg(*[_share(n - F.count_if(missing(df, c)), n).alias(c) for c in cols])
    return _long(one, cols, "completeness", "double")


def uniqueness(df: DataFrame, approx: bool = False) -> DataFrame:
    """``(column, uniqueness)``: distinct non-missing values over rows, four
    decimals, ties up (:func:`ten_thousandths`); 1.0 if empty."""
    cols = df.columns
    if approx:
        n = F.count(F.lit(1))
        aggs = [F.coalesce(_share(F.approx_count_distinct(F.when(~missing(df, c), F.col(c))), n), F.lit(1.0)).alias(c)
                for c in cols]
        return _long(df.agg(*aggs), cols, "uniqueness", "double")
    share = F.coalesce(_share(F.col("_d"), F.lit(df.count())), F.lit(1.0))
    return _distinct_per_column(df, cols).select("column_name", share.alias("uniqueness"))


@dataclass
class IqrBounds:
    column: str
    q1: float
    q3: float
    lower: float
    upper: float


def fit_iqr(df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5,
            method: str = "exact") -> list[IqrBounds]:
    cols = list(columns or numeric_columns(df))
    qs = fit_quantiles(df, cols, [0.25, 0.75], method)
    out = []
    for c in cols:
        if 0.25 not in qs[c]:
            continue
        q1, q3 = qs[c][0.25], qs[c][0.75]
        iqr = q3 - q1
        out.append(IqrBounds(c, q1, q3, q1 - factor * iqr, q3 + factor * iqr))
    return out


def _outside(b: IqrBounds) -> Column:
    x = number(b.column)  # NaN is missing, not an outlier
    return (x < F.lit(b.lower)) | (x > F.lit(b.upper))


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5,
                 method: str = "exact") -> DataFrame:
    """``(column, outliers)`` for numeric columns with at least one value
    strictly outside [q1 - f*iqr, q3 + f*iqr]; two passes (quantiles, count)."""
    bounds = fit_iqr(df, columns, factor, method)
    spark = df.sparkSession
    if not bounds:
        return spark.createDataFrame([], "column_name string, outliers bigint")
    one = df.agg(*[F.count_if(_outside(b)).alias(b.column) for b in bounds])
    return _long(one, [b.column for b in bounds], "outliers", "bigint").where("outliers > 0")


def _wide(t: T.DataType) -> bool:
    return isinstance(t, (T.StringType, T.BinaryType, T.ArrayType, T.StructType))


def duplicate_groups(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Equal-row groups with their multiplicity ``_n`` (NULLs compare equal),
    with the columns ``by``.

    A hot duplicate value is combined map-side before the shuffle.  Texts,
    arrays and structs do not travel: where a table has any, a row's key is
    four 64-bit hashes of all its columns, taken with four seeds (which
    columns are NULL is hashed, too); the chance that any two of 1e12
    different rows meet in all 256 bits is below 1e-50."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    if not any(_wide(f.dataType) for f in df.schema):
        return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    null_at = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    key = [F.xxhash64(F.lit(seed), null_at, *cols).alias(f"_k{seed}") for seed in range(4)]
    return df.select(*by, *key).groupBy(*by, *[f"_k{i}" for i in range(4)]).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows after the first of each equal group."""
    return duplicate_groups(df).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def quality_score_expr(completeness_parts: Column, uniqueness_parts: Column, n_columns: int,
                       duplicates: Column, outliers_total: Column) -> Column:
    """40*completeness + 20*uniqueness + duplicate part + outlier part,
    one decimal, ties up.

    The first two are means over the columns, given as sums of
    ten-thousandths, so the rounding works on integers."""
    dup_part = F.greatest(F.lit(0).cast("bigint"), F.lit(20).cast("bigint") - duplicates * 2)
    out_part = F.greatest(F.lit(0).cast("bigint"), F.lit(20).cast("bigint") - outliers_total)
    means = F.call_function("div", completeness_parts * 8 + uniqueness_parts * 4 + F.lit(100 * n_columns),
                            F.lit(200 * n_columns))
    return (means + (dup_part + out_part) * 10) / F.lit(10.0)


def _completeness_at(i: int) -> Column:
    return ten_thousandths(F.col("_rows") - F.col(f"_m{i}"), F.col("_rows"))


def _uniqueness_at(i: int) -> Column:
    return F.coalesce(ten_thousandths(F.col(f"_d{i}"), F.col("_rows")), F.lit(10_000))


def _means(n_columns: int) -> tuple[Column, Column, Column, Column]:
    """Sums of the columns' completeness and uniqueness, and both means."""
    comp = sum((_completeness_at(i) for i in range(n_columns)), F.lit(0))
    uniq = sum((_uniqueness_at(i) for i in range(n_columns)), F.lit(0))
    return comp, uniq, comp / F.lit(10_000.0 * n_columns), uniq / F.lit(10_000.0 * n_columns)


def _measured(df: DataFrame, method: str) -> tuple[DataFrame, list[IqrBounds]]:
    """One row of every count the summary and the report need, and the fences.

    After the quartile fit: one aggregate over the rows (missing counts,
    numeric statistics, outliers), one over the equal-row groups, and one
    per column for its distinct values, folded into one row."""
    cols, num = df.columns, set(numeric_columns(df))
    bounds = fit_iqr(df, method=method) if cols else []
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        miss = missing(df, c)
        aggs.append(F.count_if(miss).alias(f"_m{i}"))
        if c in num:
            v = F.when(~miss, F.col(c).cast("double"))
            aggs += [F.min(v).alias(f"_min{i}"), F.max(v).alias(f"_max{i}"),
                     F.avg(v).alias(f"_mean{i}"), F.stddev_samp(v).alias(f"_std{i}")]
    aggs += [F.count_if(_outside(b)).alias(f"_o{j}") for j, b in enumerate(bounds)]
    parts = [df.agg(*aggs), duplicate_rows(df).withColumnRenamed("duplicate_rows", "dups")]
    for i, c in enumerate(cols):
        if method == "approx":
            aggs_c = df.agg(F.approx_count_distinct(F.when(~missing(df, c), F.col(c))).alias(f"_d{i}"))
        else:
            aggs_c = _distinct_per_column(df, [c]).select(F.col("_d").alias(f"_d{i}"))
        parts.append(aggs_c)
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]), bounds


def _summary_of(one: DataFrame, cols: Sequence[str], bounds: list[IqrBounds]) -> DataFrame:
    rows = F.col("_rows")
    comp, uniq, mean_comp, mean_uniq = _means(len(cols)) if cols else [F.lit(None).cast("bigint")] * 4
    ot = sum((F.col(f"_o{j}") for j in range(len(bounds))), F.lit(0)).cast("bigint")
    empty = rows == 0
    return one.select(
        F.when(empty, F.lit("empty")).otherwise(F.lit("ok")).alias("status"),
        rows.cast("bigint").alias("rows"),
        F.when(empty, F.lit(0)).otherwise(F.lit(len(cols))).cast("int").alias("columns"),
        F.col("dups").alias("duplicate_rows"),
        ot.alias("outlier_total"),
        mean_comp.cast("double").alias("mean_completeness"),
        mean_uniq.cast("double").alias("mean_uniqueness"),
        F.when(empty, F.lit(None).cast("double"))
         .otherwise(quality_score_expr(comp, uniq, max(1, len(cols)), F.col("dups"), ot))
         .alias("quality_score"))


def quality_summary(df: DataFrame, method: str = "exact") -> DataFrame:
    """D10/D11 summary: one row ``status, rows, columns, duplicate_rows,
    outlier_total, mean_completeness, mean_uniqueness, quality_score``.
    Empty input: ``empty``.  ``method="approx"`` estimates quartiles and
    distinct counts."""
    one, bounds = _measured(df, method)
    return _summary_of(one, df.columns, bounds)


def quality_report(df: DataFrame, method: str = "exact") -> DataFrame:
    """Long report ``(scope, metric, value)``: per-column completeness,
    uniqueness, outliers (columns with any) and numeric stats, plus
    table-level rows, columns, duplicate_rows and quality_score."""
    from ..session import reliable_checkpoint
    one, bounds = _measured(df, method)
    one = reliable_checkpoint(one)  # one row, read twice below
    num = set(numeric_columns(df))
    cells = []
    for i, c in enumerate(df.columns):
        cells.append((c, "completeness", _completeness_at(i) / F.lit(10_000.0)))
        cells.append((c, "uniqueness", _uniqueness_at(i) / F.lit(10_000.0)))
        if c in num:
            cells += [(c, "min", F.col(f"_min{i}")), (c, "max", F.col(f"_max{i}")),
                      (c, "mean", F.col(f"_mean{i}")), (c, "std", F.col(f"_std{i}")),
                      (c, "nulls", F.col(f"_m{i}"))]
    for j, b in enumerate(bounds):
        cells.append((b.column, "outliers", F.when(F.col(f"_o{j}") > 0, F.col(f"_o{j}"))))
    arr = F.array(*[F.struct(F.lit(sc).alias("scope"), F.lit(m).alias("metric"),
                             v.cast("double").alias("value")) for sc, m, v in cells])
    per_col = one.select(F.inline(arr)).where(~((F.col("metric") == "outliers") & F.col("value").isNull()))
    summary = _summary_of(one, df.columns, bounds)
    table_metrics = ["rows", "columns", "duplicate_rows", "quality_score"]
    tcells = F.array(*[F.struct(F.lit("_table").alias("scope"), F.lit(m).alias("metric"),
                                F.col(m).cast("double").alias("value")) for m in table_metrics])
    return per_col.unionByName(summary.select(F.inline(tcells)))


def quality_by(df: DataFrame, by: str, method: str = "exact") -> DataFrame:
    """The summary row of every group of ``by`` (such as the source
    file), for all groups at once: one aggregate for counts, one for equal
    rows, one per column for distinct values and one for outliers, whatever
    the number of groups."""
    from .joins import size_checked
    from .quantiles import quantile_table
    cols = [c for c in df.columns if c != by]
    num = [c for c in numeric_columns(df) if c != by]
    key = F.col(by)
    parts = [df.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)]),
             duplicate_groups(df, [by]).groupBy(by).agg(F.sum(F.col("_n") - 1).cast("bigint").alias("dups"))]
    for i, c in enumerate(cols):
        values = df.where(~missing(df, c)).select(by, F.col(f"`{c}`").alias("v")).distinct()
        parts.append(values.groupBy(by).agg(F.count(F.lit(1)).alias(f"_d{i}")))
    if num:
        q = quantile_table(df, num, [0.25, 0.75], [by], method, names=["q1", "q3"])
        reach = 1.5 * (F.col("q3") - F.col("q1"))
        fence = F.struct("column_name", F.struct((F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi")))
        fences = q.groupBy(F.col(by).alias("_g")).agg(F.map_from_entries(F.collect_list(fence)).alias("_f"))  # a row a group
        out = F.lit(0)
        for c in num:
            f = F.element_at("_f", F.lit(c))
            out = out + F.coalesce(((number(c) < f["lo"]) | (number(c) > f["hi"])).cast("int"), F.lit(0))
        parts.append(df.join(size_checked(fences), key.eqNullSafe(F.col("_g"))).groupBy(by).agg(F.sum(out).alias("_o")))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    one = both.groupBy(by).agg(*[F.max(c).alias(c) for c in both.columns if c != by])
    one = one.select(by, "_rows", "dups", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in one.columns if c not in (by, "_rows", "dups")],
                     *([] if num else [F.lit(0).alias("_o")]))
    comp, uniq, mean_comp, mean_uniq = _means(len(cols))
    total = F.col("_o").cast("bigint")
    return one.select(by, F.lit("ok").alias("status"), F.col("_rows").cast("bigint").alias("rows"),
                      F.lit(len(cols)).cast("int").alias("columns"), F.col("dups").alias("duplicate_rows"), total.alias("outlier_total"),
                      mean_comp.alias("mean_completeness"), mean_uniq.alias("mean_uniqueness"),
                      quality_score_expr(comp, uniq, len(cols), F.col("dups"), total).alias("quality_score"))


def run_report(df: DataFrame, method: str = "exact") -> dict:
    """D11 as a driver-side dict (every part is a small aggregate):
    status, rows, columns, dtypes, completeness, uniqueness, outliers,
    duplicate_rows, numeric_stats, quality_score.  Empty input -> status
    ``empty``."""
    if not df.columns or df.limit(1).count() == 0:
        return {"status": "empty", "rows": 0, "columns": 0}
    summ = quality_summary(df, method).first()
    stats = {r["column_name"]: {k: r[k] for k in ("min", "max", "mean", "std", "nulls")}
             for r in numeric_stats(df).collect()}
    return {
        "status": "ok",
        "rows": summ["rows"],
        "columns": summ["columns"],
        "dtypes": dict(df.dtypes),
        "completeness": {r[0]: r[1] for r in completeness(df).collect()},
        "uniqueness": {r[0]: r[1] for r in uniqueness(df).collect()},
        "outliers": {r[0]: r[1] for r in iqr_outliers(df, method=method).collect()},
        "duplicate_rows": summ["duplicate_rows"],
        "numeric_stats": stats,
        "quality_score": summ["quality_score"],
    }
