"""Cleaning: dedup, fills, string normalisation, group-median fill.

Fitted steps are split into ``fit_*`` (returns small values or a small
DataFrame) and ``apply_*`` so batch, streaming and scoring share them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import clean_string
from ..functions.types import is_fractional, numeric_columns, string_columns
from .quantiles import fit_medians, quantile_table


def dedup_rows(df: DataFrame) -> DataFrame:
    """Exact-row dedup (hash aggregate; repeats combine map-side)."""
    return df.dropDuplicates()


def dedup_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
               keep: str = "last") -> DataFrame:
    """One row per key.  With ``order_by`` the survivor is the row with
    the largest (``keep="last"``) or smallest (``"first"``) order tuple, ties
    broken by the remaining columns, so the result is deterministic.

    Implemented as a ``max_by``/``min_by`` aggregate, which is combined
    map-side: a key holding a third of the rows never meets in one task in
    bulk, unlike ``row_number()`` over a window.
    """
    keys = list(keys)
    if not order_by:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    comparable = [c for c in rest if not isinstance(df.schema[c].dataType, T.MapType)]
    order = F.struct(*[F.col(c) for c in order_by],
                     *[F.col(c) for c in comparable if c not in order_by])
    payload = F.struct(*[F.col(c) for c in rest])
    pick = F.max_by(payload, order) if keep == "last" else F.min_by(payload, order)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def typed_literal(value, dt: T.DataType) -> Column:
    """A fill value cast to the column's type; integral columns round half-even."""
    lit = F.lit(value)
    if isinstance(dt, T.IntegralType) and value is not None:
        lit = F.bround(F.lit(float(value)), 0)
    return lit.cast(dt)


def fill_missing_expr(df: DataFrame, c: str, value) -> Column:
    dt = df.schema[c].dataType
    cur = F.col(c)
    if is_fractional(dt):
        cur = F.nanvl(cur, F.lit(None).cast(dt))
    return F.coalesce(cur, typed_literal(value, dt)).alias(c)


def fit_median_fill(df: DataFrame, columns: Sequence[str] | None = None,
                    overrides: Mapping[str, object] | None = None,
                    method: str = "exact") -> dict[str, object]:
    """E3 + E4 fit: fill value per numeric column (override wins)."""
    overrides = dict(overrides or {})
    cols = [c for c in (columns or numeric_columns(df)) if c not in overrides]
    values: dict[str, object] = dict(overrides)
    if cols:
        values.update(fit_medians(df, cols, method))
    return values


def apply_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """E3/E4/K5 apply: replace NULL (and NaN) with the fitted value; one select."""
    return df.select(*[fill_missing_expr(df, c, values[c])
                       if c in values and values[c] is not None else F.col(c)
                       for c in df.columns])


def median_fill(df: DataFrame, columns: Sequence[str] | None = None,
                overrides: Mapping[str, object] | None = None, method: str = "exact") -> DataFrame:
    return apply_fill(df, fit_median_fill(df, columns, overrides, method))


def string_clean(df: DataFrame, columns: Sequence[str] | None = None, fill: str = "Unknown",
                 strip_all_whitespace: bool = False) -> DataFrame:
    """Trim, blank -> NULL -> ``fill`` for every string column, one select."""
    cols = set(columns or string_columns(df))
    return df.select(*[clean_string(F.col(c), fill, strip_all_whitespace).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def const_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant fills per column (type-cast)."""
    return apply_fill(df, values)


def fit_group_median(df: DataFrame, column: str, by: Sequence[str],
                     method: str = "exact") -> DataFrame:
    """E9 fit: per-group medians as a small DataFrame ``(by..., _gm)``."""
    return quantile_table(df, [column], [0.5], by, method, names=["_gm"]).drop("column_name")


def group_median_fill(df: DataFrame, column: str, by: Sequence[str],
                      method: str = "exact") -> DataFrame:
    """Fill ``column`` with its group median, else the global median.

    Group medians come from the skew-safe quantile operator and are joined
    back on the group key: broadcast after a row count when the group table
    is small (a low-cardinality key would otherwise hash the big side into
    a few partitions), a shuffle join with AQE skew splitting otherwise.  A NULL
    group only gets the global fallback, as in pandas.
    """
    by = list(by)
    gm = fit_group_median(df, column, by, method)
    glob = fit_medians(df, [column], method)[column]
    dt = df.schema[column].dataType
    from .joins import size_checked_join
    joined = size_checked_join(df, gm, by, "left")
    cur = F.col(column)
    if is_fractional(dt):
        cur = F.nanvl(cur, F.lit(None).cast(dt))
    filled = F.coalesce(cur, typed_literal_col(F.col("_gm"), dt),
                        typed_literal(glob, dt) if glob is not None else F.lit(None).cast(dt))
    return joined.select(*[filled.alias(c) if c == column else F.col(c) for c in df.columns])


def typed_literal_col(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.IntegralType):
        return F.bround(c, 0).cast(dt)
    return c.cast(dt)
