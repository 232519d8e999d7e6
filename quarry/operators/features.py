"""Feature and transform stages with a small fit step (F7, H8/F22, F24/F25,
configurable API transforms)."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions.nested import has_path, nested, quoted
from ..functions.types import columns_named_like, spark_type, string_columns


def fit_low_cardinality(df: DataFrame, max_distinct: int = 20,
                        skip_date_like: bool = True) -> list[str]:
    """F7 fit: string columns with fewer than ``max_distinct`` distinct values.

    """
    cols = string_columns(df)
    if skip_date_like:
        dates = set(columns_named_like(df))
        cols = [c for c in cols if c not in dates]
    if not cols:
        return []
    # HyperLogLog first (bounded memory per column); exact distinct counts
    # only for the columns that can still be under the limit.
    approx = df.agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in cols]).first()
    near = [c for c in cols if approx[c] < max_distinct * 2 + 10]
    if not near:
        return []
    row = df.agg(*[F.count_distinct(c).alias(c) for c in near]).first()
    return [c for c in near if row[c] < max_distinct]


def low_cardinality_normalize(df: DataFrame, max_distinct: int = 20,
                              columns: Sequence[str] | None = None) -> DataFrame:
    """F7 apply: lower-case and ``_`` for whitespace runs on low-cardinality strings."""
    cols = set(columns if columns is not None else fit_low_cardinality(df, max_distinct))
    return df.select(*[X.lower_snake(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def fit_skewed(df: DataFrame, columns: Sequence[str], threshold: float = 0.75) -> list[str]:
    """H8 fit: columns whose bias-corrected skewness exceeds ``threshold``."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return []
    row = df.agg(*[X.skew_corrected(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is not None and row[c] > threshold]


def skew_log1p(df: DataFrame, columns: Sequence[str], threshold: float = 0.75,
               skewed: Sequence[str] | None = None) -> DataFrame:
    """F22 apply: ``log1p(max(x, 0))`` on the skewed columns."""
    sk = set(skewed if skewed is not None else fit_skewed(df, columns, threshold))
    return df.select(*[F.log1p(X.clip(F.col(c).cast("double"), lo=0.0)).alias(c) if c in sk
                       else F.col(c) for c in df.columns])


def batch_id_for(clock: str | float | None = None, length: int = 12) -> str:
    """hex prefix of SHA-256 of the run clock, fixed once per run."""
    clock = str(time.time()) if clock is None else str(clock)
    return hashlib.sha256(clock.encode()).hexdigest()[:length]


def audit_columns(df: DataFrame, loaded_at: str | None = None, batch_id: str | None = None,
                  loaded_col: str = "_etl_loaded_at", batch_col: str = "_etl_batch_id") -> DataFrame:
    """load timestamp and batch id, both constant within a run."""
    ts = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else F.current_timestamp()
    return df.select("*", ts.alias(loaded_col), F.lit(batch_id or batch_id_for()).alias(batch_col))


def nested_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add a column for every dotted name that is a path into a column of
    ``df`` (C8), so that transforms, renames and casts can refer to it."""
    new = [n for n in dict.fromkeys(names) if n not in df.columns and "." in n and has_path(df, n)]
    return df.select("*", *[nested(df, n).alias(n) for n in new]) if new else df


def apply_transforms(df: DataFrame, spec: Mapping) -> DataFrame:
    """Configurable column transforms: ``lower``, ``extract``, ``rename`` and
    ``dtype`` (a cast), applied in that order so an extract reads the
    original name (M8).  NULL stays NULL."""
    out = df
    lower = set(spec.get("lower", []))
    if lower:
        out = out.select(*[F.lower(quoted(c)).alias(c) if c in lower else quoted(c) for c in out.columns])
    extracts = spec.get("extract", {})
    if extracts:
        out = out.select("*", *[X.regex_extract(src, e["pattern"], e.get("group", 1)).alias(e["new_col"])
                                for src, e in extracts.items()])
    casts = spec.get("dtype", {})
    if casts:
        out = out.select(*[quoted(c).try_cast(spark_type(casts[c])).alias(c) if c in casts else quoted(c)
                           for c in out.columns])
    renames = spec.get("rename", {})
    for old, new in renames.items():
        out = out.withColumnRenamed(old, new)
    return out
