"""Schema checks and constraints.

Column presence and type checks are driver-side schema comparisons; value
constraints are counted in a single aggregate pass.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import number
from ..functions.types import spark_type
from .quality import missing

log = logging.getLogger("quarry.schema")


class SchemaViolation(ValueError):
    pass


@dataclass
class SchemaReport:
    missing_columns: list[str] = field(default_factory=list)
    type_mismatches: dict[str, tuple[str, str]] = field(default_factory=dict)


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Expected columns absent from ``df`` (sorted)."""
    return sorted(set(expected) - set(df.columns))


def check_expected_columns(df: DataFrame, expected: Sequence[str], strict: bool = False) -> list[str]:
    miss = missing_columns(df, expected)
    if miss:
        if strict:
            raise SchemaViolation(f"Missing column(s): {', '.join(miss)}")
        log.warning("Missing columns: %s", miss)
    return miss


def check_schema(df: DataFrame, spec: Mapping[str, Mapping], strict: bool = False) -> SchemaReport:
    """Presence and dtype of every column in a constraint map."""
    rep = SchemaReport()
    for c, rule in spec.items():
        if c not in df.columns:
            if strict:
                raise SchemaViolation(f"Missing column: {c}")
            log.warning("Missing column: %s", c)
            rep.missing_columns.append(c)
            continue
        want = rule.get("dtype") if isinstance(rule, Mapping) else None
        if want:
            want_t = spark_type(want)
            got = df.schema[c].dataType
            if want_t != got:
                rep.type_mismatches[c] = (want_t.simpleString(), got.simpleString())
    return rep


def constraint_violations(df: DataFrame, spec: Mapping[str, Mapping], strict: bool = False) -> DataFrame:
    """One row of violation counts, ``<c>_below_min``, ``<c>_above_max``
    and ``<c>_nulls`` (for ``nullable: false``), from one aggregate.  NaN is
    missing, not a value beyond a bound.

    ``strict`` checks presence first (raising on a missing column).
    """
    check_schema(df, spec, strict)
    aggs = []
    for c, rule in spec.items():
        if c not in df.columns:
            continue
        if "min" in rule:
            aggs.append(F.count_if(number(c) < F.lit(rule["min"])).alias(f"{c}_below_min"))
        if "max" in rule:
            aggs.append(F.count_if(number(c) > F.lit(rule["max"])).alias(f"{c}_above_max"))
        if rule.get("nullable", True) is False or rule.get("required", False):
            aggs.append(F.count_if(missing(df, c)).alias(f"{c}_nulls"))
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("rows")]
    return df.agg(*aggs)


def safe_cast(df: DataFrame, spec: Mapping[str, Mapping], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Required columns and all-or-nothing casts.

    Returns ``(df_cast, failures)``.  A column is cast only when none of its
    non-null values fail the cast (pandas ``astype`` semantics); otherwise it
    keeps its original type.  ``failures`` is one row of failure counts.
    The decision needs the counts, so they are computed first (one pass).
    """
    casts = {}
    for c, rule in spec.items():
        if c not in df.columns:
            if rule.get("required", False) and strict:
                raise SchemaViolation(f"Missing required column: {c}")
            continue
        if rule.get("dtype"):
            casts[c] = spark_type(rule["dtype"])
    if not casts:
        return df, df.agg(F.count(F.lit(1)).alias("rows"))
    fails = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{c}_cast_failures")
                     for c, t in casts.items()])
    counts = fails.first().asDict()
    ok = {c: t for c, t in casts.items() if counts[f"{c}_cast_failures"] == 0}
    out = df.select(*[F.col(c).cast(ok[c]).alias(c) if c in ok else F.col(c) for c in df.columns])
    return out, fails

