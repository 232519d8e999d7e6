"""Column expressions for cleaning and feature engineering.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_literal_regex(text: str) -> str:
    """A Java regex that matches ``text`` literally."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def strip_expr(c: ColumnOrName, all_whitespace: bool = False) -> Column:
    """Spark ``trim`` strips spaces only; ``all_whitespace`` strips like Python."""
    if all_whitespace:
        return F.regexp_replace(_c(c), r"^\s+|\s+$", "")
    return F.trim(_c(c))


def clean_string(c: ColumnOrName, fill: str | None = "Unknown", all_whitespace: bool = False) -> Column:
    """Trim, blank -> NULL, NULL -> ``fill``."""
    v = F.nullif(strip_expr(c, all_whitespace), F.lit(""))
    return F.coalesce(v, F.lit(fill)) if fill is not None else v


def categorize(c: ColumnOrName, mapping: Mapping[str, object]) -> Column:
    """rule-based labels in config order; ``lt`` is strict, ``between``
    is half-open [lo, hi); NULL input or no match -> NULL.

    ``mapping`` is ``{label: {"rules": [...]}}`` or ``{label: [rule, ...]}``
    where a list rule may name another column with ``"col"``.
    """
    expr = None
    base = _c(c)
    for label, rules in mapping.items():
        rule_list = rules.get("rules", []) if isinstance(rules, Mapping) else list(rules)
        for rule in rule_list:
            ref = F.col(rule["col"]) if isinstance(rule, Mapping) and "col" in rule else base
            if "lt" in rule:
                cond = ref < F.lit(rule["lt"])
            elif "lte" in rule:
                cond = ref <= F.lit(rule["lte"])
            elif "gt" in rule:
                cond = ref > F.lit(rule["gt"])
            elif "gte" in rule:
                cond = ref >= F.lit(rule["gte"])
            elif "between" in rule:
                lo, hi = rule["between"]
                cond = (ref >= F.lit(lo)) & (ref < F.lit(hi))
            elif "eq" in rule:
                cond = ref == F.lit(rule["eq"])
            else:
                continue
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(None).cast("string")
    return F.when(base.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(None)))


def fixed_bins(c: ColumnOrName, edges: Sequence[float], labels: Sequence | None = None,
               include_lowest: bool = False) -> Column:
    """right-closed bins (lo, hi]; outside -> NULL; labels or 0-based codes."""
    x = _c(c)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        lower_ok = (x >= F.lit(lo)) if (include_lowest and i == 0) else (x > F.lit(lo))
        out = F.lit(labels[i]) if labels is not None else F.lit(i)
        cond = lower_ok & (x <= F.lit(hi))
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr


def number(c: ColumnOrName) -> Column:
    """A numeric column whose NaN counts as missing (NULL); the type stays."""
    x = _c(c)
    return F.when(~F.isnan(x.cast("double")), x)


def clip(c: ColumnOrName, lo=None, hi=None) -> Column:
    """clip to [lo, hi]; NULL stays NULL (greatest/least skip NULLs) and
    NaN stays NaN."""
    x = _c(c)
    out = x
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return F.when(F.isnan(x.cast("double")), x).when(x.isNotNull(), out)


def flag(cond: Column) -> Column:
    """0/1 flag; a comparison with NULL gives 0 (compare ``number(c)``
    where NaN must give 0, too: to Spark it is the greatest number)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def present(c: ColumnOrName) -> Column:
    return _c(c).isNotNull().cast("int")


def value_map(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """dictionary lookup with a default for misses and NULL input."""
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    x = _c(c)
    hit = F.when(x.isNotNull(), F.element_at(m, x))
    return F.coalesce(hit, F.lit(default)) if default is not None else hit


def keep_or_other(c: ColumnOrName, keep: Sequence, other: str = "Other") -> Column:
    """keep whitelisted values, else ``other``."""
    x = _c(c)
    return F.when(x.isin(list(keep)), x).otherwise(F.lit(other))


def split_part(c: ColumnOrName, sep: str, index: int) -> Column:
    """element ``index`` (0-based) of a literal split; NULL when short."""
    return F.get(F.split(_c(c), java_literal_regex(sep)), index)


def substring_count(c: ColumnOrName, sub: str) -> Column:
    """non-overlapping occurrences of a literal substring."""
    return F.regexp_count(_c(c), F.lit(java_literal_regex(sub)))


def regex_extract(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``; no match -> NULL (pandas ``str.extract``)."""
    x = _c(c)
    return F.when(x.rlike(pattern), F.regexp_extract(x, pattern, group))


def to_double(c: ColumnOrName) -> Column:
    """numeric parse, bad -> NULL."""
    return _c(c).try_cast("double")


def parse_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """timestamp parse, bad -> NULL (never raises under ANSI).  The
    result is a wall-clock ``timestamp_ntz`` like the source tables."""
    x = _c(c).cast("string")
    ts = F.try_to_timestamp(x, F.lit(fmt)) if fmt else F.try_to_timestamp(x)
    return ts.cast("timestamp_ntz")


def date_parts(c: ColumnOrName, name: str) -> list[Column]:
    """F16: ``<name>_year``, ``<name>_month``."""
    x = _c(c)
    return [F.year(x).alias(f"{name}_year"), F.month(x).alias(f"{name}_month")]


# Fixed value: separator between fields of the row hash.
HASH_SEPARATOR = "||"
# NULL marker inside the row hash, so (NULL, a) and (a, NULL) differ.
HASH_NULL = "\\N"


def record_hash(columns: Sequence[ColumnOrName], null_marker: str | None = HASH_NULL) -> Column:
    """SHA-256 of the ``||``-joined string forms of ``columns``."""
    parts = []
    for c in columns:
        s = _c(c).cast("string")
        parts.append(F.coalesce(s, F.lit(null_marker)) if null_marker is not None else s)
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """F19 ratio: NULL instead of a division-by-zero error."""
    return F.try_divide(_c(a), _c(b))


def lower_snake(c: ColumnOrName) -> Column:
    """lower-case, whitespace runs -> ``_``."""
    return F.regexp_replace(F.lower(_c(c)), r"\s+", "_")


def skew_corrected(c: ColumnOrName) -> Column:
    """H8 aggregate: bias-corrected sample skewness (pandas / DuckDB form)."""
    x = number(c)
    n = F.count(x)
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))

