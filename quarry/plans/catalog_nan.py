"""Registered queries: NaN counts as missing in every numeric operator (M4).

Input: ``events`` with NaN in every 31st value and NULL in every 37th.  The
SQL turns NaN into NULL first, so it has no notion of NaN of its own.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import aggregates as A
from ..operators import quality as Q
from ..operators.features import skew_log1p
from ..operators.quantiles import quantile_table
from ..operators.schema import constraint_violations
from .registry import register, table
from .sqlgen import iqr_sql

R = 6
MASKED = """WITH m AS (SELECT event_id, user_id, event_type,
  CASE WHEN event_id % 31 = 0 OR event_id % 37 = 0 THEN NULL ELSE value END AS value FROM events)"""


def _noisy(spark, sf):
    value = F.when(F.col("event_id") % 31 == 0, F.lit(float("nan"))).when(F.col("event_id") % 37 != 0, F.col("value"))
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", value.alias("value"))


@register("nan_outliers", f"{MASKED}\n{iqr_sql('m', ['event_id', 'user_id', 'value'])}")
def nan_outliers(spark, sf):
    return Q.iqr_outliers(_noisy(spark, sf))


@register("nan_quality", f"""{MASKED},
q AS ({iqr_sql('m', ['event_id', 'user_id', 'value'])})
SELECT count(*) AS rows, CAST((SELECT coalesce(sum(outliers), 0) FROM q) AS BIGINT) AS outlier_total,
       round((30000 + (20000 * count(value) + count(*)) // (2 * count(*))) / 40000.0, 6) AS mean_completeness FROM m""")
def nan_quality(spark, sf):
    out = Q.quality_summary(_noisy(spark, sf))
    return out.select("rows", "outlier_total", F.round("mean_completeness", R).alias("mean_completeness"))


@register("nan_constraints", f"""{MASKED}
SELECT CAST(count(*) FILTER (WHERE value < 20) AS BIGINT) AS value_below_min,
       CAST(count(*) FILTER (WHERE value > 80) AS BIGINT) AS value_above_max,
       CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS value_nulls FROM m""")
def nan_constraints(spark, sf):
    return constraint_violations(_noisy(spark, sf), {"value": {"min": 20, "max": 80, "nullable": False}})


@register("nan_flags_clip", f"""{MASKED}
SELECT event_id, coalesce(CAST(value > 50 AS INTEGER), 0) AS high, CASE WHEN value IS NOT NULL THEN least(greatest(value, 25), 75) END AS clipped FROM m""")
def nan_flags_clip(spark, sf):
    d = _noisy(spark, sf)
    return d.select("event_id", X.flag(X.number("value") > 50).alias("high"), X.number(X.clip("value", 25.0, 75.0)).alias("clipped"))


@register("nan_histogram", f"""{MASKED},
r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 12 AS width FROM m)
SELECT CAST(least(floor((value - lo) / width), 11) AS INTEGER) AS bin, count(*) AS count FROM m, r WHERE value IS NOT NULL GROUP BY 1""")
def nan_histogram(spark, sf):
    return A.histogram(_noisy(spark, sf), "value", 12).select("bin", "count")


@register("nan_box", f"""{MASKED},
q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3
      FROM m GROUP BY event_type)
SELECT event_type, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
       max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
       count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
FROM m JOIN q USING (event_type) GROUP BY event_type, q1, med, q3""")
def nan_box(spark, sf):
    b = A.box_summary(_noisy(spark, sf), "value", ["event_type"])
    return b.select("event_type", *[F.round(c, R).alias(c) for c in ("q1", "median", "q3")], "whisker_lo", "whisker_hi", "outliers")


@register("nan_corr", f"""{MASKED}
SELECT 'event_id' AS col_a, 'user_id' AS col_b, round(corr(event_id::DOUBLE, user_id::DOUBLE), 6) AS corr FROM m
UNION ALL SELECT 'event_id', 'value', round(corr(event_id::DOUBLE, value), 6) FROM m
UNION ALL SELECT 'user_id', 'value', round(corr(user_id::DOUBLE, value), 6) FROM m""")
def nan_corr(spark, sf):
    out = A.correlation_pairs(_noisy(spark, sf), ["event_id", "user_id", "value"])
    return out.select("col_a", "col_b", F.round("corr", R).alias("corr"))


@register("nan_skew", f"""{MASKED}
SELECT event_id, CASE WHEN value IS NULL THEN NULL WHEN (SELECT skewness(value) FROM m) > 0.75 THEN round(ln(1 + greatest(value, 0)), 6) ELSE round(value, 6) END AS value FROM m""")
def nan_skew(spark, sf):
    out = skew_log1p(_noisy(spark, sf), ["value"])
    return out.select("event_id", F.round(X.number("value"), R).alias("value"))


@register("nan_quantiles", f"""{MASKED}
SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90 FROM m GROUP BY event_type""")
def nan_quantiles(spark, sf):
    out = quantile_table(_noisy(spark, sf), ["value"], [0.1, 0.9], ["event_type"], names=["p10", "p90"])
    return out.select("event_type", F.round("p10", R).alias("p10"), F.round("p90", R).alias("p90"))
