"""Registered queries: cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from .fixtures import KNN_PARTS_CTE, dirty_orders, knn_parts
from .registry import register, table
from .sqlgen import with_dirty


def _dirty(spark, sf):
    return dirty_orders(table(spark, sf, "orders"))


@register("dedup_rows", with_dirty("SELECT DISTINCT * FROM dirty"))
def dedup_rows(spark, sf):
    return C.dedup_rows(_dirty(spark, sf))


@register("dedup_keys", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def dedup_keys(spark, sf):
    return C.dedup_keys(table(spark, sf, "events"), ["user_id", "event_type"],
                        order_by=["ts", "event_id"], keep="last")


_MEDIANS = "m AS (SELECT median(amount) AS m_amount, median(age) AS m_age FROM dirty)"


@register("median_fill", with_dirty(f""", {_MEDIANS}
SELECT id, cust, status, priority, coalesce(amount, m_amount) AS amount,
       coalesce(age, CAST(round_even(m_age, 0) AS INTEGER)) AS age, date_text
FROM dirty, m"""))
def median_fill(spark, sf):
    return C.median_fill(_dirty(spark, sf))


@register("fill_override", with_dirty(f""", {_MEDIANS}
SELECT id, cust, status, priority, coalesce(amount, 0.0) AS amount,
       coalesce(age, CAST(round_even(m_age, 0) AS INTEGER)) AS age, date_text
FROM dirty, m"""))
def fill_override(spark, sf):
    return C.median_fill(_dirty(spark, sf), overrides={"amount": 0.0})


@register("string_clean", with_dirty("""
SELECT id, cust, coalesce(nullif(trim(status), ''), 'Unknown') AS status,
       coalesce(nullif(trim(priority), ''), 'Unknown') AS priority, amount, age,
       coalesce(nullif(trim(date_text), ''), 'Unknown') AS date_text
FROM dirty"""))
def string_clean(spark, sf):
    return C.string_clean(_dirty(spark, sf))


@register("const_fill", with_dirty("""
SELECT id, cust, status, coalesce(priority, 'None') AS priority, coalesce(amount, 0.0) AS amount,
       coalesce(age, 0) AS age, date_text FROM dirty"""))
def const_fill(spark, sf):
    return C.const_fill(_dirty(spark, sf), {"priority": "None", "amount": 0.0, "age": 0})


@register("group_median_fill", with_dirty("""
, g AS (SELECT status, median(amount) AS gm FROM dirty GROUP BY status),
  m AS (SELECT median(amount) AS m FROM dirty)
SELECT id, cust, status, priority, coalesce(amount, gm, m) AS amount, age, date_text
FROM dirty LEFT JOIN g USING (status), m"""))
def group_median_fill(spark, sf):
    return C.group_median_fill(_dirty(spark, sf), "amount", ["status"])


@register("knn_impute", f"""
WITH {KNN_PARTS_CTE},
r AS (SELECT p_partkey, p_retailprice FROM kp WHERE p_size IS NULL),
d AS (SELECT p_partkey AS did, p_size, p_retailprice FROM kp WHERE p_size IS NOT NULL),
c AS (SELECT r.p_partkey, d.p_size, row_number() OVER (PARTITION BY r.p_partkey
        ORDER BY abs(r.p_retailprice - d.p_retailprice), d.did) AS rn FROM r, d),
k AS (SELECT p_partkey, avg(p_size) AS v FROM c WHERE rn <= 5 GROUP BY p_partkey)
SELECT kp.p_partkey, round(coalesce(CAST(kp.p_size AS DOUBLE), k.v), 6) AS p_size, kp.p_retailprice
FROM kp LEFT JOIN k USING (p_partkey)""")
def knn_impute(spark, sf):
    """p_size imputed from the 5 parts nearest in retail price."""
    from ..operators.knn import knn_impute_1d
    kp = knn_parts(table(spark, sf, "part")).select("p_partkey", "p_size", "p_retailprice")
    out = knn_impute_1d(kp, "p_size", "p_retailprice", "p_partkey", k=5)
    return out.select("p_partkey", F.round("p_size", 6).alias("p_size"), "p_retailprice")
