"""Registered queries: projections, filters and scalar features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators.features import (audit_columns, batch_id_for, low_cardinality_normalize,
                                  skew_log1p)
from ..operators.schema import safe_cast
from .fixtures import dirty_orders
from .registry import register, table
from .sqlgen import with_dirty

R = 6


@register("feat_select", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def feat_select(spark, sf):
    """column subset; dropping absent names is a no-op."""
    return table(spark, sf, "orders").drop("o_custkey", "o_orderstatus", "o_orderpriority", "no_such_col")


@register("api_transforms", r"""
SELECT c_custkey, c_name AS customer_name, lower(c_mktsegment) AS c_mktsegment,
       CASE WHEN regexp_matches(c_name, '#(\d+)') THEN regexp_extract(c_name, '#(\d+)', 1) END AS name_num
FROM customer""")
def api_transforms(spark, sf):
    """Lower, extract (before rename), rename."""
    from ..operators.features import apply_transforms
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return apply_transforms(cust, {"lower": ["c_mktsegment"],
                                   "extract": {"c_name": {"new_col": "name_num", "pattern": r"#(\d+)"}},
                                   "rename": {"c_name": "customer_name"}})


@register("isin_filter", """
SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_totalprice > 100000""")
def isin_filter(spark, sf):
    o = table(spark, sf, "orders")
    return o.where(F.col("o_orderstatus").isin("F", "O") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                   & (F.col("o_totalprice") > 100000))


def _low_card_sql(c):
    return (f"CASE WHEN (SELECT count(DISTINCT {c}) FROM part) < 20 "
            f"THEN regexp_replace(lower({c}), '\\s+', '_', 'g') ELSE {c} END AS {c}")


@register("low_card_norm", "SELECT p_partkey, " + ", ".join(_low_card_sql(c) for c in ("p_name", "p_brand", "p_type"))
          + ", p_size, p_retailprice FROM part")
def low_card_norm(spark, sf):
    return low_cardinality_normalize(table(spark, sf, "part"), max_distinct=20)


@register("regex_extract", r"""
SELECT c_custkey,
  CASE WHEN regexp_matches(c_name, '^([A-Za-z]+)') THEN regexp_extract(c_name, '^([A-Za-z]+)', 1) END AS name_prefix,
  CASE WHEN regexp_matches(c_name, '([A-Z])') THEN regexp_extract(c_name, '([A-Z])', 1) END AS first_capital,
  CASE WHEN regexp_matches(c_name, '#0*([1-9][0-9]*)$') THEN regexp_extract(c_name, '#0*([1-9][0-9]*)$', 1) END AS serial,
  CASE WHEN regexp_matches(c_mktsegment, ' ([A-Za-z]+)\.') THEN regexp_extract(c_mktsegment, ' ([A-Za-z]+)\.', 1) END AS title
FROM customer""")
def regex_extract(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey",
                    X.regex_extract("c_name", r"^([A-Za-z]+)").alias("name_prefix"),
                    X.regex_extract("c_name", r"([A-Z])").alias("first_capital"),
                    X.regex_extract("c_name", r"#0*([1-9][0-9]*)$").alias("serial"),
                    X.regex_extract("c_mktsegment", r" ([A-Za-z]+)\.").alias("title"))


@register("value_map", """
SELECT o_orderkey,
  coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END, 0) AS priority_code,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE 'Other' END AS status_group
FROM orders""")
def value_map(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey",
                    X.value_map("o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}, 0)
                    .alias("priority_code"),
                    X.keep_or_other("o_orderstatus", ["F", "O"]).alias("status_group"))


@register("split_cols", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS name_w0,
  CASE WHEN len(string_split(p_name, ' ')) >= 2 THEN string_split(p_name, ' ')[2] END AS name_w1,
  CASE WHEN len(string_split(p_name, ' ')) >= 3 THEN string_split(p_name, ' ')[3] END AS name_w2,
  split_part(p_brand, '#', 1) AS brand_prefix, string_split(p_brand, '#')[2] AS brand_no
FROM part""")
def split_cols(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.split_part("p_name", " ", 0).alias("name_w0"),
                    X.split_part("p_name", " ", 1).alias("name_w1"),
                    X.split_part("p_name", " ", 2).alias("name_w2"),
                    X.split_part("p_brand", "#", 0).alias("brand_prefix"),
                    X.split_part("p_brand", "#", 1).alias("brand_no"))


@register("substr_count", """
SELECT doc_id, CAST(length(text) - length(replace(text, ' ', '')) AS INTEGER) AS n_spaces,
       CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS INTEGER) AS n_the
FROM documents""")
def substr_count(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.substring_count("text", " ").alias("n_spaces"),
                    X.substring_count("text", "the").alias("n_the"))


_AGE_TEXT = "CASE WHEN age IS NULL THEN 'unknown' ELSE CAST(age AS VARCHAR) END"


@register("safe_cast", with_dirty(f"""
SELECT id, CAST(cust_text AS BIGINT) AS cust_text, age_text, TRY_CAST(age_text AS DOUBLE) AS age_num FROM (
  SELECT id, CAST(cust AS VARCHAR) AS cust_text, {_AGE_TEXT} AS age_text FROM dirty)"""))
def safe_cast_q(spark, sf):
    """All-or-nothing cast (cust_text casts cleanly, age_text does
    not and keeps its type) and a coercing numeric parse."""
    d = dirty_orders(table(spark, sf, "orders"))
    t = d.select("id", F.col("cust").cast("string").alias("cust_text"),
                 F.when(F.col("age").isNull(), F.lit("unknown")).otherwise(F.col("age").cast("string"))
                 .alias("age_text"))
    out, _ = safe_cast(t, {"cust_text": {"dtype": "int64"}, "age_text": {"dtype": "int64"}})
    return out.withColumn("age_num", X.to_double("age_text"))


@register("cast_failures", with_dirty(f"""
SELECT CAST(count(*) FILTER (WHERE TRY_CAST(cust_text AS BIGINT) IS NULL) AS BIGINT) AS cust_text_cast_failures,
       CAST(count(*) FILTER (WHERE TRY_CAST(age_text AS BIGINT) IS NULL) AS BIGINT) AS age_text_cast_failures
FROM (SELECT CAST(cust AS VARCHAR) AS cust_text, {_AGE_TEXT} AS age_text FROM dirty)"""))
def cast_failures(spark, sf):
    d = dirty_orders(table(spark, sf, "orders"))
    t = d.select(F.col("cust").cast("string").alias("cust_text"),
                 F.when(F.col("age").isNull(), F.lit("unknown")).otherwise(F.col("age").cast("string"))
                 .alias("age_text"))
    _, fails = safe_cast(t, {"cust_text": {"dtype": "int64"}, "age_text": {"dtype": "int64"}})
    return fails


@register("date_parse", with_dirty("""
SELECT id, date_text, TRY_CAST(date_text AS TIMESTAMP) AS date_ts,
       CAST(year(TRY_CAST(date_text AS TIMESTAMP)) AS INTEGER) AS date_ts_year,
       CAST(month(TRY_CAST(date_text AS TIMESTAMP)) AS INTEGER) AS date_ts_month
FROM dirty"""))
def date_parse(spark, sf):
    d = dirty_orders(table(spark, sf, "orders")).select("id", "date_text")
    ts = X.parse_timestamp("date_text")
    return d.select("id", "date_text", ts.alias("date_ts"), *X.date_parts(ts, "date_ts"))


@register("date_parts", """
SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year,
       CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month
FROM orders""")
def date_parts(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderdate", *X.date_parts("o_orderdate", "o_orderdate"))


# The categorize rules of the shipped Spark ETL example config.
AMOUNT_CATEGORIES = {
    "low": {"rules": [{"lt": 100}]},
    "medium": {"rules": [{"between": [100, 1000]}]},
    "high": {"rules": [{"between": [1000, 100000]}]},
}


@register("categorize", """
SELECT o_orderkey, o_totalprice,
  CASE WHEN o_totalprice IS NULL THEN NULL WHEN o_totalprice < 100 THEN 'low'
       WHEN o_totalprice >= 100 AND o_totalprice < 1000 THEN 'medium'
       WHEN o_totalprice >= 1000 AND o_totalprice < 100000 THEN 'high' END AS o_totalprice_category
FROM orders""")
def categorize(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", "o_totalprice",
                    X.categorize("o_totalprice", AMOUNT_CATEGORIES).alias("o_totalprice_category"))


@register("fixed_bins", """
SELECT p_partkey, p_size,
  CASE WHEN p_size > 0 AND p_size <= 10 THEN 'xs' WHEN p_size > 10 AND p_size <= 20 THEN 's'
       WHEN p_size > 20 AND p_size <= 30 THEN 'm' WHEN p_size > 30 AND p_size <= 40 THEN 'l'
       WHEN p_size > 40 AND p_size <= 50 THEN 'xl' END AS size_bin,
  CASE WHEN p_size > 0 AND p_size <= 25 THEN 0 WHEN p_size > 25 AND p_size <= 45 THEN 1 END AS size_code
FROM part""")
def fixed_bins(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", "p_size",
                    X.fixed_bins("p_size", [0, 10, 20, 30, 40, 50], ["xs", "s", "m", "l", "xl"]).alias("size_bin"),
                    X.fixed_bins("p_size", [0, 25, 45]).alias("size_code"))


@register("arith_features", """
SELECT l_orderkey, l_linenumber,
  l_extendedprice * (1 - l_discount) AS revenue,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
  CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
  l_extendedprice / (l_linenumber + 1) AS price_per_line,
  l_quantity + l_linenumber AS qty_plus_line,
  l_tax - l_discount AS tax_minus_discount
FROM lineitem""")
def arith_features(spark, sf):
    """row-wise arithmetic; identical IEEE operations in both engines, so
    no rounding is needed for the comparison."""
    li = table(spark, sf, "lineitem")
    rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber",
                     rev.alias("revenue"),
                     (rev * (1 + F.col("l_tax"))).alias("charge"),
                     X.safe_divide("l_extendedprice", "l_quantity").alias("unit_price"),
                     X.safe_divide(F.col("l_extendedprice"), F.col("l_linenumber") + 1).alias("price_per_line"),
                     (F.col("l_quantity") + F.col("l_linenumber")).alias("qty_plus_line"),
                     (F.col("l_tax") - F.col("l_discount")).alias("tax_minus_discount"))


@register("flags", with_dirty("""
SELECT id, CAST(amount IS NOT NULL AS INTEGER) AS has_amount, coalesce(CAST(age > 0 AS INTEGER), 0) AS age_positive,
       coalesce(CAST(amount > 200000 AS INTEGER), 0) AS big_order,
       CASE WHEN cust % 2 = 0 THEN 1 ELSE 0 END AS even_customer
FROM dirty"""))
def flags(spark, sf):
    d = dirty_orders(table(spark, sf, "orders"))
    return d.select("id", X.present("amount").alias("has_amount"),
                    X.flag(F.col("age") > 0).alias("age_positive"),
                    X.flag(F.col("amount") > 200000).alias("big_order"),
                    X.flag(F.col("cust") % 2 == 0).alias("even_customer"))


@register("clip", """
SELECT l_orderkey, l_linenumber, least(greatest(l_quantity, 5), 45) AS l_quantity,
       least(greatest(l_discount, 0.02), 0.08) AS l_discount FROM lineitem""")
def clip(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", X.clip("l_quantity", 5, 45).alias("l_quantity"),
                     X.clip("l_discount", 0.02, 0.08).alias("l_discount"))


def _skew_sql(c):
    return (f"CASE WHEN (SELECT skewness({c}) FROM events) > 0.75 THEN round(ln(1 + greatest(CAST({c} AS DOUBLE), 0)), 6) "
            f"ELSE round(CAST({c} AS DOUBLE), 6) END AS {c}")


@register("skew_log1p", "SELECT event_id AS id, " + ", ".join(_skew_sql(c) for c in ("event_id", "user_id", "value"))
          + " FROM events")
def skew_log1p_q(spark, sf):
    """log1p(clip(x, 0)) on numeric columns whose corrected skew > 0.75."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), "event_id", "user_id", "value")
    out = skew_log1p(e, ["event_id", "user_id", "value"], threshold=0.75)
    return out.select("id", *[F.round(F.col(c).cast("double"), R).alias(c) for c in ("event_id", "user_id", "value")])


@register("record_hash", r"""
SELECT c_custkey, sha256(concat_ws('||', coalesce(CAST(c_custkey AS VARCHAR), '\N'), coalesce(c_name, '\N'),
       coalesce(CAST(c_nationkey AS VARCHAR), '\N'), coalesce(c_mktsegment, '\N'))) AS _record_hash
FROM customer""")
def record_hash(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", X.record_hash(["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
                    .alias("_record_hash"))


# Fixed run clock used by the audit-column check (injected, like a replayed run).
AUDIT_RUN_AT = "2024-01-01 00:00:00"


@register("audit_cols", f"""
SELECT o_orderkey, TIMESTAMP '{AUDIT_RUN_AT}' AS _etl_loaded_at,
       substr(sha256('{AUDIT_RUN_AT}'), 1, 12) AS _etl_batch_id FROM orders""")
def audit_cols(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return audit_columns(o, loaded_at=AUDIT_RUN_AT, batch_id=batch_id_for(AUDIT_RUN_AT, 12))
