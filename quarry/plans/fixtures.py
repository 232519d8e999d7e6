"""Derived inputs built from the given tables (same rows in Spark and SQL).

The driver tables carry no NULLs, blanks, bad dates or repeated keys, so
null/blank/duplicate operators run on ``dirty``: every ``orders`` row with
deterministic defects, plus a repeat of every tenth order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRTY_CTE = """b AS (
  SELECT o_orderkey AS id, o_custkey AS cust, o_orderstatus AS status,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL
              WHEN o_orderkey % 11 = 0 THEN ''
              WHEN o_orderkey % 7 = 0 THEN '  ' || o_orderpriority || ' '
              ELSE o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS amount,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey % 90 AS INT) END AS age,
         CASE WHEN o_orderkey % 23 = 0 THEN 'not a date'
              ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_text
  FROM orders),
dirty AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE id % 10 = 0)"""


def dirty_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    pr = F.col("o_orderpriority")
    b = orders.select(
        k.alias("id"),
        F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("status"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .when(k % 11 == 0, F.lit(""))
         .when(k % 7 == 0, F.concat(F.lit("  "), pr, F.lit(" ")))
         .otherwise(pr).alias("priority"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(k % 19 == 0, F.lit(None).cast("int"))
         .otherwise((F.col("o_custkey") % 90).cast("int")).alias("age"),
        F.when(k % 23 == 0, F.lit("not a date"))
         .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("date_text"),
    )
    return b.unionByName(b.where(F.col("id") % 10 == 0))


def knn_parts(part: DataFrame) -> DataFrame:
    """KNN input: ``part`` with ``p_size`` missing where ``p_partkey % 37 = 0``."""
    return part.withColumn("p_size", F.when(F.col("p_partkey") % 37 == 0, F.lit(None).cast("int"))
                           .otherwise(F.col("p_size")))


KNN_PARTS_CTE = """kp AS (SELECT p_partkey, p_name, p_brand, p_type,
  CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_size END AS p_size, p_retailprice FROM part)"""


def scored_labels(labels: DataFrame) -> DataFrame:
    """Evaluation input: labels with a deterministic score and prediction."""
    score = ((F.col("doc_id") * 7919) % 1000) / 1000.0
    return labels.select("doc_id", "quality", "toxic", score.alias("score"),
                         (score > 0.5).cast("int").alias("prediction"))


SCORED_CTE = """scored AS (SELECT doc_id, quality, toxic, (doc_id * 7919 % 1000) / 1000.0 AS score,
  CAST((doc_id * 7919 % 1000) / 1000.0 > 0.5 AS INTEGER) AS prediction FROM labels)"""
