"""Registered queries: joins, aggregates, windows, ordering, sets (G, H, I, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import windows as W
from ..operators.joins import lookup_join, union_tagged
from .registry import register, table

R = 6
_TRAIN_CUTOFF = "1999-01-01"
_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax"]


@register("group_lookup_join", f"""
WITH tr AS (SELECT o_custkey, o_orderstatus, avg(o_totalprice) AS grp_mean, count(*) AS grp_count
            FROM orders WHERE o_orderdate < TIMESTAMP '{_TRAIN_CUTOFF}' GROUP BY o_custkey, o_orderstatus),
     g AS (SELECT avg(o_totalprice) AS m FROM orders WHERE o_orderdate < TIMESTAMP '{_TRAIN_CUTOFF}')
SELECT o_orderkey, round(coalesce(grp_mean, m), 6) AS grp_mean, coalesce(grp_count, 0) AS grp_count
FROM orders LEFT JOIN tr USING (o_custkey, o_orderstatus), g""")
def group_lookup_join(spark, sf):
    """G1: statistics fitted on earlier orders, looked up for all orders."""
    o = table(spark, sf, "orders")
    train = o.where(F.col("o_orderdate") < F.lit(_TRAIN_CUTOFF).cast("timestamp_ntz"))
    stats = train.groupBy("o_custkey", "o_orderstatus").agg(F.avg("o_totalprice").alias("grp_mean"),
                                                            F.count(F.lit(1)).alias("grp_count"))
    m = train.agg(F.avg("o_totalprice")).first()[0]
    j = lookup_join(o.select("o_orderkey", "o_custkey", "o_orderstatus"), stats,
                    ["o_custkey", "o_orderstatus"], {"grp_mean": m, "grp_count": 0})
    return j.select("o_orderkey", F.round("grp_mean", R).alias("grp_mean"), "grp_count")


@register("group_count", """
SELECT o_orderkey, o_custkey, count(o_custkey) OVER (PARTITION BY o_custkey) AS group_size,
       CAST(count(o_custkey) OVER (PARTITION BY o_custkey) <= 1 AS INTEGER) AS group_size_alone FROM orders""")
def group_count(spark, sf):
    """Group size broadcast to rows (aggregate + join, skew-safe)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return W.group_count(o, ["o_custkey"], "o_custkey")


@register("group_stats", """
SELECT o_orderstatus, o_orderpriority, round(avg(o_totalprice), 6) AS mean_price, count(*) AS n_orders,
       round(sum(o_totalprice), 2) AS total_price, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def group_stats(spark, sf):
    """H1: named aggregates per (status, priority); money totals to the cent
    (a 6-decimal total of ~1e9 exceeds double precision, so summation order
    would show)."""
    o = table(spark, sf, "orders")
    g = A.group_stats(o, ["o_orderstatus", "o_orderpriority"],
                      {"mean_price": ("o_totalprice", "mean"), "n_orders": ("o_orderkey", "count"),
                       "total_price": ("o_totalprice", "sum"), "min_price": ("o_totalprice", "min"),
                       "max_price": ("o_totalprice", "max")})
    return g.select("o_orderstatus", "o_orderpriority", F.round("mean_price", R).alias("mean_price"), "n_orders",
                    F.round("total_price", 2).alias("total_price"), "min_price", "max_price")


@register("value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "events"), "event_type")


@register("crosstab", """
SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def crosstab(spark, sf):
    return A.value_counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("crosstab_wide", "SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{v}') AS \"{v}\"" for v in _PRIOS)
    + " FROM orders GROUP BY o_orderstatus")
def crosstab_wide(spark, sf):
    """H3 as a pivot: status x priority counts, one column per priority."""
    return A.crosstab_wide(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@register("histogram", """
WITH r AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 30 AS width FROM lineitem),
b AS (SELECT l_returnflag, CAST(least(floor((l_extendedprice - lo) / width), 29) AS INTEGER) AS bin, lo, width
      FROM lineitem, r)
SELECT l_returnflag, bin, lo + bin * width AS bin_lo, lo + (bin + 1) * width AS bin_hi, count(*) AS count
FROM b GROUP BY l_returnflag, bin, lo, width""")
def histogram(spark, sf):
    """H4: 30 equal-width bins of the price, per return flag."""
    return A.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30, ["l_returnflag"])


@register("box_summary", """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS med,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY o_orderpriority)
SELECT o_orderpriority, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       min(o_totalprice) FILTER (WHERE o_totalprice >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
       max(o_totalprice) FILTER (WHERE o_totalprice <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
       count(*) FILTER (WHERE o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS outliers
FROM orders JOIN q USING (o_orderpriority) GROUP BY o_orderpriority, q1, med, q3""")
def box_summary(spark, sf):
    b = A.box_summary(table(spark, sf, "orders"), "o_totalprice", ["o_orderpriority"])
    return b.select("o_orderpriority", *[F.round(c, R).alias(c) for c in ("q1", "median", "q3")],
                    "whisker_lo", "whisker_hi", "outliers")


def _corr_sql():
    parts = []
    for i, a in enumerate(_LI_NUM):
        for b in _LI_NUM[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) "
                         f"AS corr FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix", _corr_sql())
def corr_matrix(spark, sf):
    c = A.correlation_pairs(table(spark, sf, "lineitem"), _LI_NUM)
    return c.select("col_a", "col_b", F.round("corr", R).alias("corr"))


@register("corr_topk", "SELECT column_name, round(corr, 6) AS corr FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, corr(CAST({c} AS DOUBLE), l_extendedprice) AS corr FROM lineitem"
    for c in _LI_NUM if c != "l_extendedprice") + ") ORDER BY abs(corr) DESC, column_name LIMIT 10")
def corr_topk(spark, sf):
    c = A.correlation_with(table(spark, sf, "lineitem"), "l_extendedprice", _LI_NUM, top=10)
    return c.select("column_name", F.round("corr", R).alias("corr"))


@register("distinct_sorted", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL ORDER BY p_type")
def distinct_sorted(spark, sf):
    return A.distinct_sorted(table(spark, sf, "part"), "p_type")


@register("loo_encode", """
WITH lab AS (SELECT d.doc_id, d.lang, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)),
st AS (SELECT lang, source, count(quality) AS n, CAST(sum(quality) AS DOUBLE) AS s FROM lab GROUP BY lang, source)
SELECT doc_id, round(least(greatest(CASE WHEN n > 1 THEN (s - quality) / (n - 1) ELSE 0.5 END, 0.0), 1.0), 6) AS loo_rate,
       n AS group_count FROM lab JOIN st USING (lang, source)
UNION ALL
SELECT d.doc_id, round(coalesce(s / n, 0.5), 6) AS loo_rate, coalesce(n, 1) AS group_count
FROM documents d LEFT JOIN st USING (lang, source) WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""")
def loo_encode(spark, sf):
    """Leave-one-out quality rate per (lang, source)."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    lab = docs.join(labels, "doc_id")
    un = docs.join(labels, "doc_id", "left_anti")
    out = W.loo_target_rate(lab, un, ["lang", "source"], "quality")
    return out.select("doc_id", F.round("loo_rate", R).alias("loo_rate"), "group_count")


@register("quantile_bins_rank", """
SELECT p_partkey, p_retailprice, CAST(greatest(ceil((r - 1) * 4.0 / (n - 1)), 1) - 1 AS INTEGER) AS rank_bin
FROM (SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS r,
             count(*) OVER () AS n FROM part)""")
def quantile_bins_rank(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return W.rank_quantile_bins(p, "p_retailprice", 4, ["p_partkey"])


@register("quantile_bins", """
WITH e AS (SELECT quantile_cont(c_acctbal, [0, 0.25, 0.5, 0.75, 1]) AS q FROM customer)
SELECT c_custkey, c_acctbal,
  CASE WHEN c_acctbal >= q[1] AND c_acctbal <= q[2] THEN 'q1' WHEN c_acctbal > q[2] AND c_acctbal <= q[3] THEN 'q2'
       WHEN c_acctbal > q[3] AND c_acctbal <= q[4] THEN 'q3' WHEN c_acctbal > q[4] AND c_acctbal <= q[5] THEN 'q4'
  END AS quantile_bin
FROM customer, e""")
def quantile_bins(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return W.quantile_bins(c, "c_acctbal", 4, ["q1", "q2", "q3", "q4"])


@register("topk", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk(spark, sf):
    """Top 10 by price with a total order (a top-k report)."""
    return table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).limit(10)


_THRESHOLDS = [100000, 150000, 200000, 250000, 300000, 350000, 400000]
_TARGET_RATE = 0.383


@register("closest_to_target", f"""
WITH r AS (SELECT t AS threshold, (SELECT count(*) FILTER (WHERE o_totalprice > t) / count(*) FROM orders) AS rate
           FROM (SELECT unnest({_THRESHOLDS}) AS t))
SELECT threshold, round(rate, 6) AS positive_rate FROM r ORDER BY abs(rate - {_TARGET_RATE}), threshold LIMIT 1""")
def closest_to_target(spark, sf):
    """The candidate threshold whose positive rate is closest to a target."""
    o = table(spark, sf, "orders")
    one = o.agg(F.count(F.lit(1)).alias("_n"),
                *[F.count_if(F.col("o_totalprice") > t).alias(f"t{t}") for t in _THRESHOLDS])
    cells = F.array(*[F.struct(F.lit(t).alias("threshold"), (F.col(f"t{t}") / F.col("_n")).alias("rate"))
                      for t in _THRESHOLDS])
    cand = one.select(F.inline(cells))
    best = cand.agg(F.min_by(F.struct("threshold", "rate"),
                             F.struct(F.abs(F.col("rate") - _TARGET_RATE), F.col("threshold"))).alias("b"))
    return best.select(F.col("b.threshold").alias("threshold"), F.round("b.rate", R).alias("positive_rate"))


@register("union_tagged", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment,
       'customer' AS src FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""")
def union_tagged_q(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                            F.col("c_nationkey").alias("nationkey"),
                                            F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                            F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return union_tagged({"customer": c, "supplier": s})
