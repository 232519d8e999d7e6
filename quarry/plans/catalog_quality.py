"""Registered queries: profiling and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile_state as PS
from ..operators import quality as Q
from ..operators.schema import constraint_violations
from ..session import scratch_path
from . import metrics
from .fixtures import DIRTY_CTE, dirty_orders
from .registry import register, table
from .sqlgen import (DIRTY_COLUMNS, DIRTY_DOUBLE, DIRTY_NUMERIC, iqr_sql, missing_sql,
                     ten_thousandths_sql, union_per_column, with_dirty)

R = 6  # decimals kept for float comparisons against the oracle


def _dirty(spark, sf):
    return dirty_orders(table(spark, sf, "orders"))


def _round_doubles(df, digits=R):
    return df.select(*[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


@register("profile_rows", "SELECT count(*) AS rows, CAST(6 AS INTEGER) AS columns FROM orders")
def profile_rows(spark, sf):
    return Q.profile_rows(table(spark, sf, "orders"))


_NULLS_SQL = with_dirty(union_per_column(
    DIRTY_COLUMNS, "CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM dirty")
    .replace("(WHERE amount IS NULL)", "(WHERE amount IS NULL OR isnan(amount))"))


@register("null_counts", _NULLS_SQL)
def null_counts(spark, sf):
    return Q.null_counts(_dirty(spark, sf))


@register("null_ranking", with_dirty(
    "SELECT * FROM (" + union_per_column(
        DIRTY_COLUMNS, "CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM dirty")
    .replace("(WHERE amount IS NULL)", "(WHERE amount IS NULL OR isnan(amount))")
    + ") ORDER BY nulls DESC, column_name LIMIT 20"))
def null_ranking(spark, sf):
    return Q.null_ranking(_dirty(spark, sf), 20)


@register("distinct_counts", union_per_column(
    ["o_orderstatus", "o_orderpriority"], "count(DISTINCT {c}) AS distinct FROM orders"))
def distinct_counts(spark, sf):
    return Q.distinct_counts(table(spark, sf, "orders"))


_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax"]


@register("numeric_stats", union_per_column(
    _LI_NUM, "round(min(CAST({c} AS DOUBLE)), 6) AS min, round(max(CAST({c} AS DOUBLE)), 6) AS max, "
             "round(avg(CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, "
             "CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM lineitem"))
def numeric_stats(spark, sf):
    return _round_doubles(Q.numeric_stats(table(spark, sf, "lineitem")))


@register("completeness", with_dirty(union_per_column(
    DIRTY_COLUMNS, ten_thousandths_sql("count(*) - count(*) FILTER (WHERE {c} IS NULL)") + " / 10000.0 AS completeness FROM dirty")
    .replace("(WHERE amount IS NULL)", "(WHERE amount IS NULL OR isnan(amount))")))
def completeness(spark, sf):
    return Q.completeness(_dirty(spark, sf))


_CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("uniqueness", union_per_column(
    _CUST, ten_thousandths_sql("count(DISTINCT {c})") + " / 10000.0 AS uniqueness FROM customer"))
def uniqueness(spark, sf):
    return Q.uniqueness(table(spark, sf, "customer"))


@register("iqr_outliers", iqr_sql("events", ["event_id", "user_id", "value"]))
def iqr_outliers(spark, sf):
    return Q.iqr_outliers(table(spark, sf, "events"))


_DUPS_SQL = with_dirty(
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
    "(SELECT count(*) AS n FROM dirty GROUP BY id, cust, status, priority, amount, age, date_text)")


@register("duplicate_rows", _DUPS_SQL)
def duplicate_rows(spark, sf):
    return Q.duplicate_rows(_dirty(spark, sf))


def _summary_sql(table_sql: str, cols, numeric, doubles, n_cols: int) -> str:
    comp = " + ".join(ten_thousandths_sql(f"count(*) - count(*) FILTER (WHERE {missing_sql(c, doubles)})") for c in cols)
    uniq = " + ".join(ten_thousandths_sql(f"count(DISTINCT {c})") for c in cols)
    group_cols = ", ".join(cols)
    return f"""
, base AS (SELECT {comp} AS sc, {uniq} AS su, count(*) AS rows FROM {table_sql}),
dups AS (SELECT coalesce(sum(n - 1), 0) AS d FROM (SELECT count(*) AS n FROM {table_sql} GROUP BY {group_cols})),
outl AS (SELECT coalesce(sum(outliers), 0) AS o FROM ({iqr_sql(table_sql, numeric)}))
SELECT 'ok' AS status, CAST(rows AS BIGINT) AS rows, CAST({n_cols} AS INTEGER) AS columns,
       CAST(d AS BIGINT) AS duplicate_rows, CAST(o AS BIGINT) AS outlier_total,
       round(sc / {10_000.0 * len(cols)}, 6) AS mean_completeness, round(su / {10_000.0 * len(cols)}, 6) AS mean_uniqueness,
       CAST((8 * sc + 4 * su + {100 * len(cols)}) // {200 * len(cols)} + 10 * (greatest(0, 20 - d * 2) + greatest(0, 20 - o)) AS DOUBLE)
         / 10 AS quality_score
FROM base, dups, outl"""


@register("quality_score", "WITH " + DIRTY_CTE + _summary_sql("dirty", DIRTY_COLUMNS, DIRTY_NUMERIC, DIRTY_DOUBLE, 7))
def quality_score(spark, sf):
    s = Q.quality_summary(_dirty(spark, sf))
    return s.select("status", "rows", "columns", "duplicate_rows", "outlier_total",
                    F.round("mean_completeness", R).alias("mean_completeness"),
                    F.round("mean_uniqueness", R).alias("mean_uniqueness"), "quality_score")


_CUST_NUM = ["c_custkey", "c_nationkey", "c_acctbal"]


def _report_sql() -> str:
    parts = [union_per_column(_CUST, ten_thousandths_sql("count(*) - count(*) FILTER (WHERE {c} IS NULL)") + " / 10000.0 "
                                     "AS value, 'completeness' AS metric FROM customer"),
             union_per_column(_CUST, ten_thousandths_sql("count(DISTINCT {c})") + " / 10000.0 AS value, "
                                     "'uniqueness' AS metric FROM customer"),
             f"SELECT column_name, CAST(outliers AS DOUBLE) AS value, 'outliers' AS metric FROM ({iqr_sql('customer', _CUST_NUM)})"]
    for m, e in (("min", "min(CAST({c} AS DOUBLE))"), ("max", "max(CAST({c} AS DOUBLE))"),
                 ("mean", "avg(CAST({c} AS DOUBLE))"), ("std", "stddev_samp(CAST({c} AS DOUBLE))"),
                 ("nulls", "CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)")):
        parts.append(union_per_column(_CUST_NUM, f"round({e}, 6) AS value, '{m}' AS metric FROM customer"))
    long = "\nUNION ALL\n".join(f"SELECT column_name AS scope, metric, value FROM ({p})" for p in parts)
    summ = _summary_sql("customer", _CUST, _CUST_NUM, [], 5)
    return ("WITH s0 AS (SELECT 1)" + summ.replace("SELECT 'ok' AS status", ", summ AS (SELECT 'ok' AS status", 1)
            + ")\n" + long + "\nUNION ALL SELECT '_table', 'rows', CAST(rows AS DOUBLE) FROM summ"
            + "\nUNION ALL SELECT '_table', 'columns', CAST(columns AS DOUBLE) FROM summ"
            + "\nUNION ALL SELECT '_table', 'duplicate_rows', CAST(duplicate_rows AS DOUBLE) FROM summ"
            + "\nUNION ALL SELECT '_table', 'quality_score', quality_score FROM summ")


@register("quality_report", _report_sql())
def quality_report(spark, sf):
    r = Q.quality_report(table(spark, sf, "customer"))
    return r.select("scope", "metric", F.round("value", R).alias("value"))


# Columns of the given tables; a star marks numeric ones, an exclamation mark doubles.
_TABLES = {
    "benchmark": "item_id* text", "conversations": "conv_id* turn* role text",
    "customer": "c_custkey* c_name c_nationkey* c_acctbal! c_mktsegment", "documents": "doc_id* text lang source n_chars*",
    "embeddings": "vec_id* embedding label*", "events": "event_id* ts user_id* event_type value! props", "labels": "doc_id* quality* toxic*",
    "lineitem": "l_orderkey* l_partkey* l_suppkey* l_linenumber* l_quantity! l_extendedprice! l_discount! l_tax! "
                "l_returnflag l_linestatus l_shipdate",
    "nation": "n_nationkey* n_name n_regionkey*", "orders": "o_orderkey* o_custkey* o_orderstatus o_totalprice! o_orderdate o_orderpriority",
    "pages": "page_id* url html", "part": "p_partkey* p_name p_brand p_type p_size* p_retailprice!", "region": "r_regionkey* r_name",
    "supplier": "s_suppkey* s_name s_nationkey* s_acctbal!",
}


def _sweep_sql() -> str:
    parts = []
    for name, listed in _TABLES.items():
        marked = listed.split()
        cols = [c.rstrip("*!") for c in marked]
        numeric, doubles = [c[:-1] for c in marked if c[-1] in "*!"], [c[:-1] for c in marked if c[-1] == "!"]
        body = _summary_sql(name, cols, numeric, doubles, len(cols)).strip().lstrip(",").strip()
        head, _, tail = body.rpartition("\nSELECT 'ok'")
        parts.append(f"SELECT * FROM (WITH {head}\nSELECT '{name}.parquet' AS source, 'ok'{tail})")
    return "\nUNION ALL\n".join(parts)


@register("quality_sweep", _sweep_sql())
def quality_sweep(spark, sf):
    """Quality summary of every Parquet table in the folder.  Files are
    listed by Spark (file metadata only) and grouped by schema; each schema
    group is summarised by table in one go."""
    from ..sources.readers import list_files, schema_groups
    out = None
    for paths in schema_groups(spark, list_files(spark, sf, "*.parquet")):
        name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.parquet)(/part[^/]*)?$", 1)
        df = spark.read.parquet(*paths)
        # a column of the table may be called source, too
        df = df.select(*[F.col(c).alias(f"{c}_") for c in df.columns], name.alias("source"))
        one = Q.quality_by(df, "source")
        out = one if out is None else out.unionByName(one)
    return out.select("source", "status", "rows", "columns", "duplicate_rows", "outlier_total",
                      F.round("mean_completeness", R).alias("mean_completeness"),
                      F.round("mean_uniqueness", R).alias("mean_uniqueness"), "quality_score")


@register("run_metrics", with_dirty(
    "SELECT CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_out, CAST(sum(n - 1) AS BIGINT) AS duplicates, "
    "CAST(sum(miss) AS BIGINT) AS null_filled, round(count(*) * 100.0 / sum(n), 2) AS yield_pct FROM ("
    "SELECT count(*) AS n, max((id IS NULL)::INT + (cust IS NULL)::INT + (status IS NULL)::INT + "
    "(priority IS NULL)::INT + (amount IS NULL OR isnan(amount))::INT + (age IS NULL)::INT + "
    "(date_text IS NULL)::INT) AS miss FROM dirty GROUP BY id, cust, status, priority, amount, age, date_text)"))
def run_metrics(spark, sf):
    return metrics.run_metrics(_dirty(spark, sf))


@register("constraint_violations", """
SELECT CAST(count(*) FILTER (WHERE l_quantity < 1) AS BIGINT) AS l_quantity_below_min,
       CAST(count(*) FILTER (WHERE l_quantity > 49) AS BIGINT) AS l_quantity_above_max,
       CAST(count(*) FILTER (WHERE l_discount < 0.01) AS BIGINT) AS l_discount_below_min,
       CAST(count(*) FILTER (WHERE l_discount > 0.09) AS BIGINT) AS l_discount_above_max,
       CAST(count(*) FILTER (WHERE l_tax IS NULL) AS BIGINT) AS l_tax_nulls,
       CAST(count(*) FILTER (WHERE l_returnflag IS NULL) AS BIGINT) AS l_returnflag_nulls
FROM lineitem""")
def constraint_violations_q(spark, sf):
    li = table(spark, sf, "lineitem")
    spec = {"l_quantity": {"dtype": "float64", "min": 1, "max": 49},
            "l_discount": {"dtype": "float64", "min": 0.01, "max": 0.09},
            "l_tax": {"dtype": "float64", "nullable": False},
            "l_returnflag": {"dtype": "object", "nullable": False}}
    return constraint_violations(li, spec)


_LI_TEXT = ["l_returnflag", "l_linestatus", "l_shipdate"]


@register("profile_merge", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
    + (f"min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max, round(avg(CAST({c} AS DOUBLE)), 4) AS mean" if c in _LI_NUM else "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)")
    + ", TRUE AS distinct_close, TRUE AS median_close FROM lineitem" for c in _LI_NUM + _LI_TEXT))
def profile_merge(spark, sf):
    """Sketches of each file, merged; the second of two drops is
    profiled by itself.  Estimates are held against the exact counts."""
    li = table(spark, sf, "lineitem")
    folder, state = scratch_path(spark, "lineitem-drops"), PS.ProfileState(scratch_path(spark, "lineitem-profile"))
    for part in (F.col("l_linenumber") <= 3, F.col("l_linenumber") > 3):
        li.where(part).write.mode("append").parquet(folder)
        state.refresh(spark, folder)
    got = state.profile(spark).where(F.col("column_name") != PS.ROW)
    exact = Q.distinct_counts(li, _LI_NUM + _LI_TEXT).withColumnRenamed("distinct", "exact")
    # the rank that the estimated median has among the rows
    medians = {r["column_name"]: r["median"] for r in got.select("column_name", "median").collect() if r["median"] is not None}
    below = li.agg(*[F.struct(F.avg((F.col(c) < m).cast("int")), F.avg((F.col(c) <= m).cast("int"))).alias(c) for c, m in medians.items()]).first()
    close = {c: below[c][0] - PS.RANK_ERROR <= 0.5 <= below[c][1] + PS.RANK_ERROR for c in medians}
    good = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in close.items() for x in pair]), F.col("column_name")), F.lit(True))
    return got.join(F.broadcast(exact), "column_name").select(
        "column_name", "rows", "nulls", "min", "max", F.round("mean", 4).alias("mean"),
        (F.abs(F.col("distinct") - F.col("exact")) <= PS.DISTINCT_ERROR * F.col("exact") + 0.5).alias("distinct_close"), good.alias("median_close"))
