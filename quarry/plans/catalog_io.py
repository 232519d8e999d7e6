"""Registered queries: sources and sinks (A, B, L3, L4, L6, L8).

Round trips write scratch files under the shared checkpoint folder and read
them back, so each check covers the writer and the reader.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from ..operators.snapshot import SnapshotTable
from ..operators.upsert import incremental_append, upsert_latest
from ..session import scratch_path
from ..sources import readers as RD
from ..sources import sinks as SK
from ..functions.nested import nested
from ..sources.records import page_records, typed_records
from ..sources.paged import explode_records, file_pages, read_pages
from .registry import register, table

_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("src_parquet", "SELECT * FROM lineitem")
def src_parquet(spark, sf):
    """Format detected from the extension, merged-schema read."""
    return RD.read_table(spark, f"{sf}/lineitem.parquet")


@register("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark, sf):
    """CSV write with header, read back with the fixed schema."""
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "orders") + ".csv"
    SK.write_by_suffix(o, path)
    back = RD.read_table(spark, path, schema=o.schema)
    return RD.drop_corrupt(back)


@register("json_roundtrip", "SELECT * FROM events")
def json_roundtrip(spark, sf):
    """A5: JSON-lines write (gzip) and read back with the fixed schema."""
    e = table(spark, sf, "events")
    path = scratch_path(spark, "events") + ".jsonl"
    SK.write_table(e, path, "json")
    return RD.drop_corrupt(RD.read_table(spark, path, schema=e.schema))


@register("orc_roundtrip", "SELECT * FROM part")
def orc_roundtrip(spark, sf):
    """ORC (zlib) round trip."""
    p = table(spark, sf, "part")
    path = scratch_path(spark, "part") + ".orc"
    SK.write_table(p, path, "orc")
    return RD.read_table(spark, path)


def _split_lineitem(spark, sf, rest_format="parquet"):
    """Write lineitem in two parts: line 1 without ``l_tax`` (Parquet) and
    all other lines (``rest_format``).  Returns the two paths."""
    li = table(spark, sf, "lineitem")
    base = scratch_path(spark, "lineitem-split")
    first = f"{base}/line1.parquet"
    rest = f"{base}/rest.{rest_format}"
    SK.write_table(li.where(F.col("l_linenumber") == 1).drop("l_tax"), first, "parquet")
    SK.write_table(li.where(F.col("l_linenumber") != 1), rest, rest_format)
    return [first, rest]


@register("schema_merge_read", "SELECT " + ", ".join(
    c if c != "l_tax" else "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS l_tax" for c in _LI_COLS)
    + " FROM lineitem")
def schema_merge_read(spark, sf):
    """A4: Parquet files with differing columns read as one merged schema."""
    paths = _split_lineitem(spark, sf)
    return RD.read_table(spark, paths).select(*_LI_COLS)


@register("multi_file_union", "SELECT " + ", ".join(
    c if c != "l_tax" else "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS l_tax" for c in _LI_COLS)
    + " FROM lineitem")
def multi_file_union(spark, sf):
    """Inputs of three formats and schemas into one table; the CSV
    files have their columns in different orders and other separators."""
    paths = _split_lineitem(spark, sf, rest_format="orc")
    rest = table(spark, sf, "lineitem").where(F.col("l_linenumber") > 4)
    orc = scratch_path(spark, "lineitem-low") + ".orc"
    RD.read_table(spark, paths[1]).where(F.col("l_linenumber") <= 4).write.orc(orc)
    names = [scratch_path(spark, f"lineitem-{i}") + ".csv" for i in range(2)]
    for name, odd, cols, sep in ((names[0], 0, _LI_COLS, ","), (names[1], 1, _LI_COLS[::-1], ";")):
        part = rest.where(F.col("l_orderkey") % 2 == odd).select(*cols)
        part.write.option("header", "true").option("sep", sep).options(**SK.TEXT_TIME_OPTIONS).csv(name)
    out = RD.read_many(spark, [paths[0], orc, *names])
    kinds = dict(table(spark, sf, "lineitem").dtypes)
    return out.select(*[F.col(c).cast(kinds[c]).alias(c) for c in _LI_COLS])


@register("files_processed", "SELECT count(DISTINCT l_linenumber) AS splits_read, count(*) AS input_rows FROM lineitem")
def files_processed(spark, sf):
    """Input lineage from file metadata (distinct split folders read)."""
    path = scratch_path(spark, "lineitem-by-line")
    SK.write_table(table(spark, sf, "lineitem"), path, "parquet", partition_by=["l_linenumber"])
    df = RD.with_source_file(RD.read_table(spark, path))
    split = F.regexp_extract("_source_file", r"l_linenumber=(\d+)", 1)
    return df.agg(F.count_distinct(split).alias("splits_read"), F.count(F.lit(1)).alias("input_rows"))


@register("json_path_explode", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_path_explode(spark, sf):
    """Walk a results path inside a JSON column; scalars wrap to one record."""
    e = table(spark, sf, "events").select("event_id", "props")
    return explode_records(e, "bigint", "k", body_col="props", keep=("event_id",)).withColumnRenamed("_rec", "k")


@register("paged_json_source", """
SELECT CAST(floor(event_id / 500) + 1 AS INTEGER) AS page, event_id, ts, user_id, event_type, value FROM events""")
def paged_json_source(spark, sf):
    """A10: events served as JSON pages of 500 records (page files in a fresh
    scratch folder), extracted in parallel and exploded back into rows."""
    e = table(spark, sf, "events")
    folder = scratch_path(spark, "pages")
    # Page files are the test's stand-in for an API: one JSON document per page.
    paged = e.withColumn("_page", (F.floor(F.col("event_id") / 500) + 1).cast("int"))
    docs = paged.groupBy("_page").agg(F.to_json(F.struct(F.collect_list(F.struct(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value")).alias("results")))
        .alias("body"))
    # One row per page, hash-partitioned by page: each page folder gets one file.
    docs.repartition("_page").write.partitionBy("_page").text(folder)
    pages = read_pages(spark, file_pages(folder, "_page={page}"), page_size=500, pagination="page",
                       results_path="results", pages_per_partition=4)
    schema = "event_id bigint, ts string, user_id bigint, event_type string, value double"
    recs = explode_records(pages, schema, "results", keep=("page",))
    return recs.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("api_record_union", """
SELECT CAST(floor(event_id / 500) + 1 AS INTEGER) AS page, event_id AS id,
       CASE WHEN event_id % 3 = 1 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS v,
       CASE WHEN event_id % 3 = 1 THEN value END AS extra, CASE WHEN event_id % 3 = 2 THEN event_type END AS kind,
       CASE WHEN event_id % 3 = 2 THEN user_id END AS number, CASE WHEN event_id % 3 = 2 THEN CAST(user_id AS VARCHAR) END AS second_tag
FROM events""")
def api_record_union(spark, sf):
    """Records of pages whose fields and types differ from record to
    record; the type is merged over all of them."""
    e, kind = table(spark, sf, "events"), F.col("event_id") % 3
    named = F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("number"))
    record = (F.when(kind == 0, F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("v"))))
              .when(kind == 1, F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("v"), F.col("value").alias("extra"))))
              .otherwise(F.concat(F.regexp_replace(F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("v"), named.alias("info"))), "}$", ""),
                                  F.lit(',"tags":["'), F.col("event_type"), F.lit('",'), F.col("user_id"), F.lit("]}"))))
    page = (F.floor(F.col("event_id") / 500) + 1).cast("int").alias("page")
    pages = e.select(page, record.alias("r")).groupBy("page").agg(
        F.concat(F.lit('{"data":{"results":['), F.array_join(F.collect_list("r"), ","), F.lit("]}}")).alias("body"))
    out = typed_records(page_records(pages, "data.results", keep=("page",)), keep=("page",)).rows
    return out.select("page", "id", "v", "extra", nested(out, "info.kind").alias("kind"), nested(out, "info.number").alias("number"),
                      nested(out, "tags.1").alias("second_tag"))


@register("nested_paths", """
SELECT event_id, event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_type = 'click' THEN value END AS clicked,
       user_id + user_id + 1 AS both_users, CAST(json_extract(props, '$.k') AS BIGINT) AS every_k, CAST(NULL AS BIGINT) AS missing
FROM events""")
def nested_paths(spark, sf):
    """Dotted paths into structs, maps, arrays and VARIANT values."""
    e = table(spark, sf, "events")
    users = F.array(*[F.struct((F.col("user_id") + i).alias("id")) for i in range(2)])
    df = e.select("event_id", F.struct(F.struct(F.col("event_type").alias("kind")).alias("tag"), users.alias("users")).alias("who"),
                  F.create_map("event_type", "value").alias("by_type"),
                  F.try_parse_json(F.concat(F.lit('{"a.b":{"x":'), F.col("props"), F.lit("}}"))).alias("doc"))
    total = F.aggregate(nested(df, "who.users.*.id"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    every = F.aggregate(nested(df, "doc.`a.b`.*.k", "array<bigint>"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df.select("event_id", nested(df, "who.tag.kind").alias("kind"), nested(df, "doc.`a.b`.x.k", "bigint").alias("k"),
                     nested(df, "by_type.click").alias("clicked"), total.alias("both_users"), every.alias("every_k"),
                     nested(df, "who.tag.none", "bigint").alias("missing"))


def _dated_orders(spark, sf):
    o = table(spark, sf, "orders")
    return o.withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate"))


@register("partitioned_write", """
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""")
def partitioned_write(spark, sf):
    """B2: Hive-partitioned by year/month, read back with partition columns."""
    path = scratch_path(spark, "orders-by-month")
    SK.write_table(_dated_orders(spark, sf), path, "parquet", partition_by=["year", "month"])
    return spark.read.parquet(path)


@register("dyn_overwrite", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""")
def dyn_overwrite(spark, sf):
    """Overwrite only the partitions present in the new data (1996)."""
    path = scratch_path(spark, "orders-dyn")
    d = _dated_orders(spark, sf)
    SK.write_table(d, path, "parquet", partition_by=["year", "month"])
    redo = d.where(F.col("year") == 1996).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    SK.write_table(redo, path, "parquet", mode="overwrite", partition_by=["year", "month"])
    return spark.read.parquet(path)


@register("load_stats", """
SELECT rows, count(*) AS runs, TRUE AS partitions_known FROM (SELECT count(*) AS rows FROM orders), range(2) GROUP BY rows""")
def load_stats(spark, sf):
    """Per-run load statistics of two runs of a load, kept in a table
    apart from the output."""
    from .spark_etl import SparkETLJob
    out, stats = scratch_path(spark, "orders-out"), scratch_path(spark, "load-stats")
    for _ in range(2):
        job = SparkETLJob(spark, {"output": out, "load_stats_table": True, "load_stats_path": stats})
        job.load(table(job.spark, sf, "orders"))
    rows = spark.read.parquet(stats)
    return rows.groupBy("rows").agg(F.count(F.lit(1)).alias("runs"), F.min(F.coalesce(
        F.col("partitions") >= 1, F.lit(False))).alias("partitions_known"))


@register("bucketed_write", "SELECT * FROM orders")
def bucketed_write(spark, sf):
    """Bucketed by customer key (external table in scratch), read back."""
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "orders-bucketed")
    name = "quarry_orders_bucketed_" + os.path.basename(path).replace("-", "_")
    SK.write_bucketed(o, name, path, 8, ["o_custkey"], ["o_custkey"])
    return spark.table(name)


_UPSERT_SQL = """
WITH t AS (SELECT *, 0 AS version FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
u AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority,
             1 AS version FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
a AS (SELECT * FROM t UNION ALL SELECT * FROM u)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, version FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn FROM a) WHERE rn = 1"""


@register("upsert_latest", _UPSERT_SQL)
def upsert_latest_q(spark, sf):
    """L3: upsert of a later batch into a snapshot; latest version per key
    wins; the result is written to a new snapshot path and read back."""
    o = table(spark, sf, "orders")
    target = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).withColumn("version", F.lit(0))
    updates = (o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
               .withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("version", F.lit(1)))
    merged = upsert_latest(target, updates, ["o_orderkey"], "version")
    path = scratch_path(spark, "orders-snapshot")
    merged.write.parquet(path)
    return spark.read.parquet(path)


@register("snapshot_upsert", _UPSERT_SQL)
def snapshot_upsert(spark, sf):
    """L3: the same upsert, copy-on-write: only files that hold an updated
    key are rewritten, the manifest is swapped last."""
    o = table(spark, sf, "orders")
    target = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).withColumn("version", F.lit(0))
    updates = (o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
               .withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("version", F.lit(1)))
    snapshot = SnapshotTable(scratch_path(spark, "orders-table"), ["o_orderkey"])
    snapshot.create(target)
    snapshot.upsert(updates, "version")
    return snapshot.read(spark)


@register("ledger_load", "SELECT * FROM orders WHERE o_orderkey % 7 <> 0")
def ledger_load(spark, sf):
    """L4: three drops of source files, the last with late rows and rows that
    the table has; loaded files and watermark ranges are in the ledger."""
    o = table(spark, sf, "orders").where(F.col("o_orderkey") % 7 != 0)
    folder, target = scratch_path(spark, "orders-drops"), SnapshotTable(scratch_path(spark, "orders-ledger"), ["o_orderkey"], "o_orderdate")
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    on_time, date = F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")
    for drop in (o.where((date < day("1996-01-01")) & on_time), o.where((date >= day("1996-01-01")) & on_time),
                 o.where(~on_time | (date >= day("1998-01-01")))):
        drop.write.mode("append").parquet(folder)
        target.load_files(spark, folder)
        target.load_files(spark, folder)  # nothing is new: no effect
    return target.read(spark)


_DATED = "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate"


@register("incremental_load", f"SELECT * REPLACE ({_DATED}) FROM orders")
def incremental_load(spark, sf):
    """L4: first load up to a watermark, then append what is missing: rows
    past it, every fifth row that came late, and rows without a date."""
    o = table(spark, sf, "orders")
    o = o.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate"))).select(*o.columns)
    path = scratch_path(spark, "orders-incr")
    mark = F.lit("1998-06-01").cast("timestamp_ntz")
    early = (F.col("o_orderdate") <= mark) | (F.col("o_orderdate").isNull() & (F.col("o_orderkey") % 2 == 0))
    o.where(early & (F.col("o_orderkey") % 5 != 0)).write.parquet(path)
    incremental_append(o, path, "o_orderdate", keys=["o_orderkey"])
    return spark.read.parquet(path)


@register("etl_enrich_aggregate", """
SELECT p_type, count(*) AS n_lines, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
       round(avg(l_quantity), 6) AS avg_qty
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def etl_enrich_aggregate(spark, sf):
    """Enrich (lookup join) then aggregate."""
    from ..plans.spark_etl import enrich, aggregate
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part")
    e = enrich(li, part, {"left_on": "l_partkey", "right_on": "p_partkey", "columns": ["p_type"]})
    a = aggregate(e, {"by": ["p_type"], "aggs": {"n_lines": ["*", "count"],
                                                  "revenue": ["l_extendedprice * (1 - l_discount)", "sum"],
                                                  "avg_qty": ["l_quantity", "mean"]}})
    # Money total to the cent (beyond that, float summation order shows).
    return a.select("p_type", "n_lines", F.round("revenue", 2).alias("revenue"), F.round("avg_qty", 6).alias("avg_qty"))


@register("corrupt_drop", "SELECT " + ", ".join(_LI_COLS) + " FROM lineitem WHERE l_linenumber <> 7")
def corrupt_drop(spark, sf):
    """CSV text where every line-7 record has a malformed quantity; read
    with the fixed schema (PERMISSIVE + corrupt column), malformed dropped."""
    li = table(spark, sf, "lineitem")
    qty = F.when(F.col("l_linenumber") == 7, F.lit("x7")).otherwise(F.col("l_quantity").cast("string"))
    ts = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = [F.col(c).cast("string") if c not in ("l_quantity", "l_shipdate") else (qty if c == "l_quantity" else ts)
              for c in _LI_COLS]
    path = scratch_path(spark, "lineitem-dirty") + ".csv"
    li.select(F.concat_ws(",", *fields).alias("value")).write.text(path)
    back = RD.read_table(spark, path, schema=li.schema, reader_options={"header": "false"})
    return RD.drop_corrupt(back).select(*_LI_COLS)


# Fixed run identity for the job check (a replayed run).
_JOB_RUN_CLOCK = "1704067200.0"
_JOB_LOADED_AT = "2024-01-01 00:00:00"


def _job_config(inp, out, stats):
    """A job over the dirty orders: the row of a repeated order that has the
    later date text stays; ages in three classes; folders by year."""
    return {
        "input": inp, "output": out, "partition_by": ["year"], "dedup_keys": ["id"], "dedup_order_by": ["date_text"],
        "expected_columns": ["id", "cust", "status", "date_text"],
        "transform": {"add_date_parts": True, "categorize": {
            "age": {"junior": {"rules": [{"lt": 30}]}, "regular": {"rules": [{"between": [30, 60]}]},
                    "senior": {"rules": [{"between": [60, 200]}]}}}},
        "load_stats_table": True, "load_stats_path": stats, "loaded_at": _JOB_LOADED_AT,
    }


def _job_sql():
    from .fixtures import DIRTY_CTE
    from ..operators.features import batch_id_for
    return f"""
WITH {DIRTY_CTE},
dd AS (SELECT DISTINCT * FROM dirty),
s AS (SELECT id, cust, coalesce(nullif(trim(status), ''), 'Unknown') AS status,
             coalesce(nullif(trim(priority), ''), 'Unknown') AS priority, amount, age,
             TRY_CAST(date_text AS TIMESTAMP) AS date_text FROM dd),
m AS (SELECT median(amount) AS ma, median(age) AS mg FROM s),
f AS (SELECT id, cust, status, priority, coalesce(amount, ma) AS amount,
             coalesce(age, CAST(round_even(mg, 0) AS INTEGER)) AS age, date_text FROM s, m)
SELECT id, cust, status, priority, amount, age, date_text,
       CAST(year(date_text) AS INTEGER) AS date_text_year, CAST(month(date_text) AS INTEGER) AS date_text_month,
       CASE WHEN age IS NULL THEN NULL WHEN age < 30 THEN 'junior' WHEN age >= 30 AND age < 60 THEN 'regular'
            WHEN age >= 60 AND age < 200 THEN 'senior' END AS age_category,
       TIMESTAMP '{_JOB_LOADED_AT}' AS _etl_loaded_at, '{batch_id_for(_JOB_RUN_CLOCK, 12)}' AS _etl_batch_id,
       CAST(year(date_text) AS INTEGER) AS year
FROM f"""


@register("spark_etl_job", _job_sql())
def spark_etl_job(spark, sf):
    """§3.1 end to end: the dirty orders as the
    input folder -> profile -> validate -> dedup -> transform -> partitioned
    load (+ load stats); the output folder read back (row hash left out:
    it covers doubles, whose text differs between engines)."""
    from .fixtures import dirty_orders
    from .spark_etl import SparkETLJob
    inp = scratch_path(spark, "etl-in")
    dirty_orders(table(spark, sf, "orders")).write.parquet(inp)
    out = scratch_path(spark, "etl-out")
    job = SparkETLJob(spark, _job_config(inp, out, scratch_path(spark, "etl-stats")), run_clock=_JOB_RUN_CLOCK)
    job.run()
    return spark.read.parquet(out).drop("_record_hash")
