"""Sources, sinks, config jobs, streaming and plan-shape checks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quarry.plans.spark_etl import SparkETLJob, recommended_conf
from quarry.sources import readers as RD
from quarry.sources import sinks as SK
from quarry.sources.paged import explode_records, file_pages, read_pages

SF = "/root/testdata/sf0.001"


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_spark_etl_job_end_to_end(spark, tmpdir_path):
    src = _write(os.path.join(tmpdir_path, "orders.csv"),
                 "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate\n"
                 "7,70, O ,1200.5,1997-03-02 08:00:00\n"
                 "8,71,F,90000,1997-04-01 00:00:00\n"
                 "8,71,F,91000,1997-04-02 00:00:00\n"
                 "9,72,,700,1998-01-09 00:00:00\n"
                 "10,73,P,,no date\n")
    with open(os.path.join(os.path.dirname(__file__), "..", "configs", "spark_etl.json")) as f:
        cfg = json.load(f)
    out = os.path.join(tmpdir_path, "out")
    cfg.update({"input": src, "output": out, "load_stats_path": os.path.join(tmpdir_path, "stats"),
                "loaded_at": "2024-03-01 00:00:00"})
    rep = SparkETLJob(spark, cfg, run_clock="1").run()
    assert rep["ingest.rows"] == 5 and rep["load.rows"] == 4 and rep["duplicates"] == 1
    assert rep["yield_pct"] == 80.0 and rep["files_processed"] == 1 and rep["partitions"] >= 1
    res = spark.read.parquet(out)
    assert {"year", "month", "o_totalprice_category", "_record_hash", "_etl_batch_id"} <= set(res.columns)
    rows = {r["o_orderkey"]: r for r in res.collect()}
    assert rows[7]["o_orderstatus"] == "O" and rows[9]["o_orderstatus"] == "Unknown"
    assert rows[8]["o_totalprice"] == 91000 and rows[8]["o_totalprice_category"] == "large"  # the later row of the key
    assert rows[7]["o_totalprice_category"] == "small"
    assert rows[10]["o_totalprice"] == 1200.5  # median of 700, 1200.5, 91000
    assert rows[10]["o_orderdate"] is None and rows[10]["year"] is None
    assert spark.read.parquet(cfg["load_stats_path"]).first()["partitions"] == rep["partitions"]
    merged = recommended_conf({"spark_conf": {"spark.sql.shuffle.partitions": 9}})
    assert merged["spark.sql.shuffle.partitions"] == "9" and len(merged) == 2


def test_csv_dialect_and_corrupt_rows(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "semi.csv"), "﻿a;b\n1;x\n2;y\nz;w\n")
    d = RD.detect_csv_dialect(spark, p)
    assert d["sep"] == ";"
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("a", LongType()), StructField("b", StringType())])
    df = RD.read_table(spark, p, schema=schema, reader_options={"sep": ";"})
    assert RD.corrupt_count(df) == 1
    kept = RD.drop_corrupt(df)
    assert kept.count() == 2 and len(kept.select("b").collect()) == 2 and len(kept.collect()) == 2


def test_load_schema_forms(tmpdir_path):
    fields = [{"name": "a", "type": "long"}, {"name": "b"}]
    lst = RD.load_schema(fields)
    assert [f.dataType.simpleString() for f in lst.fields] == ["bigint", "string"]
    assert RD.load_schema(lst.jsonValue()) == RD.load_schema(lst) == lst
    assert RD.load_schema(_write(os.path.join(tmpdir_path, "s.json"), json.dumps(fields))) == lst


def _pages(folder, sizes, key="results"):
    os.makedirs(folder, exist_ok=True)
    n = 0
    for i, s in enumerate(sizes, start=1):
        recs = [{"id": n + j} for j in range(s)]
        n += s
        _write(os.path.join(folder, f"page-{i}.json"), json.dumps({key: recs}))


def test_paged_source_finds_last_page(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "pages")
    _pages(folder, [10] * 12 + [3])
    pages = read_pages(spark, file_pages(folder), page_size=10, pagination="page", results_path="results")
    assert pages.count() == 13
    recs = explode_records(pages, "id bigint", "results")
    assert recs.count() == 123 and recs.agg(F.count_distinct("id")).first()[0] == 123
    ranged = read_pages(spark, file_pages(folder), page_size=10, pagination="page", pages_per_partition=4)
    assert ranged.count() == 13 and ranged.rdd.getNumPartitions() == 4
    capped = read_pages(spark, file_pages(folder), page_size=10, pagination="page", max_pages=5,
                        results_path="results")
    assert capped.count() == 5
    single = read_pages(spark, file_pages(folder), pagination="none")
    assert single.count() == 1
    stated = os.path.join(tmpdir_path, "stated")
    os.makedirs(stated)
    for i in range(1, 5):  # page 4 exists but the API says there are 3
        _write(os.path.join(stated, f"page-{i}.json"), json.dumps({"total_pages": 3, "results": [{"id": i}]}))
    assert read_pages(spark, file_pages(stated), total_pages_field="total_pages").count() == 3


def test_paged_source_errors(spark):
    def flaky(page, offset, size):
        if page == 2:
            raise IOError("boom")
        return json.dumps([{"id": page}]) if page <= 3 else None
    lenient = read_pages(spark, flaky, total_pages=3)
    assert lenient.where("status <> 'ok'").count() == 1
    with pytest.raises(Exception):
        read_pages(spark, flaky, total_pages=3, strict="true").collect()


def test_explode_scalar_and_missing(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": [1, 2]}}'), (2, '{"a": {"b": 7}}'), (3, '{"x": 1}')],
                               "id int, body string")
    got = sorted(tuple(r) for r in explode_records(df, "bigint", "a.b", keep=("id",)).collect())
    assert got == [(1, 1), (1, 2), (2, 7)]


def test_jdbc_append_with_schema_evolution(spark):
    # Embedded in-memory Derby: visible only inside this JVM (local mode).
    url = "jdbc:derby:memory:quarry_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, "y", 3.5)], "id int, name string, score double")
    assert SK.jdbc_append(a, url, "T1", props=props, batch_size=10) == []
    added = SK.jdbc_append(b, url, "T1", props=props, type_overrides={"string": "VARCHAR(255)"})
    assert added == ["score"]
    back = spark.read.jdbc(url, "T1", properties=props)
    assert back.count() == 2 and "SCORE" in [c.upper() for c in back.columns]


def test_bucketed_join_has_no_exchange(spark, tmpdir_path):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    SK.write_bucketed(o, "b_orders", os.path.join(tmpdir_path, "bo"), 4, ["o_custkey"])
    SK.write_bucketed(o.select("o_custkey", F.col("o_totalprice").alias("p")), "b_orders2",
                      os.path.join(tmpdir_path, "bo2"), 4, ["o_custkey"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("b_orders").join(spark.table("b_orders2"), "o_custkey")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_dedup_single_batch(spark):
    import __spark_entry__ as E
    got = E.queries()["stream_dedup"](spark, SF)
    e = spark.read.parquet(f"{SF}/events.parquet")
    assert got.count() == e.select("user_id", "event_type").distinct().count()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_builtin_operators_have_no_python_udfs(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ("string_clean", "categorize", "record_hash", "value_map", "clip", "flags", "date_parse",
                 "dedup_keys", "null_counts", "histogram", "group_count"):
        plan = _plan(q[name](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_null_counts_is_one_scan(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["numeric_stats"](spark, SF))
    assert plan.count("FileScan parquet") == 1


def test_filter_pushdown_and_pruning(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["isin_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_totalprice), In(o_orderstatus" in plan


def test_stream_watermark_drops_late_and_repeats(spark, tmpdir_path):
    """L2 over two micro-batches: a repeat inside the watermark and a row
    older than the watermark are both dropped."""
    from quarry.streaming.stream_etl import dedup_within_watermark, read_stream, run_available_now
    schema = "k string, ts timestamp_ntz, v int"
    land = os.path.join(tmpdir_path, "land")
    first = spark.createDataFrame([("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-01 10:30:00", 2)],
                                  "k string, ts string, v int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    second = spark.createDataFrame([("a", "2024-01-01 10:20:00", 3), ("d", "2024-01-01 10:40:00", 5)],
                                   "k string, ts string, v int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    third = spark.createDataFrame([("c", "2024-01-01 07:00:00", 4)],
                                  "k string, ts string, v int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    # One file per micro-batch.  Late rows are judged against the watermark
    # of the batch before (Spark's rule), so the late row comes in batch 3.
    for i, (sub, part) in enumerate((("f1", first), ("f2", second), ("f3", third))):
        part.coalesce(1).write.parquet(os.path.join(land, sub))
        for f in os.listdir(os.path.join(land, sub)):  # the file source orders by modification time
            os.utime(os.path.join(land, sub, f), (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(land))
    out = os.path.join(tmpdir_path, "out")
    run_available_now(dedup_within_watermark(s, ["k"], "ts", "1 hour"), out, os.path.join(tmpdir_path, "ck"))
    got = sorted(r["k"] for r in spark.read.parquet(out).collect())
    assert got == ["a", "b", "d"]  # 'a' repeat dropped, 'c' is behind the watermark


def test_file_etl_to_database(spark, tmpdir_path):
    """§3.2 end to end into an embedded Derby table (visible only in this JVM)."""
    from quarry.plans.file_etl import FileETLJob
    src = _write(os.path.join(tmpdir_path, "sales.csv"),
                 "id,name,amount,date\n1,Alice,100.5,2024-01-01\n2,Bob,,2024-01-02\n2,Bob,,2024-01-02\n3,Cy,-4,bad\n")
    url = "jdbc:derby:memory:quarry_etl;create=true"
    cfg = {"input": src, "table": "SALES", "db_url": url, "batch_size": 2,
           "schema": {"id": {"dtype": "int32", "nullable": False}, "amount": {"dtype": "float64", "min": 0}},
           "impute": {"amount": 0.0}, "sql_types": {"string": "VARCHAR(255)"}}
    job = FileETLJob(spark, cfg, run_clock="7")
    rep = job.run()
    assert rep["sink"] == "jdbc" and rep["duplicates"] == 1 and rep["validation_errors"] >= 1
    back = spark.read.jdbc(url, "SALES", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    rows = {d["id"]: d for d in ({k.lower(): v for k, v in r.asDict().items()} for r in back.collect())}
    assert len(rows) == 3 and rows[2]["amount"] == 0.0 and rows[3]["date"] is None


def test_cli_quality_report(spark, capsys):
    from quarry.cli import main
    assert main(["quality", "--input", f"{SF}/customer.parquet"]) == 0
    rep = json.loads(capsys.readouterr().out)
    assert rep["status"] == "ok" and rep["columns"] == 5 and "quality_score" in rep
