"""Jobs over small tables of parcels and readings: every stage's contract."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quarry.operators import quality as Q
from quarry.operators.upsert import incremental_append
from quarry.plans.api_etl import APIJob
from quarry.plans.file_etl import FileETLJob
from quarry.plans.spark_etl import SparkETLJob
from quarry.session import scratch_path
from quarry.sources import readers as RD
from quarry.sources.paged import explode_records, file_pages, read_pages
from quarry.streaming.stream_etl import read_stream, run_available_now


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


# -- CSV inputs ----------------------------------------------------------------

def test_batch_with_other_dialects_and_column_orders(spark, tmpdir_path):
    paths = [put(tmpdir_path, "a.csv", "parcel,weight\nP1,2.5\nP2,4\n"), put(tmpdir_path, "b.csv", "weight;parcel\n7;P3\n"),
             put(tmpdir_path, "c.csv", "weight,parcel,zone\n1,P4,north\n")]
    got = {r.parcel: (float(r.weight), r.zone) for r in FileETLJob(spark, {}).extract(paths).collect()}
    assert got == {"P1": (2.5, None), "P2": (4.0, None), "P3": (7.0, None), "P4": (1.0, "north")}
    folder = os.path.join(tmpdir_path, "all.csv")
    os.makedirs(folder)
    put(folder, "x.csv", "k,v\n1,2\n")
    put(folder, "y.csv", "v,k\n20,10\n")
    assert {(r.k, r.v) for r in RD.read_many(spark, [folder]).collect()} == {(1, 2), (10, 20)}


def test_malformed_rows_of_an_inferred_csv_are_dropped(spark, tmpdir_path):
    path = put(tmpdir_path, "bad.csv", "k,v\n1,10\n2,20,99,x\n3\n4,40\n")
    assert sorted(r.k for r in FileETLJob(spark, {}).extract(path).collect()) == [1, 4]
    job = SparkETLJob(spark, {"input": path, "output": os.path.join(tmpdir_path, "out")})
    report = job.run()
    assert report["load.rows"] == 2 and report["dropped_rows"] == 2


def test_file_job_cleans_and_reports(spark, tmpdir_path):
    path = put(tmpdir_path, "readings.csv", "sensor,level,taken_at\ns1,4,2023-05-01\ns2,,2023-05-02\ns1,4,2023-05-01\ns3,8,\n")
    out = os.path.join(tmpdir_path, "loaded.parquet")
    report = FileETLJob(spark, {"fallback_path": out, "schema": {"sensor": {"nullable": False}}}).run(path)
    assert (report["rows_in"], report["duplicates"], report["load.rows"], report["validation_errors"]) == (4, 1, 3, 0)
    rows = {r.sensor: r for r in spark.read.parquet(out).collect()}
    assert rows["s2"].level == 6 and rows["s1"].level == 4
    assert all(r._etl_hash and r._etl_batch_id and r._etl_loaded_at for r in rows.values())
    with pytest.raises(FileNotFoundError):
        FileETLJob(spark, {}).extract(os.path.join(tmpdir_path, "not there.csv"))
    with pytest.raises(ValueError, match="unit"):
        strict = FileETLJob(spark, {"strict_mode": True})
        strict.validate_schema(strict.extract(path), {"unit": {"nullable": False}})


def test_schema_type_names(spark):
    with pytest.raises(ValueError, match="wurd"):
        RD.load_schema([{"name": "x", "type": "wurd"}])
    with pytest.raises(ValueError):
        RD.load_schema([{"type": "int"}])
    assert RD.load_schema([{"name": "x", "type": "decimal(9,2)", "nullable": False}]).simpleString() == "struct<x:decimal(9,2)>"


@pytest.mark.parametrize("path,fmt", [("lake/t.orc", ".orc"), ("lake/t.csv/part-0001", ".csv"), ("hdfs://n/t.json.gz", ".json"),
                                      ("s3://b/t.csv?v=1/more", ".csv"), ("plain", ".parquet"), ("csv/folder", ".parquet")])
def test_format_from_path_parts(path, fmt):
    assert RD.detect_format(path) == fmt


# -- distributed job -------------------------------------------------------------

def test_keyed_dedup_needs_its_columns_and_an_order(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "k int, v string, n int")
    with pytest.raises(ValueError, match="seen"):
        SparkETLJob(spark, {"dedup_keys": ["k", "seen"], "dedup_order_by": ["n"]}).deduplicate(df)
    with pytest.raises(ValueError, match="dedup_order_by"):
        SparkETLJob(spark, {"dedup_keys": ["k"]}).deduplicate(df)
    kept = SparkETLJob(spark, {"dedup_keys": ["k"], "dedup_order_by": ["n"]}).deduplicate(df)
    assert sorted(r.v for r in kept.collect()) == ["b", "c"]


def test_numeric_date_named_columns_stay_numbers(spark, tmpdir_path):
    src = scratch_path(spark, "numeric-dates")
    spark.sql("SELECT id, cast(id * 3 AS int) AS process_time, date'2024-02-01' AS sent_date FROM range(4)").write.parquet(src)
    out, stats = os.path.join(tmpdir_path, "o"), os.path.join(tmpdir_path, "s")
    job = SparkETLJob(spark, {"input": src, "output": out, "transform": {"add_date_parts": True}, "load_stats_table": True, "load_stats_path": stats})
    report = job.run()
    back = spark.read.parquet(out)
    assert dict(back.dtypes)["process_time"] == "int" and "sent_date_year" in back.columns and "process_time_year" not in back.columns
    row = spark.read.parquet(stats).first()
    assert row.rows == 4 and row.partitions == report["partitions"] >= 1


# -- paged source ----------------------------------------------------------------

def service(n_pages, broken=(), always=False):
    """A fetcher of ``n_pages`` pages of 5 records; broken pages fail once, or always."""
    import tempfile
    log = tempfile.mkdtemp()

    def fetch(page, offset, size):
        count = len([x for x in os.listdir(log) if x.startswith(f"{page}-")])
        open(os.path.join(log, f"{page}-{count}-{os.getpid()}-{os.urandom(3).hex()}"), "w").close()
        if page in broken and (always or count == 0):
            raise OSError("503")
        return json.dumps([{"n": (page - 1) * 5 + i} for i in range(5)]) if page <= n_pages else None
    return fetch, log


def test_a_failing_probe_never_shortens_the_plan(spark):
    options = {"page_size": 5, "pagination": "page", "retry_wait": 0}
    fetch, _ = service(20, broken=(2, 4))
    rows = explode_records(read_pages(spark, fetch, **options), "n int")
    assert rows.agg(F.count_distinct("n")).first()[0] == 100  # tried again
    with pytest.raises(Exception, match="503"):
        read_pages(spark, service(20, broken=(2,))[0], strict="true", **options).collect()
    pages = read_pages(spark, service(20, broken=(4,), always=True)[0], **options).collect()
    assert len(pages) == 20 and [p.page for p in pages if p.status != "ok"] == [4]
    with pytest.raises(Exception, match="cannot be fetched"):
        read_pages(spark, service(20, broken=range(3, 30), always=True)[0], **options).collect()


def test_api_job_fetches_every_page_once(spark, tmpdir_path):
    fetch, log = service(12)
    out = os.path.join(tmpdir_path, "readings.parquet")
    report = APIJob(spark, {"output": out, "pagination": {"type": "page", "size": 5, "total_pages": 12}}).run(fetch)
    assert len(os.listdir(log)) == 12 and report["rows_extracted"] == 60 and report["page_errors"] == 0
    again = APIJob(spark, {"output": out, "rate_limit": 0.001, "pagination": {"type": "page", "size": 5, "max_pages": 3}}).run(service(12)[0])
    assert again["load.rows"] == 15  # a second job in the same session


def test_a_page_in_several_files(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "page-1.json")
    os.makedirs(folder)
    put(folder, "part-0", '[{"n": 1}]')
    put(folder, "part-1", '[{"n": 2}, {"n": 3}]')
    fetch = file_pages(tmpdir_path)
    assert [x["n"] for x in json.loads(fetch(1, 0, 5))] == [1, 2, 3] and fetch(2, 0, 5) is None


def test_api_job_on_a_file(spark, tmpdir_path):
    path = put(tmpdir_path, "probes.json", json.dumps([{"probe": "a", "depth": 1.5, "note": None}, {"probe": "b", "depth": None, "note": "wet "},
                                                       {"probe": "b", "depth": None, "note": "wet "}]))
    out = os.path.join(tmpdir_path, "probes.csv")
    job = APIJob(spark, {"source": path, "output": out, "schema": {"depth": {"dtype": "float64"}, "probe": {"required": True}}})
    report = job.run()
    assert (report["rows_extracted"], report["duplicates_removed"], report["nulls_filled"]) == (3, 1, 2)
    rows = {r.probe: r for r in spark.read.option("header", True).csv(out).collect()}
    assert float(rows["b"].depth) == 1.5 and rows["a"].note == "Unknown" and rows["b"].note == "wet"
    assert {"_pipeline_loaded_at", "_pipeline_batch"} <= set(spark.read.option("header", True).csv(out).columns)


# -- incremental and streaming loads ---------------------------------------------

def test_incremental_append_loses_nothing_and_repeats_nothing(spark):
    schema = "k int, at int, v string"
    path = scratch_path(spark, "incr")
    first = [(1, 10, "a"), (2, 20, "b"), (3, None, "c")]
    incremental_append(spark.createDataFrame(first, schema), path, "at")
    rows = first + [(4, 5, "late"), (5, 20, "equal"), (6, None, "none"), (7, 30, "new")]
    for keys in (["k"], None):
        assert incremental_append(spark.createDataFrame(rows, schema), path, "at", keys=keys) == 30
        assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5, 6, 7]
    other = scratch_path(spark, "incr-other")
    spark.range(3).write.parquet(other)
    with pytest.raises(Exception, match="at"):
        incremental_append(spark.createDataFrame(rows, schema), other, "at")
    assert spark.read.parquet(other).count() == 3


def test_a_stream_that_is_not_drained_in_time_raises(spark, tmpdir_path):
    src = scratch_path(spark, "slow-src")
    spark.range(0, 40, 1, 8).write.parquet(src)
    slow = F.udf(lambda x: __import__("time").sleep(0.4) or x, "long")
    stream = read_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1).select(slow("id").alias("id"))
    out, state = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "state")
    with pytest.raises(TimeoutError):
        run_available_now(stream, out, state, timeout_sec=3)
    run_available_now(stream, out, state)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))


# -- quality report ----------------------------------------------------------------

def test_quality_report_of_a_small_table(spark):
    df = spark.sql("SELECT id, IF(id = 3, NULL, id * 2.0D) AS level, IF(id = 7, 1e9D, id * 1.0D) AS flow, 'z' AS zone FROM range(20)")
    df = df.unionByName(df.where("id = 5"))
    report = Q.run_report(df)
    assert report["duplicate_rows"] == 1 and report["outliers"]["flow"] == 1
    assert report["completeness"]["level"] < 1 == report["completeness"]["flow"]
    assert report["dtypes"]["zone"] == "string"
