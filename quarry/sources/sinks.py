"""Writers (B1-B9): format tables, partitioned and bucketed output, load
stats, database append with schema evolution, file outputs by suffix."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import sql_column_type

log = logging.getLogger("quarry.sinks")

# Default writer options per output format.
WRITE_OPTIONS = {
    "parquet": {"compression": "snappy"},
    "delta": {"mergeSchema": "true"},
    "orc": {"compression": "zlib"},
    "json": {"compression": "gzip"},
}

# Text formats keep full microsecond timestamps (the default drops to millis).
TEXT_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, options: Mapping[str, str] | None = None,
                dynamic_overwrite: bool = True) -> None:
    """Write with format defaults plus user options; optional Hive
    partitioning (low-cardinality columns only) and dynamic partition
    overwrite (only the partitions present in ``df`` are replaced)."""
    if partition_by:
        # Rows of a folder meet in few tasks (large folders in several), so
        # a load writes few files a folder instead of one a task and folder.
        df = df.hint("rebalance", *partition_by)
    w = df.write.format(fmt).mode(mode).options(**WRITE_OPTIONS.get(fmt, {}))
    if fmt in ("csv", "json"):
        w = w.options(**TEXT_TIME_OPTIONS)
    w = w.options(**dict(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
        if mode == "overwrite" and dynamic_overwrite:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, by: Sequence[str],
                   sort_by: Sequence[str] | None = None, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Bucketed table (external, at ``path``) so later joins/aggregates
    on ``by`` read co-located data without a shuffle."""
    w = df.write.format(fmt).mode(mode).bucketBy(buckets, *by).option("path", path)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)


def write_by_suffix(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Csv (with header) / json / parquet by suffix; unknown -> parquet."""
    low = path.lower()
    if low.endswith(".csv"):
        df.write.mode(mode).option("header", "true").options(**TEXT_TIME_OPTIONS).csv(path)
        return "csv"
    if low.endswith(".json") or low.endswith(".jsonl"):
        df.write.mode(mode).options(**TEXT_TIME_OPTIONS).json(path)
        return "json"
    df.write.mode(mode).parquet(path)
    return "parquet"


def append_load_stats(spark: SparkSession, stats_path: str, output_path: str, rows: int,
                      partitions: int | None = None, loaded_at: dt.datetime | None = None) -> None:
    """One row per run, appended to a stats table kept apart from the
    data output (a static overwrite of the output cannot delete it)."""
    row = [(output_path, int(rows), partitions, loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))]
    spark.createDataFrame(row, "path string, rows bigint, partitions int, loaded_at timestamp_ntz") \
        .write.mode("append").parquet(stats_path)


def _jdbc_execute(spark: SparkSession, url: str, statements: Sequence[str], props: Mapping[str, str]) -> None:
    jvm = spark.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        jprops.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        st = conn.createStatement()
        for s in statements:
            st.execute(s)
        st.close()
    finally:
        conn.close()


def jdbc_columns(spark: SparkSession, url: str, table: str, props: Mapping[str, str]) -> list[str] | None:
    """The target table's columns, or None when the database has no such
    table (asked of its catalogue; any other failure is raised)."""
    jvm = spark.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        jprops.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        name = table.rsplit(".", 1)[-1].strip('"`')
        schema = table.rsplit(".", 1)[0].strip('"`') if "." in table else None
        found = any(conn.getMetaData().getTables(None, s, n, None).next()
                    for n in {name, name.upper(), name.lower()} for s in ({schema, schema.upper(), schema.lower()} if schema else {None}))
    finally:
        conn.close()
    return spark.read.jdbc(url, table, properties=dict(props)).columns if found else None


def jdbc_append(df: DataFrame, url: str, table: str, batch_size: int = 10000,
                props: Mapping[str, str] | None = None, type_overrides: Mapping[str, str] | None = None,
                num_partitions: int | None = None) -> list[str]:
    """Append to a database table; create it if missing, add columns it
    lacks (driver-side DDL), then insert from every partition in batches.
    Returns the columns that were added."""
    props = dict(props or {})
    spark = df.sparkSession
    existing = jdbc_columns(spark, url, table, props)
    added: list[str] = []
    if existing is not None:
        have = {c.lower() for c in existing}
        added = [f.name for f in df.schema.fields if f.name.lower() not in have]
        if added:
            stmts = [f"ALTER TABLE {table} ADD COLUMN {c} {sql_column_type(df.schema[c].dataType, type_overrides)}"
                     for c in added]
            _jdbc_execute(spark, url, stmts, props)
            log.info("added columns %s to %s", added, table)
    w = df.write.option("batchsize", str(batch_size))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.mode("append").jdbc(url, table, properties=props)
    return added


def load_or_fallback(df: DataFrame, db_url: str | None, table: str, fallback_path: str, **kw) -> str:
    """Database when configured, else Parquet at ``fallback_path``."""
    if db_url and not db_url.startswith("${"):
        jdbc_append(df, db_url, table, **kw)
        return "jdbc"
    df.write.mode("overwrite").parquet(fallback_path)
    return "parquet"
