"""Registered queries: streaming (L1, L2), run to completion with
``availableNow`` and read back from the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.clean import fit_median_fill
from ..operators.snapshot import SnapshotTable
from ..session import scratch_path
from ..streaming.stream_etl import dedup_within_watermark, read_stream, run_available_now, run_keyed, stream_transform
from .registry import register, table

_RUN_AT = "2024-01-01 00:00:00"


def _landing(spark, df):
    """A landing folder the file stream watches (a stream source is a folder)."""
    path = scratch_path(spark, "landing")
    df.write.parquet(path)
    return path
_BATCH = "feedc0ffee00"


@register("stream_etl", f"""
SELECT event_id, ts, user_id, coalesce(nullif(trim(event_type), ''), 'Unknown') AS event_type, value,
       coalesce(nullif(trim(props), ''), 'Unknown') AS props, CAST(year(ts) AS INTEGER) AS ts_year,
       CAST(month(ts) AS INTEGER) AS ts_month,
       TIMESTAMP '{_RUN_AT}' AS _etl_loaded_at, '{_BATCH}' AS _etl_batch_id
FROM events""")
def stream_etl(spark, sf):
    """L1: file-source stream of events through the stateless stages."""
    batch = table(spark, sf, "events")
    src = _landing(spark, batch)
    fills = fit_median_fill(batch, ["value"])  # fitted on a batch, applied in the stream
    s = read_stream(spark, src, batch.schema)
    t = stream_transform(s, fills, ["ts"], _RUN_AT, _BATCH)
    out = scratch_path(spark, "stream-etl-out")
    run_available_now(t, out, scratch_path(spark, "stream-etl-ckpt"))
    return spark.read.parquet(out)


@register("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf):
    """L2: watermark dedup on (user_id, event_type) in one available-now batch."""
    batch = table(spark, sf, "events")
    src = _landing(spark, batch)
    schema = batch.schema
    s = read_stream(spark, src, schema)
    d = dedup_within_watermark(s, ["user_id", "event_type"], "ts", "1 hour").select("user_id", "event_type")
    out = scratch_path(spark, "stream-dedup-out")
    run_available_now(d, out, scratch_path(spark, "stream-dedup-ckpt"))
    return spark.read.parquet(out)


@register("stream_keyed_sink", """
SELECT user_id, event_type, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value
FROM events GROUP BY user_id, event_type""")
def stream_keyed_sink(spark, sf):
    """L1: latest event of every user and type, upserted batch by batch; the
    stream then starts anew without its checkpoint and repeats all batches,
    which the ledger knows."""
    batch = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    src = scratch_path(spark, "landing")
    batch.repartition(4, "event_id").write.parquet(src)
    target = SnapshotTable(scratch_path(spark, "events-latest"), ["user_id", "event_type"])
    for _ in range(2):
        run_keyed(read_stream(spark, src, batch.schema, max_files_per_trigger=2), target, "event_id",
                  scratch_path(spark, "stream-keyed-ckpt"), "latest")
    return target.read(spark)
