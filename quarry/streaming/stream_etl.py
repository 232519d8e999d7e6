"""Streaming ETL (L1) and watermark dedup (L2).

Only stateless stages run inside the stream; statistics (medians) are
fitted on a batch beforehand and passed in as parameters, so a stream never
holds global state.  Output is appended per micro-batch with a checkpoint in
the shared folder; ``available_now`` drains what exists and stops.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import columns as X
from ..functions.types import string_columns
from ..operators.clean import apply_fill
from ..operators.features import audit_columns
from ..operators.snapshot import SnapshotTable


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def stream_transform(df: DataFrame, fills: Mapping[str, object] | None = None,
                     date_columns: Sequence[str] = (), loaded_at: str | None = None,
                     batch_id: str | None = None) -> DataFrame:
    """Stateless stages: string clean, fitted fills, date parts, audit columns."""
    strs = string_columns(df)
    out = df.select(*[X.clean_string(c).alias(c) if c in strs else F.col(c) for c in df.columns])
    if fills:
        out = apply_fill(out, fills)
    parts = []
    for c in date_columns:
        parts += X.date_parts(c, c)
    if parts:
        out = out.select("*", *parts)
    return audit_columns(out, loaded_at, batch_id)


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """L2: drop repeats of a key seen within ``delay`` of event time; state
    for a key is evicted once the watermark passes it."""
    if isinstance(df.schema[event_time].dataType, T.TimestampNTZType):
        # Watermarks need TIMESTAMP; NTZ wall-clock values are read as UTC.
        wm = "_event_time"
        df = df.withColumn(wm, F.to_utc_timestamp(F.col(event_time).cast("timestamp"), "UTC"))
        out = df.withWatermark(wm, delay).dropDuplicatesWithinWatermark(list(keys))
        return out.drop(wm)
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def run_available_now(df: DataFrame, output_path: str, checkpoint: str, fmt: str = "parquet",
                      partition_by: Sequence[str] | None = None, timeout_sec: float | None = None) -> None:
    """Append every micro-batch to ``output_path`` until the source is drained.

    With ``timeout_sec``, a source that is not drained by then raises
    ``TimeoutError``; the output then holds whole micro-batches only, and a
    later call with the same checkpoint goes on from there."""
    w = (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    _drain(w.start(output_path), output_path, timeout_sec)


def run_keyed(df: DataFrame, target: SnapshotTable, version_col: str, checkpoint: str, name: str,
              timeout_sec: float | None = None) -> None:
    """Upsert every micro-batch into a keyed table until the source is drained.

    The table's ledger has the last batch of the stream ``name``.  A batch
    that is committed but not yet in the stream's checkpoint is delivered
    again after a failure; it then has no effect, so each batch counts once."""
    def put(batch: DataFrame, batch_id: int) -> None:
        target.upsert(batch, version_col, stream=name, batch=batch_id)

    _drain(df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), name, timeout_sec)


def _drain(q: StreamingQuery, what: str, timeout_sec: float | None) -> None:
    try:
        drained = q.awaitTermination() if timeout_sec is None else q.awaitTermination(timeout_sec)
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if timeout_sec is not None and not drained:
        raise TimeoutError(f"{what}: the source was not drained within {timeout_sec} s")
