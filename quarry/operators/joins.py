"""Lookup joins (G1) and union helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint

# Largest small side (bytes of its columns) broadcast after it was measured.
BROADCAST_MAX_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a table's columns: fixed widths, and the actual lengths of
    strings, binaries, arrays and other nested values (as JSON)."""
    width, lengths = 8, F.lit(0)
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            lengths = lengths + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            lengths = lengths + F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0))
        width += 8
    rows, extra = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(lengths.cast("long")), F.lit(0))).first()
    return rows * width + extra


def size_checked(small: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Materialise a derived small side once (reliable checkpoint), measure
    it, and mark it for broadcast only within ``max_bytes``; beyond that the
    join stays a shuffle join (AQE splits skewed keys)."""
    small = reliable_checkpoint(small)
    return F.broadcast(small) if measured_bytes(small) <= max_bytes else small


def size_checked_join(big: DataFrame, small: DataFrame, on, how: str = "left",
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join a table that grows with the data to a derived per-key table
    (group statistics, vocabularies, targets) with a checked broadcast."""
    return big.join(size_checked(small, max_bytes), on, how)


def lookup_join(df: DataFrame, stats: DataFrame, keys: Sequence[str],
                defaults: Mapping[str, object] | None = None) -> DataFrame:
    """G1: left equi-join against a per-key table; misses take ``defaults``.
    The table is broadcast only if it measures within ``BROADCAST_MAX_BYTES``."""
    keys = list(keys)
    right = size_checked(stats)
    j = df.join(right, keys, "left")
    if defaults:
        j = j.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
                       for c in j.columns])
    return j


def union_tagged(parts: Mapping[str, DataFrame], tag: str = "src") -> DataFrame:
    """Union by name with a source tag; missing columns become NULL."""
    out = None
    for name, df in parts.items():
        d = df.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out

