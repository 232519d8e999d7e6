"""Distributed positions and running totals without single-task windows.

``row_number()`` over a window with no (or a hot) partition key puts every
row of the group into one task.  These helpers sort with one range shuffle
instead (a hot group is split across range partitions by its order
columns), freeze partition/position ids with a reliable checkpoint, and
compute each ``(partition, group)`` block's starting offset from a small
per-block table (at most one row per partition for any group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def group_positions(df: DataFrame, by: Sequence[str], order: Sequence[Column | str],
                    pos_col: str = "_pos", size_col: str | None = "_n") -> DataFrame:
    """Add ``pos_col`` = 0-based position of each row within its ``by`` group
    in ``order`` (give a unique tie-break for a deterministic result), and
    optionally ``size_col`` = group size.  ``by`` may be empty (global)."""
    by = list(by)
    # Unique per-row tie-break last: equal keys (a hot value) still split
    # across range partitions; positions among exact ties follow it.
    keys = [F.col(b) for b in by] + _order_cols(order) + [F.col("_gp_tb")]
    ranked = (df.withColumn("_gp_tb", F.monotonically_increasing_id())
              .repartitionByRange(*keys)
              .sortWithinPartitions(*keys)
              .withColumn("_gp_pid", F.spark_partition_id())
              .withColumn("_gp_mid", F.monotonically_increasing_id()))
    ranked = reliable_checkpoint(ranked)
    gb = {b: f"_gb_{i}" for i, b in enumerate(by)}
    blocks = ranked.groupBy("_gp_pid", *[F.col(b).alias(gb[b]) for b in by]).agg(
        F.count(F.lit(1)).alias("_gp_cnt"), F.min("_gp_mid").alias("_gp_start"))
    per_group = Window.partitionBy(*gb.values()) if by else Window.partitionBy(F.lit(0))
    blocks = blocks.withColumn("_gp_base", F.sum("_gp_cnt").over(per_group.orderBy("_gp_pid")) - F.col("_gp_cnt"))
    if size_col:
        blocks = blocks.withColumn(size_col, F.sum("_gp_cnt").over(per_group))
    blocks = blocks.drop("_gp_cnt").withColumnRenamed("_gp_pid", "_gb_pid")
    # Null-safe join on the group key so NULL groups are kept.  Without a
    # group key the block table has one row per partition: a proven bound,
    # so it is broadcast; otherwise AQE picks broadcast or shuffle.
    cond = [F.col("_gp_pid") == F.col("_gb_pid")] + [F.col(b).eqNullSafe(F.col(gb[b])) for b in by]
    from .joins import size_checked
    joined = ranked.join(size_checked(blocks) if by else F.broadcast(blocks), cond)
    pos = F.col("_gp_base") + F.col("_gp_mid") - F.col("_gp_start")
    extra = [F.col(size_col)] if size_col else []
    return joined.select(*[F.col(c) for c in df.columns], pos.alias(pos_col), *extra)


def prefix_sums(df: DataFrame, order: Sequence[Column | str], sum_cols: Sequence[str],
                suffix: str = "_cum", inclusive: bool = True) -> DataFrame:
    """Running totals of ``sum_cols`` in ``order`` over the whole table.

    One range shuffle sorts the rows; the checkpoint keeps each range
    partition intact and in order, so a per-partition running sum
    (Arrow batches, carried across batches) needs no further shuffle, and
    each partition's offset comes from a table with one row per partition.
    """
    keys = _order_cols(order) + [F.col("_ps_tb")]  # unique tie-break: hot values split
    sum_cols = list(sum_cols)
    ranked = (df.withColumn("_ps_tb", F.monotonically_increasing_id())
              .repartitionByRange(*keys)
              .sortWithinPartitions(*keys)
              .withColumn("_ps_pid", F.spark_partition_id()))
    ranked = reliable_checkpoint(ranked)
    totals = ranked.groupBy("_ps_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    wpart = Window.orderBy("_ps_pid")  # one row per partition: bounded
    offsets = totals.select("_ps_pid", *[
        F.coalesce(F.sum(f"_t_{c}").over(wpart.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias(f"_o_{c}") for c in sum_cols])

    out_fields = [f"_l_{c}" for c in sum_cols]
    schema = T.StructType(list(ranked.schema.fields) + [T.StructField(n, T.DoubleType()) for n in out_fields])

    def local_running(batches):
        carry = {c: 0.0 for c in sum_cols}
        for pdf in batches:
            for c in sum_cols:
                vals = pdf[c].fillna(0).astype("float64")
                cum = vals.cumsum() + carry[c]
                pdf[f"_l_{c}"] = cum if inclusive else cum - vals
                if len(vals):
                    carry[c] = float(cum.iloc[-1])
            yield pdf

    from ..session import ship_code
    ship_code()
    local = ranked.mapInPandas(local_running, schema)
    out = local.join(F.broadcast(offsets), "_ps_pid")  # offsets: one row per partition
    return out.select(*df.columns, *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).cast(
        df.schema[c].dataType if isinstance(df.schema[c].dataType, (T.IntegralType,)) else T.DoubleType())
        .alias(f"{c}{suffix}") for c in sum_cols])
