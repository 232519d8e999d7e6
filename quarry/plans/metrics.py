"""Run metrics (D13): rows in/out, duplicates, filled cells, yield.

Inside a job the metrics come from ``DataFrame.observe`` so no extra job
runs; as a standalone query they come from one grouped pass.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.quality import duplicate_groups, missing


def run_metrics(df: DataFrame) -> DataFrame:
    """One row: rows_in, rows_out (after exact dedup), duplicates,
    null_filled (missing cells of the deduplicated rows), yield_pct."""
    miss = F.lit(0)
    for c in df.columns:
        miss = miss + missing(df, c).cast("int")
    # counted before grouping: groups of wide rows keep only the columns asked for
    g = duplicate_groups(df.withColumn("_miss", miss), ["_miss"])
    one = g.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_in"),
                F.count(F.lit(1)).alias("rows_out"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
                F.coalesce(F.sum("_miss"), F.lit(0)).cast("bigint").alias("null_filled"))
    return one.withColumn("yield_pct", F.round(F.try_divide(F.col("rows_out") * 100.0, F.col("rows_in")), 2))


@dataclass
class RunMetrics:
    """Collects per-stage counters through ``observe`` (no extra scans)."""
    started: float = field(default_factory=time.time)
    observations: dict[str, Observation] = field(default_factory=dict)
    values: dict[str, object] = field(default_factory=dict)

    def tap(self, df: DataFrame, stage: str, *exprs) -> DataFrame:
        obs = Observation(stage)
        self.observations[stage] = obs
        cols = list(exprs) or [F.count(F.lit(1)).alias("rows")]
        return df.observe(obs, *cols)

    def collect(self) -> dict[str, object]:
        out = dict(self.values)
        for stage, obs in self.observations.items():
            try:
                for k, v in obs.get.items():
                    out[f"{stage}.{k}"] = v
            except Exception:  # stage never executed
                continue
        out["elapsed_sec"] = round(time.time() - self.started, 3)
        return out
