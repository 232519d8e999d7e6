"""Config-driven file -> database job: extract -> profile -> validate
(constraint map) -> clean -> transform -> load (JDBC append with schema
evolution, or Parquet fallback) -> report."""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions.types import columns_named_like, numeric_columns, string_columns
from ..operators import quality as Q
from ..operators.clean import apply_fill, fit_median_fill
from ..operators.features import audit_columns, batch_id_for, low_cardinality_normalize
from ..operators.schema import check_schema, constraint_violations
from ..sources import readers as RD
from ..sources import sinks as SK
from ..session import materialise, observing_session, remove_scratch
from .metrics import RunMetrics

log = logging.getLogger("quarry.file_etl")


class FileETLJob:
    def __init__(self, spark: SparkSession, config: Mapping | None = None, run_clock: str | None = None):
        self.spark = observing_session(spark)  # observed counters stay off the caller's session
        self.config = dict(config or {})
        self.strict_mode = bool(self.config.get("strict_mode", False))
        self.batch_size = int(self.config.get("batch_size", 10000))
        self.metrics = RunMetrics()
        self.batch_id = batch_id_for(run_clock, 12)
        self.stats: dict[str, object] = {}

    def extract(self, path: str | Sequence[str]) -> DataFrame:
        paths = [path] if isinstance(path, str) else list(path)
        for p in paths:
            if "://" not in p and not os.path.exists(p):
                raise FileNotFoundError(p)
        return RD.drop_corrupt(RD.read_many(self.spark, paths, keep_corrupt=True))

    def profile(self, df: DataFrame) -> dict:
        rows = Q.profile_rows(df).first()
        return {"rows": rows["rows"], "columns": rows["columns"], "dtypes": dict(df.dtypes)}

    def validate_schema(self, df: DataFrame, schema: Mapping | None = None) -> DataFrame:
        spec = schema if schema is not None else self.config.get("schema", {})
        rep = check_schema(df, spec, self.strict_mode)
        present = {c: r for c, r in spec.items() if c in df.columns}
        viol = constraint_violations(df, present).first().asDict() if present else {}
        self.stats["validation_errors"] = sum(v for k, v in viol.items() if k != "rows") + len(rep.type_mismatches)
        nn = [k[:-len("_nulls")] for k, v in viol.items() if k.endswith("_nulls") and v]
        if nn and self.strict_mode:
            raise ValueError(f"Null values in non-nullable column(s): {nn}")
        return df

    def clean(self, df: DataFrame) -> DataFrame:
        # Deduplicated once: the fill, the counts and the load read the same rows.
        dedup, self._scratch = materialise(df.dropDuplicates(), "file-etl-dedup")
        fills = fit_median_fill(dedup, numeric_columns(dedup), self.config.get("impute"))
        strs = string_columns(dedup)
        rows_in, rows_dedup = df.count(), dedup.count()
        self.stats["rows_in"] = rows_in
        self.stats["duplicates"] = rows_in - rows_dedup
        self.stats["null_filled"] = int(Q.null_counts(dedup).agg(F.sum("nulls")).first()[0] or 0)
        out = apply_fill(dedup, fills)
        # pandas order: fill, then strip (blank stays blank).
        return out.select(*[F.trim(F.coalesce(F.col(c), F.lit("Unknown"))).alias(c) if c in strs else F.col(c)
                            for c in out.columns])

    def transform(self, df: DataFrame) -> DataFrame:
        dates = columns_named_like(df, ("date", "time", "updated", "created"))
        df = low_cardinality_normalize(df, 20)  # skips date-named columns (M5)
        df = df.select(*[X.parse_timestamp(c).alias(c) if c in dates else F.col(c) for c in df.columns])
        business = list(df.columns)
        df = audit_columns(df, self.config.get("loaded_at"), self.batch_id)
        return df.withColumn("_etl_hash", X.record_hash(business))

    def load(self, df: DataFrame, table: str | None = None) -> str:
        table = table or self.config.get("table", "etl_output")
        final = self.metrics.tap(df, "load", F.count(F.lit(1)).alias("rows"))
        return SK.load_or_fallback(final, self.config.get("db_url"), table,
                                   self.config.get("fallback_path", "output/etl_output.parquet"),
                                   batch_size=self.batch_size,
                                   type_overrides=self.config.get("sql_types"))

    def report(self) -> dict:
        m = self.metrics.collect()
        m.update(self.stats)
        rin = m.get("rows_in") or 0
        rout = m.get("load.rows") or 0
        m["yield_pct"] = round(rout / rin * 100, 2) if rin else 0.0
        return m

    def run(self, path: str | Sequence[str] | None = None) -> dict:
        df = self.extract(path or self.config["input"])
        self.stats["profile"] = self.profile(df)
        df = self.validate_schema(df)
        df = self.transform(self.clean(df))
        self.stats["sink"] = self.load(df)
        remove_scratch(self.spark, self._scratch)
        return self.report()

    def run_batch(self, inputs: Sequence[str]) -> dict:
        """Many inputs as one table (one scan per format)."""
        return self.run(list(inputs))
