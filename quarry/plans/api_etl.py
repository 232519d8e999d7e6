"""Config-driven paged-API / file job: extract (paged source or file) ->
validate (required + all-or-nothing casts) -> clean -> transform -> load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions.types import columns_named_like, numeric_columns, string_columns
from ..operators import quality as Q
from ..operators.clean import apply_fill, fit_median_fill
from ..operators.features import apply_transforms, audit_columns, batch_id_for, nested_columns
from ..operators.schema import safe_cast
from ..sources import readers as RD
from ..sources import sinks as SK
from ..sources.paged import Fetcher, page_errors, read_pages
from ..sources.records import RecordError, page_records, typed_records, unreadable_pages
from ..session import materialise, observing_session, remove_scratch
from .metrics import RunMetrics


class APIJob:
    def __init__(self, spark: SparkSession, config: Mapping | None = None, run_clock: str | None = None):
        self.spark = observing_session(spark)  # observed counters stay off the caller's session
        self.config = dict(config or {})
        self.metrics = RunMetrics()
        self.batch_id = batch_id_for(run_clock, 8)
        self.stats: dict[str, object] = {}
        self._pages = self._dedup = None  # scratch tables

    def extract_from_api(self, fetch: Fetcher, record_schema=None) -> DataFrame:
        pg = dict(self.config.get("pagination", {}))
        opts = {"pagination": pg.get("type", "none"), "page_size": pg.get("size", 100),
                "strict": str(bool(self.config.get("strict", False))).lower(),
                "results_path": pg.get("results_path", ""), "rate_limit": self.config.get("rate_limit", 0)}
        opts |= {k: pg[k] for k in ("max_pages", "total_pages", "total_pages_field", "attempts", "retry_wait") if pg.get(k)}
        # Fetched once: every later stage reads the stored pages.
        pages, self._pages = materialise(read_pages(self.spark, fetch, **opts), "api-pages")
        strict, path = bool(self.config.get("strict", False)), pg.get("results_path", "")
        errors, unreadable = pages.agg(page_errors(pages), unreadable_pages()).first()
        if strict and unreadable:
            raise RecordError(f"{unreadable} pages are no JSON")
        self.stats |= {"page_errors": errors + unreadable}
        records = page_records(pages.where(F.col("status") == "ok"), path)
        out = typed_records(records, record_schema, strict)
        self.stats["unfit_values"] = out.unfit
        return out.rows

    def extract_from_file(self, path: str) -> DataFrame:
        return RD.drop_corrupt(RD.read_many(self.spark, [path], keep_corrupt=True))

    def validate_schema(self, df: DataFrame, schema: Mapping | None = None) -> DataFrame:
        spec = schema if schema is not None else self.config.get("schema", {})
        out, fails = safe_cast(df, spec, bool(self.config.get("strict", False)))
        self.stats["cast_failures"] = fails.first().asDict()
        return out

    def clean(self, df: DataFrame) -> DataFrame:
        dedup, self._dedup = materialise(df.dropDuplicates(), "api-dedup")
        before, after = df.count(), dedup.count()
        self.stats["rows_extracted"] = before
        self.stats["duplicates_removed"] = before - after
        num = numeric_columns(dedup)
        fills = fit_median_fill(dedup, num) if num else {}
        strs = string_columns(dedup)
        fills.update({c: "Unknown" for c in strs})
        self.stats["nulls_filled"] = Q.null_counts(dedup).agg(F.sum("nulls")).first()[0] or 0
        return apply_fill(dedup, fills)

    def transform(self, df: DataFrame) -> DataFrame:
        tc = dict(self.config.get("transforms", {}))
        if tc.get("_normalize_strings", True):
            strs = string_columns(df)
            df = df.select(*[F.trim(c).alias(c) if c in strs else F.col(c) for c in df.columns])
        dates = columns_named_like(df, ("date", "time", "updated", "created"))
        if dates:  # all-or-nothing parse per column: keep text when any value fails
            fails = df.agg(*[F.count_if(F.col(c).isNotNull() & X.parse_timestamp(c).isNull()).alias(c)
                             for c in dates]).first()
            ok = [c for c in dates if fails[c] == 0]
            df = df.select(*[X.parse_timestamp(c).alias(c) if c in ok else F.col(c) for c in df.columns])
        tc = {k: v for k, v in tc.items() if not k.startswith("_")}
        df = apply_transforms(nested_columns(df, [n for part in tc.values() for n in part]), tc)
        if tc.get("_add_metadata", True):
            df = audit_columns(df, self.config.get("loaded_at"), self.batch_id,
                               "_pipeline_loaded_at", "_pipeline_batch")
        return df

    def load(self, df: DataFrame, output: str | None = None) -> str:
        final = self.metrics.tap(df, "load", F.count(F.lit(1)).alias("rows"))
        return SK.write_by_suffix(final, output or self.config["output"])

    def report(self) -> dict:
        m = self.metrics.collect()
        m.update(self.stats)
        return m

    def run(self, fetch: Fetcher | None = None, path: str | None = None) -> dict:
        df = self.extract_from_api(fetch) if fetch else self.extract_from_file(path or self.config["source"])
        df = self.transform(self.clean(self.validate_schema(df)))
        self.load(df)
        for path in filter(None, (self._pages, self._dedup)):
            remove_scratch(self.spark, path)
        return self.report()
