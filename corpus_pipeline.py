"""Corpus pipeline: quality, lines, near-duplicates, benchmark, mix.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)``
and returns what it keeps.  All but the last return the columns of
``documents``; the last returns the documents that the mix takes, with
``size`` (words), ``source_size``, ``target``, ``copies`` and ``taken``.
Near-duplicates are judged by the SimHash operator alone.

Every stage takes whole texts, however long.  Null and empty texts have no
words: the classifier scores them like any other, lines leaves them alone,
near-duplicates takes them for copies of each other, the benchmark stage
keeps them, and the mix counts them as size 0.  Null ids are kept; rows
repeated exactly are judged alike, and near-duplicates keeps one of them.  An
empty table passes through as an empty table.  Columns beyond those of
``documents`` are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import materialise, read_table
from quarry.llm.decontam import drop_contaminated
from quarry.llm.line_runs import dedup_lines
from quarry.llm.mixing import mix
from quarry.llm.quality_gbt import keep_quality
from quarry.llm.simhash import drop_near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; rows with equal texts go together."""
    return keep_quality(docs, read_table(spark, sf_dir, "labels")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without repeated lines; ``n_chars`` follows the text."""
    out = dedup_lines(docs).withColumn("changed", F.col("n_dropped") > 0)
    text = F.when(F.col("changed"), F.col("kept")).otherwise(F.col("row.text"))
    n_chars = F.when(F.col("changed"), F.length("kept").cast("long")).otherwise(F.col("row.n_chars").cast("long"))
    return out.select("row.doc_id", text.alias("text"), "row.lang", "row.source", n_chars.alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items; texts without words are not."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their copies; ties go as in ``mix``."""
    out = mix(docs, carry=True).where("copies > 0")
    return out.select(*[f"row.{c}" for c in COLUMNS], "size", "source_size", "target", "copies", "taken")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
          ("mixture", mixture)]

#: The classifier's trees and the fingerprints' XXH64 are beyond DuckDB's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
