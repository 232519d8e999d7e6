"""Token counts with a digest cache.

The cache is a Parquet folder per tokenizer version; its rows are the digest
of a normalised content (null counts as empty; nothing else is changed, as
white space counts) and its number of tokens.  Digests alone are held against
the cache; only texts whose digest it lacks are shuffled, reduced to one per
digest, map-side first, encoded and appended; then every document takes its
count from the cache by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import size_checked
from .common import col, scratch_path, ship_code

SCHEMA = "digest string, n_tokens long"


def tokenizer_version(definition: bytes) -> str:
    """Digest of the tokenizer file, its library's version and how it is called."""
    import tokenizers
    how = f"tokenizers {tokenizers.__version__}; no added tokens, truncation or padding; special strings as default"
    return hashlib.sha256(definition + how.encode()).hexdigest()


def content_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def cached(spark: SparkSession, folder: str) -> DataFrame | None:
    """The cache's rows, one per digest; None if nothing was ever stored."""
    try:
        rows = spark.read.schema(SCHEMA).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encoder(definition: str, batch_bytes: int):
    """Counts of Arrow batches of ``digest, body``, a few megabytes of text at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        encoder = Tokenizer.from_str(definition)
        encoder.no_truncation()
        encoder.no_padding()
        for batch in batches:
            counts, part, size = [], [], 0
            for body in batch.column("body"):
                part.append(body.as_py().decode("utf-8", "replace"))
                size += len(part[-1])
                if size >= batch_bytes:
                    counts += [len(e) for e in encoder.encode_batch_fast(part, add_special_tokens=False)]
                    part, size = [], 0
            counts += [len(e) for e in encoder.encode_batch_fast(part, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return run


def encode_misses(docs: DataFrame, text_col: str, definition: str, folder: str, batch_bytes: int = 1 << 20) -> DataFrame:
    """``digest, n_tokens`` of the distinct contents that the cache lacks."""
    ship_code()
    return missing_texts(docs, text_col, folder).mapInArrow(_encoder(definition, batch_bytes), SCHEMA)


def missing_texts(docs: DataFrame, text_col: str, folder: str) -> DataFrame:
    """``digest, body``, one row per content that the cache lacks.

    The cache is joined to distinct digests, never to texts.  The digests
    missed are broadcast if they measure small, so that the texts of hits
    are dropped where they are read; with more misses than that, texts meet
    them in a shuffle."""
    body = F.coalesce(col(text_col), F.lit("")).cast("binary")
    texts = docs.select(content_digest(col(text_col)).alias("digest"), body.alias("body"))
    known = cached(docs.sparkSession, folder)
    if known is not None:
        digests = docs.select(content_digest(col(text_col)).alias("digest")).distinct()
        texts = texts.join(size_checked(digests.join(known.select("digest"), "digest", "left_anti")), "digest", "left_semi")
    return texts.groupBy("digest").agg(F.first("body").alias("body"))


def token_counts(docs: DataFrame, tokenizer_file: str, cache: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every whole text.

    ``cache`` is a folder on shared storage that later calls use again;
    without it, a new one under the checkpoint folder serves this call.
    Null texts count as empty (0 tokens).  Rows repeated exactly, or with
    equal texts, get equal counts, encoded once.  An empty table gives no
    rows.  Bytes that are no UTF-8 count as the replacement character.
    Very long texts are encoded whole, each on its own once it fills a
    batch.  Other columns are not looked at.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as file:
        definition = file.read()
    folder = f"{cache or scratch_path(spark, 'token-cache')}/{tokenizer_version(definition)}"
    encode_misses(docs, text_col, definition.decode(), folder).write.mode("append").parquet(folder)
    rows = docs.select(col(id_col).alias("id"), content_digest(col(text_col)).alias("digest"),
                       F.octet_length(F.coalesce(col(text_col), F.lit(""))).cast("long").alias("n_bytes"))
    return rows.join(cached(spark, folder), "digest").select(
        "id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
