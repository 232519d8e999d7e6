"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, scratch_path, ship_code, shuffle_partitions

__all__ = ["UPPER", "LOWER", "ascii_lower", "col", "doc_key", "materialise", "read_table", "reliable_checkpoint",
           "row_struct", "scratch_path", "ship_code", "shuffle_partitions", "space_words", "text_hash"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: The white space of the word rule: space and the code points 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]+"


def col(name: str) -> Column:
    """A top-level column by its exact name (dots and blanks allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(text, UPPER, LOWER)


def space_words(text: Column) -> Column:
    """Array of the words between white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def text_hash(text: Column, name: str = "") -> list[Column]:
    """A 128-bit content key as two longs (null counts as empty)."""
    body = F.coalesce(text, F.lit(""))
    return [F.xxhash64(body).alias(f"{name}h1"), F.xxhash64(F.lit(1), body).alias(f"{name}h2")]


def doc_key(id_col: str, text_col: str) -> list[Column]:
    """Identity of a document: its id and a 128-bit hash of its text.

    Unlike a generated row number it stays the same when a lost task runs
    again, and rows repeated exactly share it."""
    return [col(id_col).alias("id"), *text_hash(col(text_col))]


def row_struct(df: DataFrame) -> Column:
    """All columns in one struct ``row``, out of the way of names that an
    operator adds; ``select("row.*")`` brings them back."""
    return F.struct(*[col(c) for c in df.columns]).alias("row")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet under the shared checkpoint folder and read it
    back: later passes see fixed rows and read only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
