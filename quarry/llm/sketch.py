"""Document fingerprints: bottom-k sketches of word shingles, JVM only.

A sketch is the sorted array of the k least hashes of a text's distinct
shingles.  Sketches of parts merge into the sketch of the whole; two
sketches estimate resemblance, containment and distinct shingle counts.
"""

from __future__ import annotations

import os

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, col, shuffle_partitions, space_words

K = 128
SHINGLE = 5
#: Hashes are signed longs: the least, and how many there are.
LEAST, RANGE = -(2.0 ** 63), 2.0 ** 64


def sketch_of_hashes(hashes: Column, k: int = K) -> Column:
    """Bottom-k sketch of an array of shingle hashes, repeats allowed."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: Column, name: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Adds the sketch of a text as ``name``.

    Words lie between white space, A-Z lower-cased; fewer words than a
    shingle make one shingle, none an empty sketch.  Word hashes are a
    column of their own, so that they are not computed again per shingle."""
    hashed = df.withColumn("_words", F.transform(space_words(ascii_lower(text)), lambda w: F.xxhash64(w)))
    n = F.size("_words")
    whole = F.array(F.xxhash64(F.col("_words").cast("string")))
    grams = F.transform(F.sequence(F.lit(0), n - shingle),
                        lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(shingle)]))
    hashes = F.when(n >= shingle, grams).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))
    return hashed.withColumn(name, sketch_of_hashes(hashes, k)).drop("_words")


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of the shingles behind two sketches."""
    return sketch_of_hashes(F.concat(a, b), k)


def merge_groups(df: DataFrame, by: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per group, from the sketches of its parts.

    Each task first keeps the k least hashes of its share of a group, then
    the shares meet: a group of any size ends as k hashes a task."""
    rows = df.select(*[col(c) for c in by], F.spark_partition_id().alias("_pid"), F.explode(col(sketch)).alias("_h"))
    keys = [col(c) for c in by]
    share = rows.groupBy(*keys, "_pid", "_h").agg(F.lit(1).alias("_one"))
    least = Window.partitionBy(*keys, "_pid").orderBy("_h")
    short = share.withColumn("_rank", F.row_number().over(least)).where(F.col("_rank") <= k)
    merged = short.groupBy(*keys).agg(sketch_of_hashes(F.collect_set("_h"), k).alias(sketch))
    groups = df.select(*keys).distinct()
    same = None
    for i, c in enumerate(by):
        merged = merged.withColumnRenamed(c, f"_g{i}")
        one = col(c).eqNullSafe(F.col(f"_g{i}"))
        same = one if same is None else same & one
    empty = F.array().cast("array<bigint>")
    return groups.join(merged, same, "left").select(*keys, F.coalesce(sketch, empty).alias(sketch))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated distinct shingles: exact below k, else from the k-th least hash."""
    n = F.size(sketch)
    top = (F.element_at(sketch, -1).cast("double") - F.lit(LEAST) + 1) / F.lit(RANGE)
    return F.when(n < k, n.cast("double")).otherwise((k - 1) / top)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; two empty sketches are alike."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too, 0 to 1; nothing is contained in all."""
    r, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(na == 0, 1.0).otherwise(F.least(F.lit(1.0), r * (na + nb) / ((1 + r) * na)))


def as_string(sketch: Column) -> Column:
    """Sketch as text: 16 hexadecimal digits a hash, in order."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def from_string(text: Column) -> Column:
    """The sketch that ``as_string`` wrote."""
    n = (F.length(text) / 16).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.conv(F.substring(text, i * 16 + 1, F.lit(16)), 16, -10).cast("bigint"))


def _place(df: DataFrame, id_col: str) -> Column:
    """A double that orders rows as their ids do, as far as it tells them
    apart.  Numbers are themselves; for other ids it is the six bytes after
    what the least and the greatest id, and so all between, begin with."""
    if isinstance(df.schema[id_col].dataType, T.NumericType):
        return col(id_col).cast("double")
    text = col(id_col).cast("string")
    ends = [v.encode() for v in df.agg(F.min(text), F.max(text)).first() if v is not None]
    same = len(os.path.commonprefix(ends)) if ends else 0
    digits = F.rpad(F.substring(F.hex(text.cast("binary")), 2 * same + 1, 12), 12, "0")
    return F.conv(digits, 16, 10).cast("double")


def with_next(df: DataFrame, id_col: str, tie: Column, carried: list[str]) -> DataFrame:
    """Adds ``next_<c>`` for the carried columns: those of the next row by
    falling id (nulls last, ties by ``tie``); the first row's for the last.

    Ids are cut into as many ranges as there are shuffle partitions.  Each
    range is sorted by itself, with a copy of the next range's first row at
    its end, so one shuffle is enough and no task sees more than a range
    (rows of one id share a range).  Ranges are found from quantiles of the
    ids; a range's first row is looked up by its id."""
    spark = df.sparkSession
    place = _place(df, id_col)
    ids = df.select(place.alias("id")).where("id IS NOT NULL")
    n = shuffle_partitions(spark)
    cuts = sorted(set(ids.approxQuantile("id", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []
    marked = df.withColumn("_id", place).withColumn("_tie", tie)
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        cutter = Bucketizer(splits=splits, inputCol="_id", outputCol="_range", handleInvalid="keep")
        marked = cutter.transform(marked)
    else:
        marked = marked.withColumn("_range", F.lit(0.0))
    marked = marked.withColumn("_range", F.when(F.col("_id").isNull(), -1.0).otherwise(F.col("_range")))
    # first rows of the ranges: at most one a range
    first = marked.groupBy("_range").agg(F.max("_id").alias("_top"))
    around = Window.partitionBy(F.lit(0)).orderBy("_range")
    goes_to = F.coalesce(F.lead("_range").over(around), F.min("_range").over(Window.partitionBy(F.lit(0))))
    first = first.select(F.col("_range").alias("_from"), "_top", goes_to.alias("_to"))
    heads = marked.join(F.broadcast(first), (F.col("_range") == F.col("_from")) & F.col("_id").eqNullSafe(F.col("_top")))
    first_row = F.max_by(F.struct(*[col(c) for c in carried]), F.struct(F.col("_id"), col(id_col), F.col("_tie")))
    extra = (heads.groupBy("_from", "_to").agg(first_row.alias("h"))
             .select(F.col("_to").alias("_range"), "h.*", F.lit(True).alias("_copy")))
    rows = marked.withColumn("_copy", F.lit(False)).unionByName(extra, allowMissingColumns=True)
    order = Window.partitionBy("_range").orderBy("_copy", F.col("_id").desc_nulls_last(), F.col(id_col).desc_nulls_last(),
                                                 F.desc("_tie"))
    for c in carried:
        rows = rows.withColumn(f"next_{c}", F.lead(col(c)).over(order))
    return rows.where(~F.col("_copy")).drop("_id", "_tie", "_range", "_copy")


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                       shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has the last third (rounded down, code points) replaced
    by the first as many, or all, of the next document's, by falling id;
    after the last comes the first.  Returns ``id, n_chars, edited_sha256,
    sketch, edited_sketch, near_edited, near_next``.

    Null texts count as empty; a text without words has an empty sketch,
    which is alike (1) only to another empty one.  Null ids come after all
    others.  Rows of equal id follow by the hash of their text, and rows
    repeated exactly follow each other.  Text ids go by their UTF-8 bytes.  A
    single document is its own next.  A very long text is hashed and sorted
    within its row, in the JVM; no other row waits for it.
    An empty table gives no rows.  Other columns are not looked at.
    """
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    rows = with_next(with_sketch(rows, F.col("text"), "sketch", k, shingle), "id", F.xxhash64("text"), ["text", "sketch"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut),
                                              F.substring("next_text", F.lit(1), cut))).drop("text", "next_text")
    rows = with_sketch(rows, F.col("edited"), "edited_sketch", k, shingle)
    return rows.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "edited_sketch",
                       resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                       resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
