"""Line de-duplication over levelled sorted runs of line hashes.

A run is a table of line keys: ``h1, h2`` (128-bit hash of the key),
``n_docs`` (documents of the batch that hold it) and ``keeper``.  All runs of
a store are bucketed alike by the key and sorted within a bucket.
Documents come in batches of falling id.  A batch is bucketed and sorted once
and merge-anti-joins the runs so far, bucket by bucket, without moving or
sorting either side again: keys that no run has get the batch's largest id as
keeper, which is then the largest of all.  The batch's keys are added as a
new run of level 0; when a level holds ``fanout`` runs they are merged into
one run of the next level.  A lookup reads few runs, and a key is rewritten
once a level.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import observing_session, remove_scratch
from .common import ascii_lower, col, doc_key, materialise, row_struct, scratch_path

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def key_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


#: Keys in a bucket that a store is laid out for, and Spark's limit of buckets.
BUCKET_KEYS, MOST_BUCKETS = 2_000_000, 100_000


class LineRuns:
    """Levelled runs under one folder; the list of runs is all its state.

    Runs are external tables of the current database, so that Spark knows
    their buckets; ``drop`` removes tables and files.  ``buckets`` holds for
    the life of a store (default: the cluster's cores)."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = 4, buckets: int | None = None):
        self.spark, self.path, self.fanout = spark, path, fanout
        self.buckets = min(buckets or spark.sparkContext.defaultParallelism, MOST_BUCKETS)
        self.levels: list[list[str]] = []
        self._tables: list[str] = []
        self._database = spark.catalog.currentDatabase()
        # scans of this session tell the planner that buckets are sorted; joins stay merge joins
        self.merging = observing_session(spark)
        self.merging.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        # a union of columnar scans does not keep the buckets that it reports
        self.merging.conf.set("spark.sql.unionOutputPartitioning", "false")
        self.merging.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        self.merging.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")

    def _save(self, keys: DataFrame, kind: str) -> str:
        """Write a table with one sorted file a bucket, if ``keys`` are
        partitioned by them."""
        name = f"line_{kind}_{uuid.uuid4().hex[:12]}"
        (keys.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .option("path", f"{self.path}/{name}").saveAsTable(f"`{self._database}`.{name}"))
        self._tables.append(name)
        return name

    def _read(self, name: str, session: SparkSession | None = None) -> DataFrame:
        return (session or self.merging).table(f"`{self._database}`.{name}")

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS `{self._database}`.{name}")
            remove_scratch(self.spark, f"{self.path}/{name}")
            self._tables.remove(name)

    def drop(self) -> None:
        self._forget(list(self._tables))
        self.levels = []

    def unseen(self, keys: DataFrame) -> DataFrame:
        """Rows of ``keys`` (with ``h1, h2``) whose key is in no run."""
        runs = [name for level in self.levels for name in level]
        return reduce(lambda left, run: left.join(self._read(run, keys.sparkSession).select("h1", "h2"), ["h1", "h2"], "left_anti"),
                      runs, keys)

    def marked(self, batch: DataFrame) -> DataFrame:
        """A batch's keys as rows of a run: new ones have a keeper."""
        new = self.unseen(batch).select("h1", "h2", F.lit(True).alias("new"))
        return batch.join(new, ["h1", "h2"], "left").select(
            "h1", "h2", "n_docs", F.when(F.col("new"), F.col("top")).alias("keeper"))

    def add(self, lines: DataFrame) -> None:
        """Add a batch of ``h1, h2, id``, one row per key and document."""
        # combined map-side before a key's rows meet; the buckets then get one row a key
        keys = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("top"))
        batch = self._save(keys.repartition(self.buckets, "h1", "h2"), "batch")
        run = self._save(self.marked(self._read(batch)), "run")
        self._forget([batch])
        level = 0
        while True:
            while len(self.levels) <= level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                break
            full = self.levels[level]
            run = self._save(self.merged(full), "run")
            self.levels[level] = []
            self._forget(full)
            level += 1

    def merged(self, names: list[str] | None = None) -> DataFrame:
        """One row per key over the given runs, or over all of them.

        Spark unites scans without regard to their buckets, so this moves
        the keys once, a row per key and run."""
        runs = [self._read(n) for n in (names if names is not None else [n for level in self.levels for n in level])]
        rows = reduce(DataFrame.unionByName, runs).repartition(self.buckets, "h1", "h2")
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))


def _batches(docs: DataFrame, id_col: str, n: int) -> list[Column]:
    """Conditions on ``id`` that cut the table into ranges of falling id, nulls last.

    Only numbers are cut: as doubles, other ids fail or come in another order."""
    if not isinstance(docs.schema[id_col].dataType, NumericType):
        return [F.lit(True)]
    cuts = sorted(set(docs.select(col(id_col).cast("double").alias("id")).approxQuantile(
        "id", [i / n for i in range(1, n)], 0.01)), reverse=True) if n > 1 else []
    value = F.col("id").cast("double")
    if not cuts:
        return [F.lit(True)]
    return ([value > cuts[0]] + [(value <= a) & (value > b) for a, b in zip(cuts, cuts[1:])]
            + [(value <= cuts[-1]) | value.isNull()])


def dropped_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 40,
                 min_docs: int = 5, batches: int = 5, fanout: int = 4) -> DataFrame:
    """``id, h1, h2`` of a document and ``gone``, the hashes of its lines to drop."""
    key = F.transform(lines_of(col(text_col)), line_key)
    long_keys = F.array_distinct(F.transform(F.filter(key, lambda k: F.length(k) >= min_length), key_hash))
    held = materialise(docs.select(*doc_key(id_col, text_col), long_keys.alias("keys")).where(F.size("keys") > 0), "lines")
    spark = docs.sparkSession
    n_keys = held.agg(F.sum(F.size("keys"))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, -(-n_keys // BUCKET_KEYS))
    store = LineRuns(spark, scratch_path(spark, "line-runs"), fanout, buckets)
    for inside in _batches(held, "id", batches):
        store.add(held.where(inside).select("id", F.explode("keys").alias("key")).select("key.h1", "key.h2", "id"))
    found = scratch_path(spark, "line-common")
    store.merged().where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper").write.parquet(found)
    store.drop()
    common = spark.read.parquet(found)
    rows = held.select(F.col("id"), F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.explode("keys").alias("key"))
    gone = (rows.select("id", "t1", "t2", "key", "key.h1", "key.h2").join(common, ["h1", "h2"])
            .where(~F.col("id").eqNullSafe(F.col("keeper"))))
    return gone.groupBy("id", "t1", "t2").agg(F.collect_set("key").alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 40,
                min_docs: int = 5, batches: int = 5, fanout: int = 4) -> DataFrame:
    """Every input row as ``row``, with ``id, n_lines, n_dropped, kept``.

    Keys (lines stripped of white space and lower-cased A-Z) of at least
    ``min_length`` code points that at least ``min_docs`` documents hold
    lose all their lines but those in the document of the largest id.

    A null or empty text is one empty line, and so is what stays of a text
    that loses every line.  Each row counts as a document; rows that share
    the largest id all keep their lines.  Null ids count as the smallest; if
    all holders have null ids they all keep it.  Ids of a number type
    are cut into batches; others form one batch, in their own order.  A very
    long text is split in its row as a whole.  An empty table gives no rows.
    Other columns are only carried.  Every batch reads the keys of those
    before it, so their number is fixed, whatever the size of the table.
    """
    gone = dropped_keys(docs, id_col, text_col, min_length, min_docs, batches, fanout)
    gone = gone.select(F.col("id").alias("gid"), "t1", "t2", "gone")
    rows = docs.select(row_struct(docs), *doc_key(id_col, text_col), col(text_col).alias("body"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("gid")) & (F.col("h1") == F.col("t1"))
                       & (F.col("h2") == F.col("t2")), "left")
    lines = joined.withColumn("lines", lines_of(F.col("body")))
    stay = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.filter(
        "lines", lambda x: ~F.array_contains(F.col("gone"), key_hash(line_key(x)))))
    lines = lines.withColumn("stay", stay)
    return lines.select("row", "id", F.size("lines").cast("long").alias("n_lines"),
                        (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"),
                        F.array_join("stay", "\n").alias("kept"))
