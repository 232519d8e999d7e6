"""Snapshot tables: data files, a manifest of them, and a ledger of commits
(L1, L3, L4).

A table is a folder.  ``data`` holds Parquet files that never change;
``_manifests`` holds, for every version, a small table of the files that
belong to it, with their ranges of the first key and of the watermark, and the
ledger: the last batch of each stream and the source files that were loaded.
A commit writes new data files, then the new manifest, and last renames a
marker into place that names the manifest.  The rename never replaces a marker
(atomic on HDFS and local file systems), so of two writers of one version the
second fails and changes nothing.  Readers see whole versions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint
from ..sources.readers import file_listing, local_part
from .clean import dedup_keys
from .upsert import upsert_latest


class CommitConflict(RuntimeError):
    """Another writer has made this version."""


class SnapshotTable:
    """``keys`` identify a row; ``watermark`` (optional) orders loads."""

    def __init__(self, path: str, keys: Sequence[str], watermark: str | None = None):
        self.path, self.keys, self.mark = path.rstrip("/"), list(keys), watermark

    # -- versions ---------------------------------------------------------------

    def _fs(self, spark: SparkSession):
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifests")
        return jvm, path, path.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf)

    def versions(self, spark: SparkSession) -> list[int]:
        """The committed versions, ascending."""
        _, path, fs, _ = self._fs(spark)
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n[1:-len(".commit")]) for n in names if n.endswith(".commit") and n.startswith("v"))

    def manifest(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """The manifest of a version, the last by default."""
        version = max(self.versions(spark), default=None) if version is None else version
        if version is None:
            return None
        jvm, path, fs, _ = self._fs(spark)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(jvm.org.apache.hadoop.fs.Path(path, f"v{version:09d}.commit"))))
        folder = reader.readLine()
        reader.close()
        return spark.read.parquet(f"{self.path}/_manifests/{folder}")

    def _commit(self, manifest: DataFrame, version: int) -> int:
        spark = manifest.sparkSession
        folder = f"m{version:09d}-{uuid.uuid4().hex[:12]}"
        manifest.write.parquet(f"{self.path}/_manifests/{folder}")
        jvm, path, fs, context = self._fs(spark)
        draft = jvm.org.apache.hadoop.fs.Path(path, f"{folder}.draft")
        out = fs.create(draft, False)
        out.write(bytearray(folder.encode()))
        out.close()
        keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, jvm.org.apache.hadoop.fs.Path(path, f"v{version:09d}.commit"), keep)
        except Exception as e:
            raise CommitConflict(f"{self.path}: version {version} is there already") from e
        return version

    # -- files ------------------------------------------------------------------

    def files(self, spark: SparkSession, version: int | None = None) -> list[str]:
        got = self.manifest(spark, version)
        return [] if got is None else sorted(r[0] for r in got.where("kind = 'file'").select("name").collect())

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of a version (the last one by default)."""
        paths = self.files(spark, version)
        if not paths:
            raise FileNotFoundError(f"{self.path} has no committed files")
        return _read(spark, paths)

    def _write(self, rows: DataFrame) -> DataFrame:
        """New data files, sorted into ranges of the keys; their manifest rows."""
        spark, folder = rows.sparkSession, f"{self.path}/data/{uuid.uuid4().hex[:12]}"
        rows.repartitionByRange(*[F.col(f"`{k}`") for k in self.keys]).sortWithinPartitions(*[f"`{k}`" for k in self.keys]).write.parquet(folder)
        return self._ranges(spark.read.parquet(folder), "file", F.col("_metadata.file_path"))

    def _ranges(self, rows: DataFrame, kind: str, name) -> DataFrame:
        key = F.col(f"`{self.keys[0]}`")
        mark = F.col(f"`{self.mark}`") if self.mark else F.lit(None).cast("int")
        return rows.groupBy(name.alias("name")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).alias("key_lo"), F.max(key).alias("key_hi"), F.count_if(key.isNull()).alias("key_nulls"),
            F.min(mark).alias("mark_lo"), F.max(mark).alias("mark_hi"), F.count_if(mark.isNull()).alias("mark_nulls")).select(
            F.lit(kind).alias("kind"), "*")

    def _overlapping(self, manifest: DataFrame, which: str, lo, hi, nulls: int) -> list[str]:
        """Files whose range of the key or the watermark meets [lo, hi]."""
        meets, kind = F.lit(False), manifest.schema[f"{which}_lo"].dataType
        if lo is not None:
            meets = F.coalesce((F.col(f"{which}_hi") >= _literal(lo, kind)) & (F.col(f"{which}_lo") <= _literal(hi, kind)), F.lit(False))
        if nulls:
            meets = meets | (F.col(f"{which}_nulls") > 0)
        return [r[0] for r in manifest.where("kind = 'file'").where(meets).select("name").collect()]

    def _seen(self, manifest: DataFrame | None, stream: str | None, batch: int | None) -> bool:
        if manifest is None or stream is None:
            return False
        last = manifest.where((F.col("kind") == "stream") & (F.col("name") == stream)).agg(F.max("rows")).first()[0]
        return last is not None and batch <= last

    def _next(self, base: DataFrame | None, gone: list[str], new: DataFrame, stream: str | None, batch: int | None) -> int:
        spark, version = new.sparkSession, max(self.versions(new.sparkSession), default=0) + 1
        parts = [new]
        if base is not None:
            kept = base
            if gone:
                kept = kept.join(spark.createDataFrame([(g,) for g in gone], "name string"), "name", "left_anti").select(*base.columns)
            if stream is not None:
                kept = kept.where(~((F.col("kind") == "stream") & (F.col("name") == stream)))
            parts.insert(0, kept)
        if stream is not None:
            parts.append(spark.createDataFrame([("stream", stream, batch)], "kind string, name string, rows long"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return self._commit(out, version)

    # -- loads ------------------------------------------------------------------

    def create(self, rows: DataFrame) -> int:
        """The first version."""
        if self.versions(rows.sparkSession):
            raise CommitConflict(f"{self.path} is a table already")
        return self._next(None, [], self._write(rows), None, None)

    def upsert(self, updates: DataFrame, version_col: str, stream: str | None = None, batch: int | None = None) -> int | None:
        """Per key the row with the highest ``version_col`` wins; new keys
        are added.  Only the files that hold an updated key are rewritten:
        the key ranges of the manifest leave out most, and the keys of the
        rest (that column alone) tell which.  Other files keep their names.

        With ``stream`` and ``batch`` the commit is entered in the ledger; a
        batch that is there already has no effect, and None is returned."""
        spark, base = updates.sparkSession, self.manifest(updates.sparkSession)
        if self._seen(base, stream, batch):
            return None
        updates = reliable_checkpoint(dedup_keys(updates, self.keys, order_by=[version_col], keep="last"))
        key = F.col(f"`{self.keys[0]}`")
        n, lo, hi, nulls = updates.agg(F.count(F.lit(1)), F.min(key), F.max(key), F.count_if(key.isNull())).first()
        if n == 0 and (base is None or stream is None):
            return None
        near = self._overlapping(base, "key", lo, hi, nulls) if base is not None else []
        touched = []
        if near:
            held = _read(spark, near).select(F.col("_metadata.file_path").alias("_file"), *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(self.keys)])
            same = [F.col(f"_k{i}").eqNullSafe(F.col(f"`{k}`")) for i, k in enumerate(self.keys)]
            touched = [r[0] for r in held.join(updates.select(*[f"`{k}`" for k in self.keys]), same, "left_semi").select("_file").distinct().collect()]
        rows = upsert_latest(_read(spark, touched), updates, self.keys, version_col) if touched else updates
        return self._next(base, touched, self._write(rows), stream, batch)

    def append(self, source: DataFrame, loaded: DataFrame | None = None) -> int:
        """Add the rows that the table lacks; a row is there if keys and
        watermark are (nulls are equal).  Rows above the table's highest
        watermark are new.  Late ones, rows equal to it and rows without one
        are looked for in the files whose watermark range meets theirs: no
        other file of the table is read.  Repeated rows of the source are
        added as often as they come.  ``loaded`` has manifest rows to enter."""
        spark, base = source.sparkSession, self.manifest(source.sparkSession)
        new = source
        if base is not None:
            high = base.where("kind = 'file'").agg(F.max("mark_hi")).first()[0]
            mark = F.col(f"`{self.mark}`")
            above = mark.isNotNull() if high is None else F.coalesce(mark > _literal(high, source.schema[self.mark].dataType), F.lit(False))
            late = reliable_checkpoint(source.where(~above))
            lo, hi, nulls = late.agg(F.min(mark), F.max(mark), F.count_if(mark.isNull())).first()
            near = self._overlapping(base, "mark", lo, hi, nulls)
            if near:
                names = [*self.keys, self.mark]
                held = _read(spark, near).select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(names)])
                late = late.join(held, [F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(names)], "left_anti")
            new = source.where(above).unionByName(late)
        rows = self._write(new)
        return self._next(base, [], rows if loaded is None else rows.unionByName(loaded, allowMissingColumns=True), None, None)

    def load_files(self, spark: SparkSession, folder: str, fmt: str = "parquet", **options) -> int | None:
        """Append the files of ``folder`` that the ledger does not have (by
        path, length and time); each is entered with its rows and watermark
        range.  None if all are there."""
        listed = file_listing(spark, folder)
        base = self.manifest(spark)
        if base is not None:
            listed = listed.join(base.where("kind = 'source'").select("name"), "name", "left_anti")
        files = {r["path"]: r["name"] for r in listed.collect()}
        if not files:
            return None
        names = spark.createDataFrame([(p, n) for p, n in files.items()], "_path string, _name string")
        rows = spark.read.format(fmt).options(**options).load(list(files))
        where = F.col("_metadata.file_path")
        seen = self._ranges(rows, "source", where)
        seen = seen.join(F.broadcast(names), local_part(F.col("name")) == local_part(F.col("_path"))).select(
            "kind", F.col("_name").alias("name"), *[c for c in seen.columns if c not in ("kind", "name")])
        return self.append(rows, seen)


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def _literal(value, kind: T.DataType):
    """A collected value as a literal of its column's type; a time without a
    zone must not pass through one."""
    return F.lit(str(value)).cast(kind) if isinstance(kind, T.TimestampNTZType) else F.lit(value)
