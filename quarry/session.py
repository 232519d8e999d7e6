"""Session-level helpers: shared scratch space and conf lookups.

Library code never builds or stops a session.  Scratch data (checkpoints,
round-trip files, streaming state) lives under the shared folder the cluster
names in ``spark.checkpoint.dir``; only when that is unset (local tests) do
we pick a fresh local folder and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering a local one if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_spark_subdir(current) else current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def _is_spark_subdir(path: str) -> bool:
    # SparkContext.setCheckpointDir appends a random UUID folder.
    last = path.rstrip("/").rsplit("/", 1)[-1]
    return len(last) == 36 and last.count("-") == 4


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/quarry-scratch/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint) and freezes any
    nondeterministic columns so later passes see identical values.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once as Parquet under the shared folder and read it back;
    also returns the path, to be removed after use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def observing_session(spark: SparkSession) -> SparkSession:
    """A sibling session (same SparkContext, checkpoint folder and SQL
    settings) for jobs that attach ``Observation`` metrics.

    In Spark 4.1 the first ``Observation`` registered in a session creates a
    per-session manager that cannot be serialised; from then on any task
    closure that captures the session (MLlib evaluators and fits, RDD
    conversions) fails with "Task not serializable".  Jobs that observe
    their counters read their inputs through a sibling session, so the
    caller's session stays usable for everything else.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        try:
            sibling.conf.set(key, value)
        except Exception:  # static settings are shared already
            pass
    return sibling


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ship_code() -> None:
    """Serialise this package's functions and classes by value, so Python
    workers run them without the package being installed on executors
    (used by the Python data source and pandas UDF paths)."""
    import sys

    from pyspark import cloudpickle

    pkg = __name__.split(".")[0]
    if pkg in sys.modules:
        try:
            cloudpickle.register_pickle_by_value(sys.modules[pkg])
        except ValueError:
            pass


def right_size(df: DataFrame, rows_per_partition: int = 100_000, least_rows: int = 10_000,
               most_rows: int | None = None) -> DataFrame:
    """Partition a materialised (checkpointed) table for iterative jobs
    (model fitting), which launch one task per partition per iteration: about
    ``rows_per_partition`` rows each, but a partition a core as soon as each
    has ``least_rows``, and 16 a core at most.  With ``most_rows`` there are
    more, so that none has more rows on average, however large the table: a
    task that reads back the rows that a fit keeps may hold a partition of
    them.  A table in fewer partitions
    (a file of one row group) is dealt anew and written again.  Models that
    sample rows per partition (bagging, subsampling) are reproducible for a
    table written the same way on as many cores, not across partitionings."""
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    most = max(1, -(-n // least_rows))
    wanted = max(min(most, cores), min(-(-n // rows_per_partition), 16 * cores), -(-n // (most_rows or max(n, 1))))
    if df.rdd.getNumPartitions() < wanted:
        return reliable_checkpoint(df.repartition(wanted))
    return df.coalesce(wanted)
