"""Plan-shape checks for the skew and size rules: hot values split across
range partitions, derived per-key tables broadcast only after a count,
keyed dedup and duplicate detection combine map-side."""

from pyspark.sql import functions as F

from quarry.operators import clean as C
from quarry.operators import quality as Q
from quarry.operators.joins import size_checked


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_value_is_split_across_range_partitions(spark):
    # 40% of the rows share one value; the row-id tie-break spreads them.
    df = spark.range(100000).select(F.when(F.col("id") % 5 < 2, F.lit(7.0))
                                    .otherwise(F.col("id").cast("double")).alias("v"))
    sizes = [r[1] for r in df.withColumn("_tb", F.monotonically_increasing_id())
             .repartitionByRange(8, "v", "_tb").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.25 * sum(sizes)


def test_group_table_broadcast_after_count(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"),
                                  F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 1.0).alias("x"))
    out = C.group_median_fill(df, "x", ["g"])
    out.write.format("noop").mode("overwrite").save()
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_size_checked_falls_back_to_shuffle(spark):
    big = spark.range(50).withColumnRenamed("id", "k")
    small = spark.range(50).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        j = big.join(size_checked(small, max_bytes=10), "k")
        j.write.format("noop").mode("overwrite").save()
        assert "BroadcastHashJoin" not in _plan(j)
        j2 = big.join(size_checked(small, max_bytes=100_000), "k")
        j2.write.format("noop").mode("overwrite").save()
        assert "BroadcastHashJoin" in _plan(j2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_keyed_dedup_and_duplicates_combine_map_side(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("ts"))
    d = C.dedup_keys(df, ["k"], ["ts"])
    assert "partial_max_by" in _plan(d)
    assert "partial_count" in _plan(Q.duplicate_groups(df))
