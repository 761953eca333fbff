"""Ranks and latest-row selections that hold on very large and skewed inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.session import ensure_checkpoint_dir, shared_dir


def percent_rank_by_value(df: DataFrame, value: str, out: str, ranges: int | None = None) -> DataFrame:
    """``percent_rank()`` over all rows by a column of any orderable type; NULL ranks first, ties share a rank.

    A window without partitions would sort every row in one task. Here the rows are counted per distinct value
    (combined before the shuffle), the values are dealt into ``ranges`` by sampled bounds, and each range sums up its own
    counts on top of those of the ranges before it. The dealt counts are a table in the shared folder, because sampled
    bounds must not change between the two. Joining the ranks back is by value.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n")).repartitionByRange(
        n, F.col("_v").asc_nulls_first()).withColumn("_range", F.spark_partition_id())
    path = f"{shared_dir(spark)}/ranks-{uuid.uuid4().hex[:12]}"
    counted.write.parquet(path)
    counts = spark.read.schema(counted.schema).parquet(path)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row per range reaches this single-partition window
    starts = counts.groupBy("_range").agg(F.sum("_n").alias("_in_range")).select(
        "_range", F.coalesce(F.sum("_in_range").over(earlier), F.lit(0).cast("bigint")).alias("_before"),
        F.sum("_in_range").over(everything).alias("_total"))
    inside = Window.partitionBy("_range").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    smaller = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0).cast("bigint"))
    ranks = counts.join(starts, "_range").select(
        "_v", F.coalesce(F.try_divide(smaller, F.col("_total") - 1), F.lit(0.0)).alias(out))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_v")), "left").drop("_v")


def last_n(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The last ``n`` rows of each key by ``order``; each task keeps its own best ``n`` before the shuffle."""
    newest = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= n).drop("_r")


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int, out: str | None = None) -> DataFrame:
    """Best ``n`` rows of each group, optionally keeping the rank."""
    w = Window.partitionBy(group).orderBy(*order)
    ranked = df.withColumn(out or "_r", F.row_number().over(w)).filter(F.col(out or "_r") <= n)
    return ranked if out else ranked.drop("_r")


def number_rows(df: DataFrame, keys: list[str], order: list[str], out: str, partitions: int | None = None) -> DataFrame:
    """``row_number()`` per key for keys of any size.

    Rows are range-partitioned by key and order, so one very large key spreads over many tasks in
    order. That layout is checkpointed, because the range bounds are sampled and must not change
    between the count and the numbering. Each range then numbers its own rows and adds how many
    rows of the key lie in earlier ranges; only those counts (one per range) meet in one window.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )
    counts = ranged.groupBy("_range", *keys).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", *keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = Window.partitionBy("_range", *keys).orderBy(*order)
    return (
        ranged.withColumn("_local", F.row_number().over(local))
        .join(offsets, ["_range", *keys])
        .withColumn(out, (F.col("_before") + F.col("_local")).cast("int"))
        .drop("_range", "_before", "_local")
    )
