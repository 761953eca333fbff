"""Longest-processing-time sharding (Graham 1969): groups by falling size, each to the least loaded shard."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import numbered, stored

# Sizes up to this are told apart exactly; above, by so many leading digits (classes 0.1 % wide or less).
EXACT_BELOW = 10_000
BUCKET_ROWS = 100_000


def size_class(size):
    """Group sizes with at most four digits other than zero: some 9,000 classes per power of ten."""
    step = F.pow(F.lit(10.0), F.greatest(F.floor(F.log10(F.greatest(size, F.lit(1)).cast("double"))) - 3, F.lit(0))).cast("long")
    return F.when(size < EXACT_BELOW, size).otherwise(F.floor(size / step).cast("long") * step)


def assign(classes: list[tuple[int, int, float]], shards: int) -> dict[int, list[int]]:
    """For each ``(class, groups, mean size)`` the end of each shard's share in its numbered groups.

    The heap gives the groups of a class one by one to the least loaded shard, ties to the lowest number.
    For a class with many groups of one size, the rounds in which every shard is filled up to a common
    level are taken at once, and the heap deals the rest: the outcome is the same.
    """
    loads = [0.0] * shards
    out = {}
    for cls, groups, size in sorted(classes, reverse=True):
        counts = [0] * shards
        left = groups
        if groups > 4 * shards:
            low, high = min(loads), max(loads) + size * (groups + 1)
            for _ in range(200):  # the highest level that takes no more than all groups
                level = (low + high) / 2
                if sum(max(0, int((level - load) // size)) for load in loads) <= groups:
                    low = level
                else:
                    high = level
            counts = [max(0, int((low - load) // size)) for load in loads]
            left -= sum(counts)
        heap = [(load + n * size, k) for k, (load, n) in enumerate(zip(loads, counts, strict=True))]
        heapq.heapify(heap)
        for _ in range(left):
            load, k = heap[0]
            heapq.heapreplace(heap, (load + size, k))
            counts[k] += 1
        loads = [load + n * size for load, n in zip(loads, counts, strict=True)]
        ends, total = [], 0
        for n in counts:
            total += n
            ends.append(total)
        out[cls] = ends
    return out


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``: rows of equal text stay together, sizes come out near equal.

    Size: UTF-8 bytes of the text plus ``overhead``; a null text counts and groups as an empty one. Sizes
    are added up per text before any shuffle of groups. To the driver come the numbers of groups per size
    class, some tens of thousands of rows whatever the input; it runs the heap over them. Groups of a
    class are numbered without holding a class in one task and take the shard their number falls to.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    rows = stored(rows, "shard_rows")
    key = ["text_hash", "text_crc32", "size"]
    groups = rows.groupBy(*key).agg(F.count("*").alias("copies")).withColumn(
        "group_size", F.col("size") * F.col("copies")).withColumn("size_class", size_class(F.col("group_size")))
    groups = stored(groups, "shard_groups")
    classes = groups.groupBy("size_class").agg(F.count("*").alias("n"), F.avg("group_size").alias("mean"))
    found = [(r["size_class"], r["n"], r["mean"]) for r in classes.collect()]
    plan = assign(found, shards)
    spark = docs.sparkSession
    table = spark.createDataFrame(list(plan.items()), "size_class long, ends array<long>")
    many = sum(n for _, n, _ in found)
    placed = numbered(groups, "size_class", ["text_hash", "text_crc32", "size"], "number", 1 + many // BUCKET_ROWS)
    # Tens of thousands of classes at most, so the plan is small enough to broadcast.
    homes = placed.join(F.broadcast(table), "size_class").select(
        *key, F.size(F.filter("ends", lambda e: e <= F.col("number"))).alias("shard"))
    sharded = rows.join(homes, key)
    n = rows.count()
    return numbered(sharded, "shard", ["doc_id", "text_hash"], "slot", 1 + n // BUCKET_ROWS).select(
        "doc_id", "size", "text_crc32", "shard", "slot")
