"""Connected components of a link table by alternating large-star and small-star steps
(Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import stored


def _least(links: DataFrame, both: bool) -> DataFrame:
    """One step: every node's neighbours (larger ones, or smaller ones) hang on its least neighbour.

    ``links`` has src > dst. The least neighbour is a partial aggregate; the join back may be split
    by adaptive execution where a node has very many links.
    """
    if both:
        around = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    else:
        around = links
    least = around.groupBy("src").agg(F.min("dst").alias("least")).select(
        "src", F.least("src", "least").alias("least"))
    met = around.join(least, "src")
    if both:
        out = met.filter("dst > src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    else:
        out = met.select(F.col("dst").alias("src"), F.col("least").alias("dst")).unionByName(
            least.select("src", F.col("least").alias("dst")))
    return out.filter("src > dst").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(src, dst)`` of a long type, any direction -> ``(node, root)`` for each linked node.

    The root is the least node of the component and is listed too. Steps repeat until the links no
    longer change, O(log^2 n) of them; each result is a table in the shared folder.
    """
    now = stored(links.filter("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "links")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(src, dst))")).first())

    state = mark(now)
    while state[0]:
        now = stored(_least(_least(now, True), False), "links")
        new = mark(now)
        if new == state:
            break
        state = new
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
        now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct())
