"""Column profiles that merge: one row of sketches per file and column, kept between runs.

Distinct values are HyperLogLog sketches, quantiles of numbers KLL sketches, frequent values frequent-item
sketches, all of bounded size. A profile of a table is the union of those of its files, so only files not seen
before are read when a table grows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

# Share of a text that counts for its frequent value: the first characters, as whole texts are not frequent.
SHOWN = 64
FREQUENT = 5
QUANTILES = (0.25, 0.5, 0.75)
_NESTED = ("array", "map", "struct", "variant")


def plain_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if f.dataType.typeName() not in _NESTED]


def file_profiles(rows: DataFrame, table: str) -> DataFrame:
    """``(table_name, file, column_name, n_rows, nulls, distinct, quantiles, frequent)`` of file-backed rows.

    One pass and one aggregation with a row per file; partial sketches are merged before the shuffle. Nested columns are left
    out. ``quantiles`` is null for columns that are not numbers and where all values are null; a NaN has no place among them.
    """
    names = plain_columns(rows.schema)
    file = F.col("_metadata.file_path")
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    # Places instead of names: a column may be called like one of this table's own.
    placed = rows.select(file.alias("file"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])

    def number(i: int, c: str) -> Column:
        value = F.col(f"c{i}").cast("double")
        return F.when(~F.isnan(value), value)

    def shown(i: int) -> Column:
        return F.col(f"c{i}").cast("string")

    def frequent(i: int) -> Column:
        return F.call_function("approx_top_k_accumulate", F.substring(shown(i), 1, SHOWN), F.lit(1000))

    wide = placed.groupBy("file").agg(
        F.count("*").alias("n_rows"),
        *[F.count(f"c{i}").alias(f"n{i}") for i in range(len(names))],
        *[F.hll_sketch_agg(shown(i)).alias(f"d{i}") for i in range(len(names))],
        *[F.kll_sketch_agg_double(number(i, c)).alias(f"q{i}") for i, c in enumerate(names) if isinstance(kinds[c], NumericType)],
        *[frequent(i).alias(f"t{i}") for i in range(len(names))])
    entries = F.array(*[F.struct(
        F.lit(c).alias("column_name"), (F.col("n_rows") - F.col(f"n{i}")).alias("nulls"), F.col(f"d{i}").alias("distinct"),
        (F.col(f"q{i}") if isinstance(kinds[c], NumericType) else F.lit(None).cast("binary")).alias("quantiles"),
        F.col(f"t{i}").alias("frequent")) for i, c in enumerate(names)])
    return wide.select(F.lit(table).alias("table_name"), "file", "n_rows", F.inline(entries))


def _name(path: str) -> str:
    """A file's address with one slash behind its scheme: it is written with one or three."""
    return re.sub("^([a-z0-9]+:)/+", r"\1/", path)


def unseen(spark: SparkSession, rows: DataFrame, kept: DataFrame | None, table: str) -> DataFrame | None:
    """Profiles of the table's files that ``kept`` does not hold yet; null if there are none. Only those files are read."""
    have = set() if kept is None else {
        _name(r.file) for r in kept.filter(F.col("table_name") == table).select("file").distinct().collect()}
    wanted = [f for f in rows.inputFiles() if _name(f) not in have]
    if not wanted:
        return None
    return file_profiles(spark.read.schema(rows.schema).parquet(*wanted), table)


def merged(profiles: DataFrame) -> DataFrame:
    """``(table_name, column_name, n_rows, nulls, n_distinct, quartiles, top)`` of whole tables.

    ``n_distinct`` is an estimate (standard error about 1.6 %), quartiles within about 1.3 % of rank, ``top`` the
    most frequent values, texts cut to their first characters.
    """
    return profiles.groupBy("table_name", "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double("quantiles").alias("q"),
        F.call_function("approx_top_k_estimate", F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(1000)),
                        F.lit(FREQUENT)).alias("top"),
    ).select("table_name", "column_name", "n_rows", "nulls", "n_distinct",
             F.when(F.kll_sketch_get_n_double("q") > 0, F.kll_sketch_get_quantile_double(
                 "q", F.array(*map(F.lit, QUANTILES)))).alias("quartiles"), "top")


def distinct_counts(rows: DataFrame, table: str) -> DataFrame:
    """``(table_name, column_name, n)``: exact distinct values of every plain column, to hold the estimates against.

    Values are compared by 64-bit hashes and reduced per task before the shuffle, so a hot value is one row a task.
    """
    names = plain_columns(rows.schema)
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(
        F.col(f"`{c}`").cast("string"))).alias("h")) for i, c in enumerate(names)])
    counts = rows.select(F.inline(entries)).distinct().groupBy("i").agg(F.count("h").alias("n"))
    return counts.select(F.lit(table).alias("table_name"), F.get(F.array(*map(F.lit, names)), "i").alias("column_name"), "n")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
