"""Row-count, domain, key and reference checks of the platform tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.operators.keyed import duplicate_keys
from leakscope.sources.schemas import ENUMS


def domain_counts(df: DataFrame, column: str, domain: str) -> DataFrame:
    """How often each declared value occurs, unused ones included."""
    spark = df.sparkSession
    declared = spark.createDataFrame([(v, i) for i, v in enumerate(ENUMS[domain], 1)], "value string, position int")
    used = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return declared.join(used, "value", "left").select("value", "position", F.coalesce("n", F.lit(0)).alias("n"))


def outside_domain(df: DataFrame, column: str, domain: str) -> DataFrame:
    """Rows whose value is not in the declared domain; NULL is allowed."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(ENUMS[domain])))


def duplicate_count(df: DataFrame, key: list[str], name: str) -> DataFrame:
    return duplicate_keys(df, key).agg(F.count("*").alias("violations")).select(
        F.lit(f"unique {name}").alias("check"), "violations")


def orphan_count(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Child rows whose key names no parent; child keys are counted first, so a hot key joins as one row."""
    keys = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")).agg(F.count("*").alias("_n"))
    known = parent.select(F.col(parent_key).alias("_k"))
    return keys.join(known, "_k", "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("violations")).select(
        F.lit(f"reference {name}").alias("check"), "violations")


def domain_violations(df: DataFrame, column: str, domain: str) -> DataFrame:
    return outside_domain(df, column, domain).agg(F.count("*").alias("violations")).select(
        F.lit(f"domain {column}").alias("check"), "violations")


def all_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, NULLs, least and greatest value of every plain column, in one pass over the table.

    Values are compared in their own type and only then shown as text.
    """
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
    # Adding zero makes the two zeros of a floating-point column one.
    value = {f.name: F.col(f.name) + F.lit(0.0) if f.dataType.typeName() == "double" else F.col(f.name)
             for f in df.schema.fields}
    wide = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(plain)],
        *[F.min(value[c]).cast("string").alias(f"lo_{i}") for i, c in enumerate(plain)],
        *[F.max(value[c]).cast("string").alias(f"hi_{i}") for i, c in enumerate(plain)],
    )
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), (F.col("_rows") - F.col(f"n_{i}")).alias("nulls"),
            F.col(f"lo_{i}").alias("least"), F.col(f"hi_{i}").alias("greatest"))
        for i, c in enumerate(plain)])
    return wide.select(F.lit(table).alias("table_name"), F.col("_rows").alias("n_rows"), F.inline(entries))


def column_domains(df: DataFrame, table: str, most: int = 12) -> DataFrame:
    """``(table_name, column_name, n_values, allowed)`` of the text columns with at most ``most`` values; ``allowed`` lists them in
    order, quoted.

    A first pass estimates the number of values of every column with sketches of fixed size; only columns that may have so few
    are then gathered, as sets of bounded size, and counted exactly.
    """
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    few: list[str] = []
    if names:
        guess = df.agg(*[F.approx_count_distinct(c, 0.05).alias(f"d{i}") for i, c in enumerate(names)]).first()
        few = [c for i, c in enumerate(names) if 0 < guess[f"d{i}"] <= 2 * most]
    none = F.array().cast("array<struct<column_name:string,values:array<string>>>")
    sets = df.agg(*[F.array_sort(F.collect_set(c)).alias(f"v{i}") for i, c in enumerate(few)]) if few else df.limit(0).agg(F.count("*"))
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("values")) for i, c in enumerate(few)]) if few else none
    quoted = F.transform("values", lambda v: F.concat(F.lit("'"), v, F.lit("'")))
    return sets.select(F.inline(entries)).filter(F.size("values").between(1, most)).select(
        F.lit(table).alias("table_name"), "column_name", F.size("values").cast("long").alias("n_values"),
        F.array_join(quoted, ", ").alias("allowed"))
