"""What the operators share: reading a table, and tables kept in the folder all executors see."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.session import shared_dir

ARROW_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
# Words end at the six ASCII white space characters; everything else belongs to a word.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows per Arrow batch than the default, since one text may be megabytes long."""
    if spark.conf.get(*ARROW_ROWS) == ARROW_ROWS[1]:
        spark.conf.set(ARROW_ROWS[0], str(rows))


def scratch(spark: SparkSession, name: str) -> str:
    """A folder not written before, below ``spark.checkpoint.dir``."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, lineage cut, one copy
    that outlives any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, by: str) -> DataFrame:
    """The same rows in as many parts as their own size asks for: what many tasks have few rows of is written to few files.

    For every part file in a local folder Hadoop starts child processes (``chmod``); until such a child runs its own program it
    shares the pages of the executor's JVM, and who adds up processes counts them twice.
    """
    return df.hint("rebalance", F.col(by))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``row``, so that columns set beside it clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def words(text: Column) -> Column:
    """Words of a text as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def numbered(df: DataFrame, group: str, order: list[str], name: str, buckets: int) -> DataFrame:
    """Gapless numbers from 0 within each group, in no task holding a whole group.

    Rows are dealt by ``order`` into hash buckets; a row's number is the rows of its group in earlier
    buckets plus its place in its own one. Rows equal in ``order`` are interchangeable.
    """
    from pyspark.sql import Window

    cut = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = cut.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = Window.partitionBy(group, "_bucket").orderBy(*order)
    return (cut.withColumn("_place", F.row_number().over(place) - 1)
            .join(starts, [group, "_bucket"])
            .withColumn(name, (F.col("_before") + F.col("_place")).cast("long"))
            .drop("_bucket", "_place", "_before"))
