"""Files in and out: schema-checked reads, and versioned tables that readers can use while a new
version is written."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.sources.schemas import scores_csv_schema, table_schema

# Rows that are still to get derived columns are placed in smaller parts than the default of 64 MB, as they grow there.
DERIVED_SIZE = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
# Rows that are packed or unpacked in Arrow batches are large ones: a whole document, or what many have in common.
UNPACKED_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "128")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A platform table stored as Parquet, with its declared schema."""
    return spark.read.schema(table_schema(name)).parquet(f"{folder}/{name}")


def read_scores_csv(spark: SparkSession, path: str) -> DataFrame:
    """The score export: header, comma, double quote, UTF-8; missing columns take their defaults.

    ``mode=FAILFAST`` because a bulk load must not turn a bad line into NULLs.
    """
    rows = (
        spark.read.schema(scores_csv_schema())
        .option("header", True).option("sep", ",").option("quote", '"').option("escape", '"')
        .option("encoding", "UTF-8").option("multiLine", False).option("mode", "FAILFAST")
        .csv(path)
    )
    return (
        rows.withColumn("leakage_scenarios", F.lit(None).cast("array<string>"))
        .withColumn("scored_at", F.current_timestamp())
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, split over as many files as there are tasks."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_documents_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Hand-written documents, one JSON object per line; doubled quotes become single ones."""
    schema = table_schema("rag.documents")
    wanted = [f for f in schema.fields if f.name not in ("content_tsv",)]
    rows = spark.read.schema(type(schema)(wanted)).json(path)
    fix = [F.replace(F.col(c), F.lit("''"), F.lit("'")).alias(c) if c == "content" else F.col(c)
           for c in rows.columns]
    return rows.select(*fix)


class TableStore:
    """Parquet tables under one shared folder, one sub-folder per written version.

    A version is visible once its ``_SUCCESS`` marker exists; readers always take the newest such
    version and a running job never overwrites a path it reads.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path

    def _versions(self, name: str, complete_only: bool) -> list[int]:
        fs, path = self._fs(f"{self.root}/{name}")
        if not fs.exists(path):
            return []
        found = []
        for status in fs.listStatus(path):
            folder = status.getPath().getName()
            if not folder.startswith("v"):
                continue
            marker = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if not complete_only or fs.exists(marker):
                found.append(int(folder[1:]))
        return sorted(found)

    def path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{version:06d}"

    def exists(self, name: str) -> bool:
        return bool(self._versions(name, complete_only=True))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        if version is None:
            version = self._versions(name, complete_only=True)[-1]
        return self.spark.read.parquet(self.path(name, version))

    def replace(self, name: str, df: DataFrame, partition_by: list[str] | None = None,
                sort_by: list[str] | None = None, derived: dict[str, Column] | None = None,
                unpack: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Write ``df`` as the next version and read it back.

        With ``partition_by`` rows are first rebalanced on those columns: small values are merged
        into one file and a value that holds much of the data is split over several tasks. ``sort_by`` orders
        the rows of each file. ``derived`` columns are made of the others where the rows are written, so they are never shuffled.
        ``unpack`` makes several rows of a placed one, there as well; it keeps the columns of ``partition_by``.
        """
        taken = self._versions(name, complete_only=False)
        target = self.path(name, (taken[-1] if taken else 0) + 1)
        if partition_by:
            placed = df.hint("rebalance", *partition_by).withColumns(derived or {})
            if unpack:
                placed = unpack(placed)
            if sort_by:
                placed = placed.sortWithinPartitions(*partition_by, *sort_by)
            with self._set([DERIVED_SIZE] * bool(derived or unpack) + [UNPACKED_ROWS] * bool(unpack)):
                placed.write.partitionBy(*partition_by).parquet(target)
        else:
            df = df.withColumns(derived or {})
            with self._set([UNPACKED_ROWS] * bool(unpack)):
                (unpack(df) if unpack else df).write.parquet(target)
        return self.spark.read.parquet(target)

    @contextmanager
    def _set(self, settings: list[tuple[str, str]]) -> Iterator[None]:
        """Settings of the session for a while."""
        before = [(name, self.spark.conf.get(name)) for name, _ in settings]
        try:
            for name, value in settings:
                self.spark.conf.set(name, value)
            yield
        finally:
            for name, value in before:
                self.spark.conf.set(name, value)

    def latest_before(self, name: str, version: int) -> int:
        """Newest complete version older than ``version``."""
        return [v for v in self._versions(name, complete_only=True) if v < version][-1]

    def last_batch(self, name: str) -> int:
        """Highest finished ``batch=`` folder of a side table, -1 for none."""
        fs, path = self._fs(f"{self.root}/{name}")
        if not fs.exists(path):
            return -1
        jvm_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        folders = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=")]
        done = [int(f.getName()[6:]) for f in folders if fs.exists(jvm_path(f, "_SUCCESS"))]
        return max(done, default=-1)

    def put(self, name: str, df: DataFrame, version: int) -> None:
        """Write a given version, over an unfinished earlier attempt at it."""
        df.write.mode("overwrite").parquet(self.path(name, version))

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """Add rows to the current version in place (plain insert)."""
        versions = self._versions(name, complete_only=True)
        if not versions:
            return self.replace(name, df)
        target = self.path(name, versions[-1])
        df.write.mode("append").parquet(target)
        return self.spark.read.parquet(target)
