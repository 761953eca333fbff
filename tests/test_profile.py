"""Merged profiles equal those of the whole within the sketches' error, and a grown table is read only where it is new."""

import uuid

import pytest
from pyspark.sql import functions as F

from leakscope.operators import profile


@pytest.fixture()
def folder(spark, plat):
    return f"{plat.root}/scratch/profile-{uuid.uuid4().hex[:12]}"


def _rows(spark, a, b):
    return spark.range(a, b).select(
        "id", (F.col("id") % 1000).cast("double").alias("value"), F.concat(F.lit("name "), F.col("id") % 7).alias("file"),
        F.when(F.col("id") % 4 == 0, "x").alias("n_rows"), F.lit(None).cast("int").alias("none"), F.array("id").alias("list"))


def test_files_merge(spark, folder):
    _rows(spark, 0, 20_000).repartition(5).write.parquet(folder)
    kept = profile.unseen(spark, spark.read.parquet(folder), None, "t").cache()
    assert kept.select("file").distinct().count() == 5
    assert profile.unseen(spark, spark.read.parquet(folder), kept, "t") is None
    _rows(spark, 20_000, 30_000).repartition(2).write.mode("append").parquet(folder)
    more = profile.unseen(spark, spark.read.parquet(folder), kept, "t")
    assert more.select("file").distinct().count() == 2
    got = {r.column_name: r for r in profile.merged(kept.unionByName(more)).collect()}
    assert set(got) == {"id", "value", "file", "n_rows", "none"}
    assert all(r.n_rows == 30_000 for r in got.values())
    assert [got[c].nulls for c in ("id", "n_rows", "none")] == [0, 22_500, 30_000]
    assert abs(got["id"].n_distinct - 30_000) <= 1500 and abs(got["value"].n_distinct - 1000) <= 50
    assert got["file"].n_distinct == 7 and got["n_rows"].n_distinct == 1 and got["none"].n_distinct == 0
    assert all(abs(q - want) <= 25 for q, want in zip(got["value"].quartiles, (250, 500, 750), strict=True))
    assert got["file"].quartiles is None and got["none"].quartiles is None
    assert {t.item for t in got["file"].top} <= {f"name {i}" for i in range(7)} and len(got["file"].top) == 5


def test_exact_counts(spark):
    got = {r.column_name: r.n for r in profile.distinct_counts(_rows(spark, 0, 3000), "t").collect()}
    assert got == {"id": 3000, "value": 1000, "file": 7, "n_rows": 1, "none": 0}
    empty = {r.column_name: r.n for r in profile.distinct_counts(_rows(spark, 0, 0), "t").collect()}
    assert empty == {}
