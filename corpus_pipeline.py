"""From documents to packed sequences: language, near-duplicates, benchmark passages, personal data, packing.

Each stage takes what the one before kept, as a table read back from the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.llm import decontaminate, langid, minhash, packing, pii
from leakscope.llm.common import read, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; null texts and those without a letter go."""
    return langid.known_only(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, Jaccard 0.8), that of the least id. All
    that linked SimHash fingerprints or a band bring together meet, and the whole shingle sets decide."""
    return minhash.one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

# Learned models, fingerprints and tokens have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
