"""Token id files: one concatenated id array per block, document boundaries in Elias-Fano code.

A block is one binary value ``EFT1``: a header, the ids (little-endian, 2 bytes each where all fit, else 4),
then two Elias-Fano sequences: where each document's ids end, and the document ids. A monotone sequence of
m values below u takes about 2 + log2(u / m) bits a value: the low bits packed, the high bits in unary,
with the place of every 256th one kept so that any value is found by a short select.

Blocks lie as rows of a Parquet table, so Spark's commit makes the files whole or absent, on any store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leakscope.llm.common import small_batches
from leakscope.llm.token_ids import token_ids

MAGIC = b"EFT1"
HEADER = struct.Struct("<4sBBHIQqq")  # magic, id width, spare, spare, null ids, ids, documents, least doc id
SEQUENCE = struct.Struct("<QBQQQ")  # values, low bits, bytes of low part, of high part, of samples
SAMPLE = 256
# Ids a block holds before it is closed; a longer document fills a block of its own.
BLOCK_IDS = 1_000_000

SCHEMA = "part int, block int, n_docs long, n_ids long, payload binary"


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit values."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.samples = low, high, np.frombuffer(samples, "<u8")

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        bits = np.zeros((n, low_bits), np.uint8)
        for b in range(low_bits):
            bits[:, b] = values >> np.uint64(b) & np.uint64(1)
        low = np.packbits(bits.ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low.tobytes(), np.packbits(bits, bitorder="little").tobytes(),
                   ones[::SAMPLE].astype("<u8").tobytes())

    def to_bytes(self) -> bytes:
        samples = self.samples.tobytes()
        return SEQUENCE.pack(self.n, self.low_bits, len(self.low), len(self.high), len(samples)) + self.low + self.high + samples

    @classmethod
    def from_bytes(cls, data: memoryview, at: int) -> tuple["EliasFano", int]:
        n, low_bits, a, b, c = SEQUENCE.unpack_from(data, at)
        at += SEQUENCE.size
        return cls(n, low_bits, bytes(data[at:at + a]), bytes(data[at + a:at + a + b]),
                   bytes(data[at + a + b:at + a + b + c])), at + a + b + c

    def _low(self, i: int) -> int:
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        raw = int.from_bytes(self.low[first // 8:(last + 7) // 8], "little")
        return raw >> first % 8 & (1 << self.low_bits) - 1

    def __getitem__(self, i: int) -> int:
        """Value i by select: from the nearest sample on, bytes are skipped by their number of ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, word = at // 8, self.high[at // 8] >> at % 8 << at % 8
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return one - i << self.low_bits | self._low(i)

    def decode(self) -> np.ndarray:
        """All values, without tables."""
        if not self.n:
            return np.zeros(0, np.uint64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.low_bits)
            for b, column in enumerate(bits.reshape(self.n, self.low_bits).T):
                out |= column.astype(np.uint64) << np.uint64(b)
        return out


def pack_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One block; ``doc_ids`` ascending, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    least = int(known[0]) if len(known) else 0
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    head = HEADER.pack(MAGIC, width, 0, 0, nulls, len(ids), len(doc_ids), least)
    # Unsigned differences hold the whole range of signed ids.
    offsets = known.view(np.uint64) - np.array(least, np.int64).view(np.uint64)
    return b"".join([head, ids.astype(f"<u{width}").tobytes(), EliasFano.encode(np.cumsum(lengths)).to_bytes(),
                     EliasFano.encode(offsets).to_bytes()])


class Block:
    """A block read back; ``span(i)`` gives one document's ids without decoding the other boundaries."""

    def __init__(self, payload: bytes):
        data = memoryview(payload)
        magic, width, _, _, self.nulls, n_ids, self.n, self.least = HEADER.unpack_from(data, 0)
        if magic != MAGIC:
            raise ValueError("not a token block")
        end = HEADER.size + n_ids * width
        self.ids = np.frombuffer(data[HEADER.size:end], f"<u{width}")
        self.ends, end = EliasFano.from_bytes(data, end)
        self.offsets, _ = EliasFano.from_bytes(data, end)

    def span(self, i: int) -> np.ndarray:
        return self.ids[self.ends[i - 1] if i else 0:self.ends[i]]

    def bounds(self) -> np.ndarray:
        """Where each document ends, by one select each."""
        return np.fromiter((self.ends[i] for i in range(self.n)), np.int64, self.n)

    def doc_ids(self) -> list[int | None]:
        known = (self.offsets.decode() + np.array(self.least, np.int64).view(np.uint64)).view(np.int64)
        return [None] * self.nulls + known.tolist()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          block_ids: int = BLOCK_IDS) -> None:
    """Token ids of all texts, in ascending id order, as blocks below ``path``.

    Each document ends with ``end_id``; a null text is an empty one. Null ids come first; rows of equal
    id follow a hash of their text. The text is dealt by id ranges once and encoded in its sorted part, so
    a part is written from one stream and blocks are the only state.
    """
    small_batches(docs.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal block, held
            n = np.concatenate(lengths)
            payload = pack_block(doc_ids, n, np.concatenate(ids))
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(n)], pa.int64()),
                 pa.array([int(n.sum())], pa.int64()), pa.array([payload], pa.binary())],
                names=["part", "block", "n_docs", "n_ids", "payload"])
            doc_ids.clear(), lengths.clear(), ids.clear()
            block, held = block + 1, 0
            return out

        encoder = token_ids(tokenizer)
        for b in batches:
            names, at = b.column(0).to_pylist(), 0
            for flat, n in encoder.encode(b.column(1)):
                ends = np.cumsum(n)
                doc_ids += names[at:at + len(n)]
                at += len(n)
                lengths.append(n + 1)
                ids.append(np.insert(flat, ends, end_id))
                held += len(ids[-1])
                if held >= block_ids:
                    yield close()
        if doc_ids:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(blocks, SCHEMA).write.parquet(path))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document from the files at ``path``.

    ``start`` counts the ids of all documents before it. Only block heads are summed: first per part, then
    over parts.
    """
    files = spark.read.schema(SCHEMA).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, block, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                got = Block(payload.as_buffer())
                ends = got.bounds()
                starts = np.concatenate([[0], ends[:-1]])
                wide = memoryview(got.ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(wide[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int32()),
                     pa.array(got.doc_ids(), pa.int64()), pa.array(starts), pa.array(ends - starts),
                     pa.array(crc, pa.int64())],
                    names=["part", "block", "doc_id", "local", "n_tokens", "ids_crc32"])

    heads = files.select("part", "block", "n_ids")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("all_ids")).withColumn(
        "part_start", F.coalesce(F.sum("all_ids").over(before(Window.orderBy("part"))), F.lit(0)))
    starts = heads.withColumn(
        "block_start", F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("block"))), F.lit(0))
    ).join(parts, "part").select("part", "block", (F.col("block_start") + F.col("part_start")).alias("first"))
    rows = files.select("part", "block", "payload").mapInArrow(
        documents, "part int, block int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
