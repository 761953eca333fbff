"""Sum-of-squares packing of token sequences (Csirik, Johnson, Kenyon, Orlin, Shor, Weber 2006).

Each piece goes where the sum over gaps of (open sequences with that gap) squared becomes smallest.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import small_batches, stored
from leakscope.llm.token_ids import token_ids

# Pieces packed together by one task. Each task leaves some sequences unfilled at its end; at this
# number they are a small share, and the packing of a task stays within seconds and megabytes.
PIECES_PER_TASK = 65_536


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed in the given order.

    With N(g) open sequences of gap g, a piece of length s in a sequence of gap g changes the sum by
    2 (N(g - s) - N(g)) + 2, or by 1 - 2 N(s) where it fills the gap, or by 2 N(capacity - s) + 1 in a new
    sequence. Ties go to the smallest gap, then to an open sequence.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_by_gap: dict[int, list[int]] = defaultdict(list)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        if s == capacity:
            bins[i], made = made, made + 1
            continue
        best, change = -1, 2 * int(count[capacity - s]) + 1
        here = count[s + 1:capacity]
        if len(here):
            delta = 2 * (count[1:capacity - s] - here) + 2
            delta[here == 0] = np.iinfo(np.int64).max
            k = int(delta.argmin())
            if delta[k] <= change and here[k]:
                best, change = s + 1 + k, int(delta[k])
        if count[s] and 1 - 2 * int(count[s]) <= change:
            best = s
        if best < 0:
            home, gap = made, capacity
            made += 1
        else:
            home, gap = open_by_gap[best].pop(), best
            count[best] -= 1
        bins[i], offsets[i] = home, capacity - gap
        if gap > s:
            open_by_gap[gap - s].append(home)
            count[gap - s] += 1
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, uid)``: the ids of each text, cut where longer than
    ``capacity``; ``uid`` numbers the pieces."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 40
        encoder = token_ids(tokenizer)
        for b in batches:
            names, at = b.column(0), 0
            for flat, n in encoder.encode(b.column(1)):
                ids = np.insert(flat, np.cumsum(n), end_id).astype("<u4", copy=False)
                n = n + 1
                per_doc = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), per_doc)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
                start = piece * capacity
                length = np.minimum(capacity, n[doc] - start)
                raw, first = memoryview(ids).cast("B"), ((np.cumsum(n) - n)[doc] + start).tolist()
                crc = [zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(first, length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(doc + at)).cast(pa.int64()), pa.array(piece, pa.int32()), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64()), pa.array(uid + np.arange(len(doc)))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "uid"])
                uid += len(doc)
                at += len(n)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, uid long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id",
         text_col: str = "text", per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece.

    A null text is an empty one and still has its end id. Full pieces are sequences of their own and are
    not moved. Only the numbers of the others are dealt out, by a hash of their number, so that hot
    sources or copies spread evenly; a task places its pieces by falling length, so copies of a text and
    the order of rows make no difference.
    """
    parts = stored(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces")
    whole = parts.filter(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("uid").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    rest = parts.filter(F.col("length") < capacity)
    tasks = max(1, -(-rest.count() // per_task))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        got = [b for b in batches if len(b)]
        if not got:
            return
        rows = pd.concat(got, ignore_index=True)
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], kind="stable", ignore_index=True)
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        base = TaskContext.get().partitionId() << 40
        rows["sequence_id"] = -1 - base - bins  # below zero: never the number of a full piece
        rows["offset"] = offsets
        yield rows[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return whole.unionByName(rest.repartition(tasks, "uid").mapInPandas(place, schema))
