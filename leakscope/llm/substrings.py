"""Repeated word windows found through super-k-mers (Li, Kamousi, Han, Yang, Yan, Suri 2013; Deorowicz and others 2015).

The minimiser of a window is the least hash among its short word groups. Neighbouring windows mostly share
it, and such a run travels as one packed string to the bucket of its minimiser; equal windows have equal
minimisers, so they meet there. A bucket is read sorted by document and place and its windows are compared
as whole strings: the first time a window is read is its first occurrence, all others are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import small_batches, stored

WINDOW = 20
GROUP = 4  # words a minimiser covers
# Runs of one minimiser beyond which its windows are compared by themselves (see ``repeats``).
HOT_RUNS = 50_000

_RUN = "bucket long, did long, th long, start int, packed binary"
_PLACE = "bucket long, did long, th long, start int, stop int"
_MARK = "did long, th long, start int, stop int"


def _mix(h: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


def _runs(text: str | None, window: int, group: int):
    """Bucket, first word and end of each run of windows that share a minimiser."""
    joined = b" ".join(text.encode().split()) if text else b""
    raw = np.frombuffer(joined, np.uint8)
    gaps = np.flatnonzero(raw == 32)
    n = len(gaps) + 1 if joined else 0
    if n < window:
        return None
    starts = np.concatenate([[0], gaps + 1])
    # A hash only chooses buckets, so long words may wrap around the powers.
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(raw)]])))
    word = _mix(np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255] * (raw != 32), starts))
    grams = np.zeros(n - group + 1, np.uint64)
    for g in range(group):
        grams = grams * np.uint64(0xD6E8FEB86659FD93) + word[g:n - group + 1 + g]
    grams = _mix(grams)
    least = np.lib.stride_tricks.sliding_window_view(grams, window - group + 1).argmin(axis=1) + np.arange(n - window + 1)
    first = np.flatnonzero(np.diff(least, prepend=-1))
    last = np.append(first[1:], len(least)) - 1
    # 48 bits tell minimisers apart and shuffle in less space than 64.
    return (grams[least[first]] >> np.uint64(16)).view(np.int64), first.astype(np.int32), (last + window).astype(np.int32)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with their key, the id (null ids count as the largest) and a 32-bit hash of the text, which only
    tells rows of one id apart, and the words of the text, joined by one space and compressed, as the text is what is shuffled."""
    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = b.column(3).to_pylist()
            small = pa.array([press.compress(b" ".join(t.encode().split()) if t else b"") for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], small], names=["doc_id", "did", "th", "words"])

    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("did"),
                       F.hash(text).cast("long").alias("th"), text.alias("text")).mapInArrow(
        compress, "doc_id long, did long, th long, words binary").filter(
        # Both joins ask for this, so with it they read the same shuffle.
        F.col("did").isNotNull() & F.col("th").isNotNull())


def _places(docs: DataFrame, id_col: str, text_col: str, window: int, group: int) -> DataFrame:
    """Bucket and word range of every run, without its words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [(i, got) for i, t in enumerate(b.column(2)) if (got := _runs(t.as_py(), window, group))]
            if parts:
                at = pa.array(np.repeat([i for i, _ in parts], [len(g[1]) for _, g in parts]))
                bucket, start, stop = (pa.array(np.concatenate([g[k] for _, g in parts])) for k in range(3))
                yield pa.RecordBatch.from_arrays([bucket, b.column(0).take(at), b.column(1).take(at), start, stop],
                                                 names=["bucket", "did", "th", "start", "stop"])

    text = F.col(text_col)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("did"),
                       F.hash(text).cast("long").alias("th"), text.alias("text")).mapInArrow(cut, _PLACE)


def _bucket_sizes(docs: DataFrame, text_col: str, window: int, group: int) -> DataFrame:
    """Runs per minimiser, added up within each batch before they are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [g[0] for t in b.column(0) if (g := _runs(t.as_py(), window, group))]
            if got:
                bucket, n = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(n)], names=["bucket", "n"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n"))


def _packed(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The words of the given runs, each one packed string. A document's runs are gathered, no more than it
    has words."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for b in batches:
            out: list[tuple] = []
            for did, th, small, runs in zip(*(b.column(c).to_pylist() for c in range(1, 5)), strict=True):
                joined = unpress.decompress(small)
                gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
                starts = np.concatenate([[0], gaps + 1]).tolist()
                stops = np.concatenate([gaps, [len(joined)]]).tolist()
                out += [(r["bucket"], did, th, r["start"], joined[starts[r["start"]]:stops[r["stop"] - 1]]) for r in runs]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                names=["bucket", "did", "th", "start", "packed"])

    per_doc = places.groupBy("did", "th").agg(F.collect_set(F.struct("bucket", "start", "stop")).alias("runs"))
    return rows.join(per_doc, ["did", "th"]).select("doc_id", "did", "th", "words", "runs").mapInArrow(pack, _RUN)


def _spans(places: list[int], window: int) -> list[tuple[int, int]]:
    """Word ranges covered by windows that start at the given ascending places."""
    out: list[tuple[int, int]] = []
    for p in places:
        if out and p <= out[-1][1]:
            out[-1] = (out[-1][0], p + window)
        else:
            out.append((p, p + window))
    return out


def _compare(runs: list[tuple], window: int) -> list[tuple]:
    """Marks of one bucket; runs are ``(did, th, start, packed)`` by document and place."""
    marks, seen, whole = [], {}, {}
    for did, th, start, packed in runs:
        at = whole.setdefault(packed, (did, start))
        if at != (did, start):  # the same run again: all of it repeats
            marks.append((did, th, start, start + packed.count(b" ") + 1))
            continue
        words = packed.split(b" ")
        again = []
        for i in range(len(words) - window + 1):
            if seen.setdefault(b" ".join(words[i:i + window]), (did, start + i)) < (did, start + i):
                again.append(start + i)
        marks += [(did, th, a, b) for a, b in _spans(again, window)]
    return marks


def _repeats_in_buckets(runs: DataFrame, window: int) -> DataFrame:
    """Marks from sorted buckets. Only the bucket being read is held, at most ``HOT_RUNS`` runs."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def marks(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([m[k] for m in found], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["did", "th", "start", "stop"])

        held: list[tuple] = []
        held_bucket = None
        for b in batches:
            bucket = b.column(0).to_numpy()
            if not len(bucket):
                continue
            edges = np.flatnonzero(np.diff(bucket)) + 1
            begin, end = np.concatenate([[0], edges]), np.concatenate([edges, [len(bucket)]])
            found = []
            # Buckets with one run hold no repeat: their windows have the minimiser at different places.
            shared = (end - begin > 1) | (begin == 0) | (end == len(bucket))
            at = pa.array(np.flatnonzero(np.repeat(shared, end - begin)))
            rows = list(zip(*(b.column(c).take(at).to_pylist() for c in range(1, 5)), strict=True))
            done = 0
            for k in np.flatnonzero(shared):
                mine = rows[done:done + int(end[k] - begin[k])]
                done += len(mine)
                if held_bucket == bucket[begin[k]]:
                    held += mine
                else:
                    found += _compare(held, window) if len(held) > 1 else []
                    held, held_bucket = mine, bucket[begin[k]]
            if found:
                yield marks(found)
        if len(held) > 1 and (found := _compare(held, window)):
            yield marks(found)

    return (runs.repartition("bucket").sortWithinPartitions("bucket", "did", "start")
            .select("bucket", "did", "th", "start", "packed").mapInArrow(read, _MARK))


def _repeats_by_window(runs: DataFrame, window: int) -> DataFrame:
    """Marks of hot buckets: every window is a row, its first place a partial aggregate, and the join back
    may be split where one window is very frequent."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for did, th, start, packed in zip(*(b.column(c).to_pylist() for c in range(1, 5)), strict=True):
                words = packed.split(b" ")
                rows += [(did, th, start + i, b" ".join(words[i:i + window])) for i in range(len(words) - window + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["did", "th", "at", "words"])

    rows = runs.select("bucket", "did", "th", "start", "packed").mapInArrow(
        windows, "did long, th long, at int, words binary")
    place = F.struct("did", "at")
    first = rows.groupBy("words").agg(F.min(place).alias("first"))
    return rows.join(first, "words").filter(F.col("first") < place).select(
        "did", "th", F.col("at").alias("start"), (F.col("at") + window).alias("stop"))


def repeats(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, window: int = WINDOW, group: int = GROUP,
            hot_runs: int = HOT_RUNS) -> DataFrame:
    """Word ranges ``(did, th, start, stop)`` covered by windows that start earlier as well.

    Runs are counted per minimiser first. A minimiser of one run holds no repeat, so only the others' runs
    are packed and sent. One with more than ``hot_runs`` runs (a passage that a large share of documents
    hold) would fill one task, so its windows are compared by themselves, each in its own group.
    """
    sizes = stored(_bucket_sizes(docs, text_col, window, group).filter("n > 1"), "repeated_minimisers")
    places = _places(docs, id_col, text_col, window, group)
    met = lambda some: places.join(sizes.filter(some).select("bucket"), "bucket")
    out = _repeats_in_buckets(_packed(rows, met(F.col("n") <= hot_runs)), window)
    if sizes.filter(F.col("n") > hot_runs).limit(1).count():
        out = out.unionByName(_repeats_by_window(_packed(rows, met(F.col("n") > hot_runs)), window))
    return out


def _keep(joined: bytes, starts, stops) -> tuple[str, int, int]:
    words = joined.split()
    if starts is None or not len(starts):
        return joined.decode(), len(words), 0
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, stops, -1)
    covered = np.cumsum(steps[:-1]) > 0
    kept = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
    return b" ".join(kept).decode(), len(words), len(words) - len(kept)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   group: int = GROUP, hot_runs: int = HOT_RUNS) -> DataFrame:
    """``(doc_id, kept_text, n_words, n_removed)`` of every row.

    A word goes if a window over it also starts earlier: in a smaller id, or in the same id at an earlier
    word. Rows of equal id and text are the same document and never remove each other's words; null ids
    come last. A null text has no words. Kept words are joined by one space.
    """
    small_batches(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)
    marks = repeats(docs, rows, id_col, text_col, window, group, hot_runs).groupBy("did", "th").agg(
        F.collect_set(F.struct("start", "stop")).alias("marks"))
    got = rows.join(marks, ["did", "th"], "left")
    return got.select("doc_id", _kept(F.col("words"), F.col("marks.start"), F.col("marks.stop")).alias("_k")).select("doc_id", "_k.*")


def _kept(words: Column, starts: Column, stops: Column) -> Column:
    @F.pandas_udf("kept_text string, n_words long, n_removed long")
    def keep(small: pd.Series, begin: pd.Series, end: pd.Series) -> pd.DataFrame:
        unpress = zstandard.ZstdDecompressor()
        return pd.DataFrame([_keep(unpress.decompress(w), a, b) for w, a, b in zip(small, begin, end, strict=True)],
                            columns=["kept_text", "n_words", "n_removed"])

    return keep(words, starts, stops)

