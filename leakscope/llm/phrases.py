"""Collocations from a weighted de Bruijn graph of each language's text.

Nodes are runs of ``top - 1`` words, edges runs of ``top`` words with the times they occur inside a piece of text.
Only edges and the ends of pieces are counted in the text. Every other count is a flow: a node occurs as often
as its outgoing edges say plus the pieces that end with it, and a shorter run as often as the runs one word
longer that it begins plus the pieces that end with it. Edges of the frequent part are then compacted: where a
node has all its occurrences from one edge and to one edge, both are one path with one count.

Tasks count in slabs of text and send runs packed by bucket, so a run is shuffled once per slab, not per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from leakscope.llm.common import small_batches, stored

# Characters that end a piece, and the other word gap, after lower-casing A-Z.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b"\t"
FOLD = bytes(10 if b in ENDS else 32 if b in GAPS else b + 32 if 65 <= b <= 90 else b for b in range(256))
STOP = b"\xff"  # between pieces; no byte of UTF-8 text
SLAB = 6 << 20  # bytes of text counted at once
BUCKET = 8 << 20  # characters of text per bucket of runs
PACKED = "lang string, level int, bucket int, words binary, runs binary"


def fold(rows: np.ndarray, size: int) -> np.ndarray:
    """One integer per row of numbers below ``size``; equal for equal rows."""
    out, limit = rows[:, 0].astype(np.int64), size
    for c in range(1, rows.shape[1]):
        if limit * size >= 1 << 62:
            seen, out = np.unique(out, return_inverse=True)
            limit = len(seen)
        out = out * size + rows[:, c]
        limit *= size
    return out


def tally(rows: np.ndarray, counts: np.ndarray | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sum of their counts (1 each if None)."""
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    code = fold(rows, size)
    order = np.argsort(code)
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    total = np.diff(starts, append=len(order)) if counts is None else np.add.reduceat(counts[order], starts)
    return rows[order[starts]], total


def pack(lang: str, level: int, rows: np.ndarray, counts: np.ndarray, words: np.ndarray, buckets: int,
         key: int) -> Iterator[tuple]:
    """Packed rows by bucket of their first ``key`` words. Numbers in ``rows`` are word places plus 1, 0 is no word."""
    if not len(rows):
        return
    marks = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    mixed = np.full(len(rows), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for c in range(key):
        mixed = (mixed ^ marks[rows[:, c] - 1]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    bucket = (mixed % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part = order[a:b]
        used, local = np.unique(rows[part], return_inverse=True)
        local = local.reshape(len(part), -1) + (1 if used[0] else 0)
        text = b"\n".join(words[used[used > 0] - 1])
        runs = np.concatenate([local.T.astype("<u4").ravel(), counts[part].astype("<u8").view("<u4")])
        planes = runs.view(np.uint8).reshape(-1, 4).T.tobytes()  # first bytes, then second ones, ...
        yield lang, level, int(bucket[part[0]]), _deflate(text), len(part).to_bytes(4, "little") + _deflate(planes)


def unpack(words: list[bytes], runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, counts and words of packed rows of one bucket, merged."""
    texts, rows, counts, at = [], [], [], 0
    for w, r in zip(words, runs, strict=True):
        text = pc.split_pattern(pa.array([_inflate(w)], pa.binary()), "\n").flatten()
        n = int.from_bytes(r[:4], "little")
        flat = np.ascontiguousarray(np.frombuffer(_inflate(r[4:]), np.uint8).reshape(4, -1).T).view("<u4")[:, 0]
        width = len(flat) // n - 2
        local = flat[:n * width].reshape(width, n).T.astype(np.int64)
        rows.append(np.where(local > 0, local + at, 0))
        counts.append(flat[n * width:].view("<u8").astype(np.int64))
        texts.append(text)
        at += len(text)
    coded = pa.concat_arrays(texts).dictionary_encode()
    place = np.concatenate([[0], coded.indices.to_numpy(zero_copy_only=False) + 1]).astype(np.int32)
    rows, counts = tally(place[np.concatenate(rows)], np.concatenate(counts), len(coded.dictionary) + 1)
    return rows, counts, _listed(coded.dictionary)


def _listed(words: pa.Array) -> np.ndarray:
    out = np.empty(len(words), object)
    out[:] = words.to_pylist()
    return out


def _deflate(data: bytes) -> bytes:
    return pa.compress(data, "zstd", asbytes=True)


def _inflate(data: bytes) -> bytes:
    return pa.CompressedInputStream(pa.BufferReader(data), "zstd").read()


def count_slab(lang: str, text: bytes, top: int, buckets: list[int]) -> Iterator[tuple]:
    """Packed edges and piece ends of a slab of one language."""
    tokens = text.translate(FOLD).replace(b"\n", b" \xff ").split(b" ")
    coded = pa.array([STOP, *filter(None, tokens), STOP], pa.binary()).dictionary_encode()
    del tokens
    ids = coded.indices.to_numpy(zero_copy_only=False)  # STOP is 0, words start at 1
    words, size = _listed(coded.dictionary)[1:], len(coded.dictionary)
    if size == 1:
        return
    last = np.flatnonzero((ids[:-1] > 0) & (ids[1:] == 0))
    for level in range(1, top):  # pieces end with their last 1, 2, ... words
        last = last[ids[last - level + 1] > 0]  # the text starts with a STOP, so no place lies before it
        ends = np.stack([ids[last - i] for i in range(level - 1, -1, -1)], axis=1)
        if level < top - 1:
            yield from pack(lang, level, *tally(ends, None, size), words, buckets[level], level)
    inside = ids > 0
    count = max(0, len(ids) - top + 1)
    spots = np.flatnonzero(np.logical_and.reduce([inside[i:i + count] for i in range(top)]))
    both = np.zeros((len(spots) + len(ends), top), np.int32)
    for i in range(top):
        both[:len(spots), i] = ids[spots + i]
    both[len(spots):, :top - 1] = ends  # an edge to no word
    yield from pack(lang, top - 1, *tally(both, None, size), words, buckets[top - 1], top - 1)


def flows(packed: DataFrame, level: int, least: int, buckets: list[int]) -> DataFrame:
    """Counts of all runs of ``level`` words, from the packed rows of that level.

    Rows ``(lang, phrase, words, n)`` for runs found ``least`` times or more (with the edges, for the top level),
    and packed rows for the levels below, merged. The lowest level also gives the words of each language, as phrase null.
    """
    def merge(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        lang, own = key[0], int(key[1])
        rows, counts, words = unpack(batch["words"].to_list(), batch["runs"].to_list())
        size, out = len(words) + 1, []

        def frequent(rows: np.ndarray, counts: np.ndarray) -> None:
            some = np.flatnonzero(counts >= least)
            names = [words[c - 1] for c in rows[some].T]
            out.extend((lang, b" ".join(p).decode(), rows.shape[1], int(n), None, None, None, None)
                       for p, n in zip(zip(*names, strict=True), counts[some], strict=True))

        if own < level:  # ends of pieces that the next level counts
            return frame(list((lang, None, None, None, *p[1:])
                              for p in pack(lang, own, rows, counts, words, buckets[own], own)))
        if rows.shape[1] > level:
            edge = rows[:, level] > 0
            frequent(rows[edge], counts[edge])
            rows, counts = tally(rows[:, :level], counts, size)
        frequent(rows, counts)
        if level > 1:
            shorter, total = tally(rows[:, :level - 1], counts, size)
            out.extend((lang, None, None, None, *p[1:])
                       for p in pack(lang, level - 1, shorter, total, words, buckets[level - 1], level - 1))
        else:
            out.append((lang, None, 0, int(counts.sum()), None, None, None, None))
        return frame(out)

    def frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["lang", "phrase", "words_", "n", "level", "bucket", "words", "runs"]).astype(
            {"words_": "Int32", "n": "Int64", "level": "Int32", "bucket": "Int32"})

    return packed.groupBy("lang", "level", "bucket").applyInPandas(
        merge, "lang string, phrase string, words_ int, n long, level int, bucket int, words binary, runs binary")


def _last(phrase: str, words: int) -> Column:
    return F.substring_index(F.col(phrase), " ", -words)


def compact(edges: DataFrame, nodes: DataFrame, top: int) -> DataFrame:
    """Edges ``(lang, phrase, n)`` joined to paths ``(lang, path, n)`` through nodes that have all their occurrences
    from one edge and to one edge.

    Each edge learns its predecessor, then by doubling the first edge of its path and its place in it. Every
    occurrence of a path lies in one piece, so a path is no longer than a piece. Edges that run in a circle
    have no first one; they stay paths of one edge.
    """
    # Whoever carries all of a node's occurrences is its only edge on that side.
    through = edges.select("lang", F.col("phrase").alias("before"), "n", _last("phrase", top - 1).alias("node")).join(
        nodes.select("lang", F.col("phrase").alias("node"), "n"), ["lang", "node", "n"])
    head = F.substring_index("phrase", " ", top - 1)
    linked = edges.select("lang", "phrase", "n", head.alias("node")).join(
        through, ["lang", "node", "n"], "left").select(
        "lang", "phrase", "n", "before", F.when(F.col("before").isNotNull(), 1).otherwise(0).alias("place"),
        F.coalesce("before", "phrase").alias("first"))
    at = stored(linked.select("lang", "phrase", "n", "first", "place", F.col("before").isNull().alias("done")), "paths")
    open_ = at.filter(~F.col("done")).count()
    while open_:
        far = at.select("lang", F.col("phrase").alias("first"), F.col("first").alias("next"), F.col("place").alias("more"),
                        F.col("done").alias("at_end"))
        # Only edges still under way move; who has arrived is kept as it is.
        step = at.filter(~F.col("done")).join(far, ["lang", "first"]).select(
            "lang", "phrase", "n", F.col("next").alias("first"), (F.col("place") + F.col("more")).alias("place"),
            F.col("at_end").alias("done"))
        at = stored(at.filter("done").unionByName(step), "paths")
        left = at.filter(~F.col("done")).count()
        if left == open_:
            break  # what is left are circles
        open_ = left
    alone = F.when(F.col("done"), F.col("first")).otherwise(F.col("phrase"))
    part = F.when(~F.col("done") | (F.col("place") == 0), F.col("phrase")).otherwise(_last("phrase", 1))
    return at.groupBy("lang", alone.alias("first")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", part.alias("part")))), lambda x: x["part"]), " ").alias("path"),
        F.first("n").alias("n"))


def _runs(path: Column, words: int) -> Column:
    """All runs of so many words of a path, as an array."""
    cut = F.split(path, " ")
    return F.transform(F.sequence(F.lit(1), F.size(cut) - words + 1), lambda i: F.array_join(F.slice(cut, i, words), " "))


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = 4, least: int = 30) -> DataFrame:
    """``(lang, phrase, words, n)`` of all runs of 1 to ``top`` words that occur ``least`` times or more within pieces,
    and one row per language with words 0 that counts all its words."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text_col}`").alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    most = max(4, chars // BUCKET)
    buckets = [0, *[max(4, most // (2 ** (top - 1 - level))) for level in range(1, top)]]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list[bytes]] = {}
        held: dict[str, int] = {}
        frame = lambda got: pd.DataFrame(got, columns=["lang", "level", "bucket", "words", "runs"])
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                if not text:
                    continue
                data = text.encode()
                waiting.setdefault(lang, []).append(data)
                held[lang] = held.get(lang, 0) + len(data)
                if held[lang] >= SLAB:
                    held[lang] = 0
                    yield frame(list(count_slab(lang, b"\n".join(waiting.pop(lang)), top, buckets)))
                    pa.default_memory_pool().release_unused()
                elif sum(held.values()) >= 2 * SLAB:  # many small languages
                    for each in list(waiting):
                        yield frame(list(count_slab(each, b"\n".join(waiting.pop(each)), top, buckets)))
                    held.clear()
        for lang in list(waiting):
            yield frame(list(count_slab(lang, b"\n".join(waiting.pop(lang)), top, buckets)))
            pa.default_memory_pool().release_unused()

    frequent, packed = [], rows.mapInPandas(count, PACKED)
    for level in range(top - 1, 0, -1):
        got = stored(flows(packed, level, least, buckets), f"runs_{level}")
        frequent.append(got.filter("words_ is not null").select("lang", "phrase", F.col("words_").alias("words"), "n"))
        packed = got.filter("level is not null").select("lang", "level", "bucket", "words", "runs")
    edges, nodes = (frequent[0].filter(F.col("words") == w) for w in (top, top - 1))
    paths = stored(compact(edges, nodes, top), "phrase_paths")
    # A path tells the counts of its edges and of the nodes inside it; other nodes keep their own row.
    inner = paths.filter(F.size(F.split("path", " ")) > top).select(
        "lang", F.explode(_runs(F.expr("substring(path, locate(' ', path) + 1)"), top - 1)).alias("phrase"), "path", "n")
    inner = inner.filter(F.col("phrase") != _last("path", top - 1)).select("lang", "phrase", F.lit(top - 1).alias("words"), "n")
    told = paths.select("lang", F.explode(_runs(F.col("path"), top)).alias("phrase"), F.lit(top).alias("words"), "n")
    outer = nodes.join(inner.select("lang", "phrase"), ["lang", "phrase"], "left_anti").select("lang", "phrase", "words", "n")
    out = told.unionByName(inner).unionByName(outer)
    for got in frequent[1:]:
        out = out.unionByName(got)
    return out


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = 4, least: int = 30,
                 inside: int = 80, best: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``best`` phrases of 2 to ``top`` words.

    A-Z are lower-cased, pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. A phrase found ``a >= least``
    times scores ``floor(2000000 a / (l + r))`` at its lowest-scoring cut into a part found ``l`` times and one found ``r``
    times (ties: the earliest cut). It is dropped if it lies inside a longer phrase, itself found ``least`` times, with at
    least ``inside`` percent of its count. Order: score, a, both falling, then the phrase in byte order. Null texts are
    empty, a null language is ``und``; an empty table gives no rows.
    """
    all_ = stored(counts(docs, text_col, lang_col, top, least), "phrase_counts")
    grams = all_.filter("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"))
    cut = grams.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    left, right = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - words)")
    part = lambda name, n: all_.filter(F.col("words").between(1, top - 1)).select(
        "lang", F.col("phrase").alias(name), F.col("n").alias(n))
    met = cut.select("*", left.alias("left"), right.alias("right")).join(part("left", "l"), ["lang", "left"]).join(
        part("right", "r"), ["lang", "right"])
    big = lambda c: F.col(c).cast("decimal(20,0)")
    met = met.withColumn("score", F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    worst = met.groupBy("lang", "phrase", "a", "words").agg(F.min(F.struct("score", "k", "l", "r")).alias("w"))
    subs = grams.filter("words > 2").select("lang", "a", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1), lambda m: _runs(F.col("phrase"), m)))).alias("phrase"))
    longer = subs.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = worst.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (big("longer") * 100 < big("a") * inside))
    order = Window.partitionBy("lang").orderBy(F.desc("w.score"), F.desc("a"), "phrase")
    top_rows = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    total = all_.filter("words = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return top_rows.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "w.l", "w.r", "n",
                                               "w.score")
