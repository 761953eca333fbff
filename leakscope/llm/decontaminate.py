"""Benchmark passages in texts: one Aho-Corasick automaton over all normalised item windows, one scan a text."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import small_batches, stored, whole_row

# Bytes of window text one automaton is built from (its nodes take some 50 times as much). A larger
# benchmark is scanned in several passes, each with the windows of some of the items.
AUTOMATON_BYTES = 8 << 20

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Upper case to lower case, and every byte that belongs to no word to a space; UTF-8 letters are kept.
_NORMAL = bytes((b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else b + 32 if 65 <= b < 91 else 32) for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_NORMAL).split() if text else []


def windows(text: str | None, size: int) -> set[bytes]:
    """Windows of ``size`` words; a shorter text that has words is one window."""
    words = normal_words(text)
    return {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


class Automaton:
    """Windows to the items that hold them. Texts are scanned as bytes seen as Latin-1 characters."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        owners: dict[bytes, set[str]] = defaultdict(set)
        for item, text in items:
            for w in windows(text, size):
                owners[w].add(item)
        self.owners = [sorted(o) for o in owners.values()]
        self.words = [w.count(b" ") + 1 for w in owners]
        self.trie = ahocorasick.Automaton()
        for k, w in enumerate(owners):
            # Spaces at both ends keep matches to whole words.
            self.trie.add_word(f" {w.decode('latin-1')} ", k)
        if owners:
            self.trie.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, hit word ranges ``[start, stop)`` merged, and the items found."""
        words = normal_words(text)
        if not words or not self.owners:
            return len(words), [], []
        line = " " + b" ".join(words).decode("latin-1") + " "
        found = list(self.trie.iter(line))
        if not found:
            return len(words), [], []
        gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        # A match ends on the space behind its last word: the j-th space stands behind word j - 1.
        stops = np.searchsorted(gaps, [end for end, _ in found]).tolist()
        spans = sorted((stop - self.words[k], stop) for stop, (_, k) in zip(stops, found, strict=True))
        merged: list[tuple[int, int]] = []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return len(words), merged, sorted({o for k in {k for _, k in found} for o in self.owners[k]})


def _original(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as code point ranges of the original text."""
    raw = text.encode()
    places = [(m.start(), m.end()) for m in _WORD.finditer(raw.lower())]
    heads = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # code points up to and with each byte
    return [(int(heads[places[a][0]]) - 1, int(heads[places[b - 1][1] - 1])) for a, b in spans]


def _item_batches(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Items in batches whose windows stay within ``limit`` bytes, read one after the other."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    batch: list[tuple[str, str]] = []
    held = 0
    for item, text in items.toLocalIterator():
        size = 13 * len(text.encode())
        if held and held + size > limit:
            yield batch
            batch, held = [], 0
        batch.append((item, text))
        held += size
    yield batch


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 13, keep_rows: bool = False,
                  limit: int = AUTOMATON_BYTES) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, spans, contaminated)`` of every row, with ``keep_rows`` the ``row`` too.

    ``items`` are the ids, as strings, of items with an occurring window; ``spans`` the hit passages as
    code point ranges of the original text. A text is contaminated if at least one in twenty of its words
    lies in such a passage. Null texts have no words; items without words are never found; a null item
    id counts as an empty string. One automaton holds the windows of at most ``limit`` bytes of items; a
    larger benchmark takes several, each in a job of its own over the rows kept in the shared folder, so that
    driver and workers hold one at a time.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    kept = [whole_row(docs)] if keep_rows else []
    scanned = docs.select(*kept, F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    passes = []
    for k, items in enumerate(_item_batches(benchmark, item_col, item_text_col, limit)):
        if k:
            scanned = stored(scanned, "scanned")
        automaton = spark.sparkContext.broadcast((items, window))
        scanned = scanned.withColumn(f"_scan{k}", _scan(automaton)(F.col("_text")))
        passes.append(f"_scan{k}")
    ranges = F.array_distinct(F.concat(*[F.col(f"{p}.hit") for p in passes]))
    covered = F.array_distinct(F.flatten(F.transform(ranges, lambda r: F.sequence(r["start"], r["stop"] - 1))))
    one = len(passes) == 1
    first = F.col(passes[0])
    out = scanned.select(
        *[c for c in scanned.columns if c not in passes and c != "_text"],
        first["n_words"].alias("n_words"),
        (first["n_hit"] if one else F.size(covered)).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.concat(*[F.col(f"{p}.items") for p in passes]))).alias("items"),
        F.array_sort(F.array_distinct(F.concat(*[F.col(f"{p}.spans") for p in passes]))).alias("spans"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows that are not contaminated, as they are."""
    return contamination(docs, benchmark, keep_rows=True, **options).filter(~F.col("contaminated")).select("row.*")


_last: list = []  # the items last seen by this worker process, and their automaton


def _automaton(shared) -> Automaton:
    """The automaton of a broadcast item batch, built once per worker process."""
    items, window = shared.value
    if not _last or _last[0] is not items:
        _last[:] = [items, Automaton(items, window)]
    return _last[1]


def _scan(shared):
    span = "array<struct<start:int,stop:int>>"

    @F.pandas_udf(f"n_words long, n_hit long, hit {span}, items array<string>, spans {span}")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(shared)
        for texts in batches:
            rows = []
            for t in texts:
                n, spans, items = automaton.scan(t)
                rows.append((n, sum(b - a for a, b in spans), [{"start": a, "stop": b} for a, b in spans], items,
                             [{"start": a, "stop": b} for a, b in _original(t, spans)] if spans else []))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "hit", "items", "spans"])

    return scan
