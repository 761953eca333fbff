"""SimHash near-duplicates by the generalised pigeonhole principle (Qin, Wang, Xiao, Wang, Lin, Ishikawa 2018).

Fingerprints are cut into parts of correlated bits. Part i gets its own threshold t_i >= -1 with
sum(t_i + 1) = t + 1, so two fingerprints within t bits of each other are within t_i bits in at least one
part. The thresholds are the cheapest ones by dynamic programming over estimated candidate counts. Each
fingerprint probes the part values within t_i of its own; what it meets is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import small_batches, stored, whole_row
from leakscope.llm.components import components

BITS = 64


def _fingerprint(text: str | None, shingle: int, seed: int) -> int:
    words = text.encode().lower().split() if text else []  # bytes: ASCII letters and white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(s, seed) for s in map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at:at + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """64-bit SimHash of the word shingles of the ASCII-lower-cased text, repeats included.

    Fewer words than a shingle: the whole sequence is one. Null, empty or blank text: zero.
    """
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, shingle, seed) for t in texts], dtype="int64")

    return simhash(text)


@dataclass(frozen=True)
class Layout:
    """Bit masks of the parts (signed longs) and the threshold of each."""

    masks: tuple[int, ...]
    thresholds: tuple[int, ...]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _bits(mask: int) -> list[int]:
    return [b for b in range(BITS) if mask >> b & 1]


def _pair_counts(fps: DataFrame) -> tuple[np.ndarray, int]:
    """How often each two bits are both set, and the number of fingerprints: a 64 by 64 sum per task,
    added up by Spark."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for b in batches:
            raw = b["fp"].to_numpy("<i8").view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            total += (x.T @ x).astype(np.int64)
            n += len(x)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pd.DataFrame({"i": [*i, -1], "j": [*j, -1], "n": [*total.ravel(), n]})

    out, n = np.zeros((BITS, BITS)), 0
    for i, j, c in fps.select("fp").mapInPandas(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n")).collect():
        if i < 0:
            n = c
        else:
            out[i, j] = c
    return out, n


def _group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal width; each group grows by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            nxt = max(left, key=lambda b: (corr[b, group].mean(), -b))
            group.append(nxt)
            left.remove(nxt)
        groups.append(group)
    return groups


def _allocate(cost: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Thresholds t_i with sum(t_i + 1) = units at least cost; cost[i][u] is that of t_i = u - 1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (c, chosen) in best.items():
            for u in range(min(len(row) - 1, units - used) + 1):
                offer = (c + row[u], [*chosen, u - 1])
                if used + u not in nxt or offer < nxt[used + u]:
                    nxt[used + u] = offer
        best = nxt
    return best[units]


def plan(fps: DataFrame, distance: int, part_counts: tuple[int, ...] = (2, 3, 4)) -> Layout:
    """The cheapest layout: pairs that meet exactly in a part are counted, pairs within t bits follow
    from how often each of its bits differs; each probe costs as much as one candidate."""
    both, n = _pair_counts(fps)
    if not n:
        mask = (1 << BITS) - 1
        return Layout((_signed(mask),), (distance,))
    p = np.diag(both) / n
    same = p * p + (1 - p) * (1 - p)
    layouts = [[sum(1 << b for b in g) for g in _group_bits(both, n, m)] for m in part_counts]
    masks = sorted({m for layout in layouts for m in layout})
    values = fps.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("part", "value"))
    met = dict(values.groupBy("part", "value").agg(F.count("*").cast("double").alias("c"))
               .groupBy("part").agg(F.sum(F.col("c") * F.col("c"))).collect())
    cost: dict[int, list[float]] = {}
    for k, mask in enumerate(masks):
        ratio = [(1 - same[b]) / same[b] for b in _bits(mask)]
        sums = [1.0] + [0.0] * distance  # elementary symmetric sums of the ratios
        for r in ratio:
            for d in range(distance, 0, -1):
                sums[d] += r * sums[d - 1]
        row = [0.0]
        for t in range(distance + 1):
            ball = sum(comb(len(ratio), d) for d in range(t + 1))
            row.append(met[k] * sum(sums[:t + 1]) + n * ball)
        cost[mask] = row
    _, chosen, layout = min((*_allocate([cost[m] for m in layout], distance + 1), layout) for layout in layouts)
    kept = [(m, t) for m, t in zip(layout, chosen, strict=True) if t >= 0]
    return Layout(tuple(_signed(m) for m, _ in kept), tuple(t for _, t in kept))


def _near(value: Column, mask: int, t: int) -> Column:
    """All values that differ from this one in at most t bits of the mask."""
    flips = [_signed(sum(1 << b for b in c)) for d in range(t + 1) for c in combinations(_bits(mask % (1 << BITS)), d)]
    return F.transform(F.array(*[F.lit(f).cast("long") for f in flips]), lambda f: value.bitwiseXOR(f))


def links(fps: DataFrame, distance: int = 2, bucket: int = 64) -> DataFrame:
    """Links ``(src, dst)`` that join all distinct fingerprints (column ``fp``) within ``distance`` <= 2 bits.

    Buckets whose members times probes stay within ``bucket`` squared are joined and every pair is
    verified. Members of fuller ones meet by the values one bit away from them instead: two fingerprints
    are within two bits exactly if they share such a value or are one themselves, and at most 65 share
    one. So a hot bucket costs 65 rows per member, and no link is lost.
    """
    if not 0 <= distance <= 2:
        raise ValueError("distances up to 2 are supported")
    layout = plan(fps, distance)
    part = lambda k, m: F.col("fp").bitwiseAND(F.lit(m)).alias("value")
    index = probes = None
    for k, (m, t) in enumerate(zip(layout.masks, layout.thresholds, strict=True)):
        own = fps.select(F.lit(k).alias("part"), part(k, m), "fp")
        ask = fps.select(F.lit(k).alias("part"), F.explode(_near(F.col("fp").bitwiseAND(F.lit(m)), m, t)).alias("value"),
                         "fp") if t else own
        index = own if index is None else index.unionByName(own)
        probes = ask if probes is None else probes.unionByName(ask)
    key = ["part", "value"]
    load = (index.groupBy(*key).agg(F.count("*").alias("members"))
            .join(probes.groupBy(*key).agg(F.count("*").alias("asked")), key)
            .filter("asked > 1"))
    few = F.col("members") * F.col("asked") <= bucket * bucket
    calm, hot = load.filter(few).select(*key), load.filter(~few).select(*key)
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= distance
    met = (index.join(calm, key).withColumnRenamed("fp", "dst")
           .join(probes.withColumnRenamed("fp", "src"), key)
           .filter((F.col("dst") < F.col("src")) & near).select("src", "dst"))
    crowd = (index.join(hot, key).select("fp").unionByName(probes.join(hot, key).select("fp"))).distinct()
    if distance == 0:
        return met
    # At distance 1 the shared value must be one of the two, so only own values are asked for.
    around = crowd.select("fp", F.explode(_near(F.col("fp"), -1, 1)).alias("value"))
    if distance == 1:
        other = crowd.withColumnRenamed("fp", "dst")
        shared = around.withColumnRenamed("fp", "src").join(other, F.col("value") == F.col("dst")).select("src", "dst")
        return met.unionByName(shared.filter("dst < src"))
    first = around.groupBy("value").agg(F.sort_array(F.collect_set("fp")).alias("fps")).filter(F.size("fps") > 1)
    shared = first.select(F.explode(F.slice("fps", 2, 65)).alias("src"), F.col("fps")[0].alias("dst"))
    return met.unionByName(shared)


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, th, fp)``, ``th`` a hash of the text, and ``(fp, root)`` for each fingerprint."""
    small_batches(docs.sparkSession)
    text = F.col(text_col)
    marked = stored(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"),
                                fingerprint(text, shingle, seed).alias("fp")), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes.select("fp"), distance))
    return marked, classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    seed: int = 42, distance: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row.

    ``component_id`` is the least id reachable over links of fingerprints, the row's own included.
    Rows of equal fingerprint are one node, so copies cost nothing beyond their own row. Null ids are
    never the least; a component of null ids only has a null one. Blank texts share fingerprint zero.
    """
    marked, rooted = _grouped(docs, id_col, text_col, shingle, seed, distance)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42,
                distance: int = 2) -> DataFrame:
    """One whole row of each group of near-duplicates: that of the least id, null ids last, then of the least
    hash of its text; where rows repeat id and text, one of them."""
    marked, rooted = _grouped(docs, id_col, text_col, shingle, seed, distance)
    key = lambda i, th: (F.coalesce(i, F.lit(0)).alias("_i"), i.isNull().alias("_none"), th.alias("_th"))
    kept = marked.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("k")).select(
        *key(F.col("k.doc_id"), F.col("k.th")))
    keyed = docs.select(whole_row(docs), *key(F.col(id_col), F.xxhash64(text_col)))
    return keyed.join(kept, ["_i", "_none", "_th"], "left_semi").dropDuplicates(["_i", "_none", "_th"]).select("row.*")
