"""Near-duplicates by the Jaccard similarity of word shingles: SimHash fingerprints within two bits (:mod:`leakscope.llm.simhash`)
link first, banded MinHash finds what lies further apart (Broder 1997; Leskovec, Rajaraman, Ullman 2014), the whole
shingle sets decide on every link.

Two sets of similarity s agree in a band of r minima with probability s^r. With 40 bands of 5 a pair at 0.8
shares none once in eight million cases. All fingerprints that links join are a bucket as well. Buckets of copies become
one component when their members meet a leader. Members of buckets that stay split are joined exactly by the rare ends of their sets (prefix and position filters:
Chaudhuri, Ganti, Kaushik 2006; Xiao, Wang, Lin, Yu 2008), so a crowd just below the threshold does not meet in pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import gathered, small_batches, stored, whole_row
from leakscope.llm.components import components
from leakscope.llm.simhash import fingerprint
from leakscope.llm.simhash import links as fingerprint_links

BANDS, ROWS = 40, 5
CHUNK = 1024  # shingles worked on at once
LEADERS = 2  # rounds in which a bucket's members meet one of them, before the rest is joined by rare shingles


def _shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than a shingle are one, no words none."""
    words = text.encode().lower().split() if text else []  # bytes: ASCII letters and white space only
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter(
        (digest(s) for s in map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))), np.uint64))


def _factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1997)
    draw = lambda: rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
    return draw() << np.uint64(1) | np.uint64(1), draw()


def _bands(shingles: np.ndarray, factor: np.ndarray, mask: np.ndarray) -> list[int]:
    """One hash per band of the least values under ``BANDS * ROWS`` orders of the shingles."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        mixed = (shingles[at:at + CHUNK, None] ^ mask) * factor
        least = np.minimum(least, (mixed ^ mixed >> np.uint64(32)).min(axis=0))
    return [xxhash.xxh64_intdigest(b.tobytes()) for b in least.reshape(BANDS, ROWS)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _key(i: Column, th: Column) -> tuple[Column, ...]:
    """A row's id and text in columns that join null ids too."""
    return F.coalesce(i, F.lit(0)).alias("_i"), i.isNull().alias("_none"), th.alias("_th")


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Rows ``(fp, n, bands, sims, k)`` of each distinct set of ``n`` shingles, ``k`` its first row: least id, then text;
    ``sims`` the SimHashes of its rows, which differ where shingles repeat."""
    @F.pandas_udf("fp long, n int, bands array<long>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        factor, mask = _factors()
        rows = []
        for text in texts:
            s = _shingles(text, shingle)
            rows.append((_signed(xxhash.xxh64_intdigest(s.tobytes())), len(s),
                         [_signed(b) for b in _bands(s, factor, mask)]))
        return pd.DataFrame(rows, columns=["fp", "n", "bands"])

    i = F.col(id_col)
    marked = docs.select(F.struct(i.isNull(), i.alias("doc_id"), F.xxhash64(text_col).alias("th")).alias("k"),
                         fingerprint(F.col(text_col), shingle).alias("sim"),
                         sketch(F.col(text_col)).alias("s")).select("k", "sim", "s.*")
    return stored(marked.groupBy("fp").agg(F.first("n").alias("n"), F.first("bands").alias("bands"),
                                           F.collect_set("sim").alias("sims"), F.min("k").alias("k")), "classes")


def _sets(docs: DataFrame, id_col: str, text_col: str, shingle: int, classes: DataFrame) -> DataFrame:
    """``(fp, items)``: the sorted shingles of the first text of each of these classes."""
    @F.pandas_udf("array<long>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([_shingles(t, shingle).view(np.int64) for t in texts])

    keyed = docs.select(*_key(F.col(id_col), F.xxhash64(text_col)), F.col(text_col).alias("text"))
    firsts = classes.select("fp", *_key(F.col("k.doc_id"), F.col("k.th")))
    one = keyed.join(firsts, ["_i", "_none", "_th"]).select("fp", "text").dropDuplicates(["fp"])
    return stored(one.select("fp", cut("text").alias("items")), "shingle_sets")


def _near(pairs: DataFrame, sets: DataFrame, tenths: int) -> DataFrame:
    """The pairs ``(src, dst)`` whose sets share ``tenths`` tenths of their union or more."""
    both, all_ = F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b")
    return (pairs.join(sets.select(F.col("fp").alias("src"), F.col("items").alias("a")), "src")
            .join(sets.select(F.col("fp").alias("dst"), F.col("items").alias("b")), "dst")
            .filter(10 * both >= tenths * (all_ - both)).select("src", "dst"))


def _rare_pairs(members: DataFrame, sets: DataFrame, tenths: int) -> DataFrame:
    """Pairs of ``members (fp, n, root)`` with other roots that can share ``tenths`` tenths of their shingles: every
    such pair is among them.

    Shingles are ordered by the number of members that have them. Sets of n and m shingles that are alike share at
    least ``tenths (n + m) / (10 + tenths)``; the first shared one stands at places that leave so many in both.
    """
    tokens = members.join(sets, "fp").select("fp", "n", "root", F.explode("items").alias("t"))
    shared = tokens.groupBy("t").agg(F.count("*").alias("df")).filter("df > 1")
    ordered = tokens.join(shared, "t").groupBy("fp", "n", "root").agg(
        F.array_sort(F.collect_list(F.struct("df", "t"))).alias("s"))
    # Shingles of one member alone come first and meet nobody.
    placed = ordered.select("fp", "n", "root", F.posexplode("s").alias("at", "s"), F.size("s").alias("k")).select(
        "fp", "n", "root", "s.t", (F.col("k") - F.col("at")).alias("rest"))
    front = stored(gathered(placed.filter(F.col("rest") * 10 >= F.col("n") * tenths), "fp"), "minhash_fronts")
    apart = front.groupBy("t").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("t")
    left = front.join(apart, "t")
    other = left.select("t", F.col("fp").alias("other"), F.col("n").alias("m"), F.col("root").alias("at"),
                        F.col("rest").alias("others_rest"))
    enough = (10 + tenths) * F.least("rest", "others_rest") >= tenths * (F.col("n") + F.col("m"))
    return left.join(other, "t").filter((F.col("fp") > F.col("other")) & (F.col("root") != F.col("at")) & enough).select(
        F.col("fp").alias("src"), F.col("other").alias("dst")).distinct()


def _meetings(told: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(sim, fp, n)``: a leader of each fingerprint of ``told (fp, n, sim)``; ``(src, dst)``: links of fingerprints within two bits."""
    leader = F.min(F.struct("fp", "n")).alias("lead")
    leaders = stored(told.groupBy("sim").agg(leader).select("sim", F.col("lead.fp").alias("fp"), F.col("lead.n").alias("n")), "leaders")
    return leaders, stored(gathered(fingerprint_links(leaders.select(F.col("sim").alias("fp"))), "src"), "simhash_links")


def _fingerprint_pairs(told: DataFrame, meetings: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Candidates ``(src, dst, n, m)``: each class with the leader of its fingerprint, and leaders whose fingerprints are linked."""
    leaders, met = meetings or _meetings(told)
    named = lambda sim, fp, n: leaders.select(F.col("sim").alias(sim), F.col("fp").alias(fp), F.col("n").alias(n))
    same = told.select("sim", F.col("fp").alias("src"), "n").join(named("sim", "dst", "m"), "sim").select("src", "dst", "n", "m")
    near = (met.join(named("_s", "a", "n"), F.col("src") == F.col("_s")).join(named("_d", "b", "m"), F.col("dst") == F.col("_d"))
            .select(F.col("a").alias("src"), F.col("b").alias("dst"), "n", "m"))
    return same.unionByName(near).filter("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"), "n", "m")


def _fingerprint_buckets(told: DataFrame, met: DataFrame) -> DataFrame:
    """``(fp, n, band, value)``: each class in the bucket of all fingerprints that links join to one of its own."""
    roots = components(met).withColumnRenamed("node", "sim")
    return told.select("fp", "n", "sim").join(roots, "sim", "left").select(
        "fp", "n", F.lit(-1).alias("band"), F.coalesce("root", "sim").alias("value")).distinct()


def _links(classes: DataFrame, cut_sets, tenths: int, told: DataFrame | None = None) -> DataFrame | None:
    """Links ``(src, dst)`` that join all classes which share a band or linked fingerprints, and ``tenths`` tenths; None
    without any.

    Classes whose fingerprints are within two bits are linked first, if their sets are alike. Then the members of a
    bucket, of linked fingerprints or of a band, meet one leader of it, so a bucket of copies costs one pair per member.
    Members of buckets that are still several components are joined by their rare shingles: no link is lost, whoever leads.
    ``cut_sets`` makes the sets of the classes it is given; ``told (fp, n, sim)`` has all fingerprints of a class, else
    ``classes`` has the one.
    """
    told = classes if told is None else told
    meetings = _meetings(told)
    key = ["band", "value"]
    spread = classes.select("fp", "n", F.posexplode("bands").alias("band", "value")).unionByName(
        _fingerprint_buckets(told, meetings[1]))
    shared = spread.groupBy(*key).agg(F.count("*").alias("members")).filter("members > 1").select(*key)
    crowd = stored(gathered(spread.join(shared, key), "fp"), "minhash_buckets")
    even = F.least("n", "m") * 10 >= F.greatest("n", "m") * tenths
    first = stored(_fingerprint_pairs(told, meetings).filter(even).select("src", "dst").distinct(), "fingerprint_pairs")
    if crowd.isEmpty() and first.isEmpty():
        return None
    compared = crowd.select("fp").unionByName(first.select(F.col("src").alias("fp"))).unionByName(
        first.select(F.col("dst").alias("fp"))).distinct()
    sets = cut_sets(classes.join(compared, "fp", "left_semi"))
    like = even & (F.col("root") != F.col("at"))
    found, asked = stored(gathered(_near(first, sets, tenths), "src"), "fingerprint_links"), first
    for turn in range(LEADERS + 1):
        roots = components(found).withColumnRenamed("node", "fp")
        now = stored(crowd.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "minhash_members")
        lead = F.min(F.struct(F.xxhash64(F.lit(turn), "fp"), "fp", "n", "root")).alias("lead")
        apart = now.groupBy(*key).agg(F.min("root").alias("low"), F.max("root").alias("high"), lead).filter("low < high")
        if turn < LEADERS:
            met = now.join(apart, key).select("fp", "n", "root", F.col("lead.fp").alias("other"),
                                              F.col("lead.n").alias("m"), F.col("lead.root").alias("at"))
            pairs = met.filter(like).select(F.greatest("fp", "other").alias("src"), F.least("fp", "other").alias("dst")).distinct()
        else:
            pairs = _rare_pairs(now.join(apart.select(*key), key).select("fp", "n", "root").distinct(), sets, tenths)
        pairs = stored(pairs.join(asked, ["src", "dst"], "left_anti"), "minhash_pairs")
        found = found.unionByName(stored(gathered(_near(pairs, sets, tenths), "src"), "minhash_links"))
        asked = asked.unionByName(pairs)
    return found


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                tenths: int = 8) -> DataFrame:
    """One whole row of each group of near-duplicates: that of the least id, null ids last, then of the least
    hash of its text; where rows repeat id and text, one of them.

    Texts are linked if their sets of ``shingle``-word shingles, ASCII letters lower-cased, have a Jaccard
    similarity of ``tenths`` tenths or more. Texts without words have equal sets.
    """
    small_batches(docs.sparkSession)
    classes = _classes(docs, id_col, text_col, shingle)
    links = _links(classes, lambda some: _sets(docs, id_col, text_col, shingle, some), tenths,
                   classes.select("fp", "n", F.explode("sims").alias("sim")))
    kept = classes.select("fp", "k")
    if links is not None:
        roots = components(links).withColumnRenamed("node", "fp")
        kept = kept.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("k").alias("k"))
    key = ["_i", "_none", "_th"]
    keyed = docs.select(whole_row(docs), *_key(F.col(id_col), F.xxhash64(text_col)))
    return keyed.join(kept.select(*_key(F.col("k.doc_id"), F.col("k.th"))), key, "left_semi").dropDuplicates(key).select("row.*")
