"""Centroid search, phrase graph and WARC archive: odd rows, brute force, round trips."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakscope.llm import centroids, phrases, warc
from leakscope.llm.common import scratch

# ---- centroid clustering -------------------------------------------------------------------------------------

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("cluster", T.StringType()), T.StructField("id", T.IntegerType()), T.StructField("v", T.IntegerType())])


def plain_clusters(rows, k, rounds, width):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) and abs(x) < 1 << 19 for x in v)]
    digest = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    points = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), n) for n, p in enumerate(points)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for n in range(len(points)):
            mine = [v for (_, v), (_, c) in zip(kept, at, strict=True) if c == n]
            if mine:
                points[n] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    at = assign()
    total = Counter()
    for d, n in at:
        total[n] += d
    return Counter((i, n, d, total[n], sum(total.values()), tuple(points[n])) for (i, _), (d, n) in zip(kept, at, strict=True))


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 2, 4).tolist()) for i in range(120)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 280)]  # a hot vector, ties
    rows += [(300, None), (301, [1.0]), (302, [1.0, None, 1.0, 1.0]), (303, [math.nan] * 4), (304, [math.inf, 0.0, 0.0, 0.0]),
             (None, [1.0, 2.0, 3.0, 4.0]), (None, [1.0, 2.0, 3.0, 4.0]), (5, [-9.0, 0.0, 0.0, 1.0]), (305, [1e30, 0.0, 0.0, 0.0]),
             (306, [5e5, -5e5, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)
    got = centroids.cluster(frame, k=7, rounds=3, width=4).collect()
    assert Counter((r.vec_id, *r[1:5], tuple(r.centroid)) for r in got) == plain_clusters(rows, 7, 3, 4)
    few = centroids.cluster(frame.filter("vec_id < 3"), k=7, rounds=2, width=4).collect()
    assert sorted(r.distance for r in few) == [0, 0, 0]
    assert centroids.cluster(frame.filter("false"), k=7, width=4).count() == 0


def test_search_is_exact_and_skips_most(spark):
    rng = np.random.default_rng(6)
    for scale in (3, 1000, 1 << 26):
        middle = rng.integers(-scale, scale, (40, 64))
        block = (middle[rng.integers(0, 40, 3000)] + rng.integers(-max(1, scale // 9), max(1, scale // 9), (3000, 64))).astype(np.int64)
        block[:500] = block[0]
        who, best, computed = centroids.nearest(block, centroids.Centroids.of(middle))
        d = ((block[:, None, :] - middle[None]) ** 2).sum(axis=2)
        assert (best == d.min(axis=1)).all() and (who == d.argmin(axis=1)).all()
        if scale > 3:
            assert computed < 0.35 * d.size


# ---- phrases -------------------------------------------------------------------------------------------------


def plain_counts(rows, top=4):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            counts.update((lang or "und", tuple(w[i:i + m])) for m in range(1, top + 1) for i in range(len(w) - m + 1))
    return counts, total


def plain_phrases(rows, least, best):
    counts, total = plain_counts(rows)
    found = {k: n for k, n in counts.items() if n >= least and len(k[1]) > 1}
    out = []
    for lang in total:
        own = {p: n for (g, p), n in found.items() if g == lang}
        scored = []
        for p, a in own.items():
            cuts = [(2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(100 * n >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, n in own.items() if len(q) > len(p))
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


TEXTS = [("en", "A b c d e f g h. A B C D E\tf g h, x y x y x y x y x y x y"), ("en", "a b c d q; a b c d q"), ("de", None), (None, ""),
         (None, "  \t. , é É é É z é É z"), ("en", "loop loop loop loop loop loop loop loop"), ("fr", "\x1cone two\x85 three"),
         ("en", "very rare words that nobody repeats"), ("fr\n", "one two three four five one two three four five\x00 one two")]


@pytest.mark.parametrize("least,best,slab", [(2, 2000, 6 << 20), (2, 5, 40), (3, 2000, 1)])
def test_phrases_of_odd_texts(spark, monkeypatch, least, best, slab):
    monkeypatch.setattr(phrases, "SLAB", slab)  # tasks hold the module by name; the default slab is met there
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(12)]
    rows = TEXTS * 2 + [("en", " ".join(rng.choice(words, rng.integers(1, 40)))) for _ in range(40)]
    frame = spark.createDataFrame([(lang, t, "p", 1) for lang, t in rows], "lang string, text string, phrase string, n int")
    got = phrases.collocations(frame, least=least, best=best).collect()
    assert sorted(tuple(r) for r in got) == plain_phrases(rows, least, best)
    assert phrases.collocations(frame.filter("false"), least=least).count() == 0


def test_flows_count_every_run(spark):
    """Counts told by flow, ends and paths are those of the text, for every length."""
    rng = np.random.default_rng(10)
    line = " ".join(f"long{i}" for i in range(200))  # one path of 197 edges
    rows = [("en", line)] * 5 + [("en", line + " end")] + [("en", " ".join(rng.choice(list("abc"), 9)) + ".") for _ in range(60)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    got = {tuple(r) for r in phrases.counts(frame, least=3).select("lang", "phrase", "n").filter("phrase is not null").collect()}
    assert got == {(g, " ".join(p), n) for (g, p), n in plain_counts(rows)[0].items() if n >= 3}


def test_slab_counts(spark):
    """Packing and unpacking by slabs, without Spark."""
    rows = [("en", t) for _, t in TEXTS if t]
    packed = [p for _, t in rows for p in phrases.count_slab("en", t.encode(), 4, [0, 2, 2, 3])]
    tops = [p for p in packed if p[1] == 3]
    want = {p: n for (_, p), n in plain_counts(rows)[0].items() if len(p) == 4}
    seen = Counter()
    for b in {p[2] for p in tops}:
        own = [p for p in tops if p[2] == b]
        got, counts, words = phrases.unpack([p[3] for p in own], [p[4] for p in own])
        for r, n in zip(got, counts, strict=True):
            if r[3]:
                seen[tuple(words[i - 1].decode() for i in r)] += int(n)
    assert seen == want


# ---- WARC ----------------------------------------------------------------------------------------------------

PAGES = [(3, "http://a/?q=é", "x" * 150), (1, "http://b\r\nX: y", "x" * 150), (2, None, "x" * 150), (4, "http://c", "short"),
         (5, "http://d", "short"), (6, "http://e", None), (7, "http://f", ""), (None, "http://g", "x" * 150), (8, "h", "é" * 49 + "zz"),
         (9, "h", "é" * 49 + "zz"), (10, "%41", "y" * 100_000), (None, "n", "n" * 200), (None, "n", "n" * 200), (8, "h", "é" * 49 + "zz")]


def test_archive_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARE", 2)  # hot payloads are copied
    frame = spark.createDataFrame([(*p, "d", 1, 2, "b") for p in PAGES],
                                  "page_id long, url string, html string, digest string, size int, records int, payload string")
    path = scratch(spark, "warc_test")
    warc.write_archive(frame, path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in PAGES})
    rows = warc.read_archive(spark, path).withColumn("whole", warc.record_bytes()).collect()
    assert len(rows) == len(PAGES)
    first = {}
    for i, _, h in PAGES:
        h = h or ""
        if i is not None and (first.get(h) is None or i < first[h]):
            first[h] = i
    want, got = Counter(), Counter()
    for i, _, h in PAGES:
        again = len((h or "").encode()) >= 100 and i != first.get(h or "")
        want[i, h or "", "revisit" if again else "response", first[h] if again else None] += 1
    for r in rows:
        head, _, rest = bytes(r.whole).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert len(rest) == int(fields["Content-Length"]) + 4 and rest.endswith(b"\r\n\r\n")
        payload = bytes(r.payload)
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
        page = lambda u: int(u[10:-1]) if u and u != "<urn:page:>" else None
        body = rest[:-4].partition(b"\r\n\r\n")[2]
        assert body == (payload if fields["WARC-Type"] == "response" else b"")
        got[page(fields["WARC-Record-ID"]), payload.decode(), fields["WARC-Type"], page(fields.get("WARC-Refers-To"))] += 1
    assert got == want
    empty = scratch(spark, "warc_test")
    warc.write_archive(frame.filter("false"), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_a_changed_payload_is_told(spark):
    path, broken = scratch(spark, "warc_test"), scratch(spark, "warc_test")
    warc.write_archive(spark.createDataFrame([(1, "u", "x" * 120)], "page_id long, url string, html string"), path)
    spark.read.parquet(f"{path}/headers").write.parquet(f"{broken}/headers")
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other")).write.parquet(f"{broken}/payloads")
    with pytest.raises(Exception, match="does not have digest"):
        warc.read_archive(spark, broken).collect()
