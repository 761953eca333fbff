"""Near-duplicates of the pipeline by Jaccard similarity, against all pairs."""

from collections import defaultdict

import brute
import numpy as np
import pytest
from conftest import SF

from leakscope.llm import minhash
from leakscope.llm.common import read
from leakscope.llm.simhash import _fingerprint


def shingles(text, size=5):
    w = [x.lower() if x.isascii() else x for x in brute.words(text)]
    size = min(size, len(w))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if w else frozenset()


def kept_ids(texts):
    """Least id of each component of texts that share 0.8 of their shingles."""
    ids, root = sorted(texts), {d: d for d in texts}
    sets = {d: shingles(texts[d]) for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    meet, pairs = defaultdict(list), set()
    for d in ids:
        for s in sets[d] or {None}:
            pairs.update((e, d) for e in meet[s])
            meet[s].append(d)
    for a, b in pairs:
        if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {find(d) for d in ids}


def test_near_duplicates_of_the_pipeline(spark):
    """Two pairs of the smallest table differ in more bits than op2 allows."""
    import corpus_pipeline

    docs = read(spark, SF, "documents")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    want = kept_ids({r.doc_id: r.text for r in docs.collect()})
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("leaders", [0, 2])
def test_groups(spark, monkeypatch, leaders):
    """Chains and crowds of texts about 0.8 alike, some just below, so that no leader tells a whole bucket."""
    monkeypatch.setattr(minhash, "LEADERS", leaders)
    rng = np.random.default_rng(8)
    texts = {}
    for group in range(6):
        at = [f"g{group}w{i}" for i in rng.integers(0, 500, 120)]
        for _ in range(25):
            copy = list(at)
            for i in rng.integers(0, 120, rng.integers(0, 4)):
                copy[i] = f"n{rng.integers(0, 10**6)}"
            texts[len(texts)] = " ".join(copy).upper() if rng.random() < 0.5 else " ".join(copy)
            if rng.random() < 0.4:
                at = copy
    texts |= {len(texts): "two words", len(texts) + 1: "Two  WORDS", len(texts) + 2: "", len(texts) + 3: None}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r.doc_id for r in minhash.one_of_each(frame).collect()) == sorted(kept_ids(texts))


def test_crowd_below_the_threshold(spark, monkeypatch):
    """Texts 0.7 to 0.79 alike in one crowd, some pairs just above: found all, though few pairs are compared."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(300)]
    texts = {}
    for _ in range(150):
        copy = list(base)
        for i in rng.choice(np.arange(2, 298, 5), rng.integers(8, 12), replace=False):
            copy[i] = f"n{rng.integers(0, 10**9)}"
        texts[len(texts)] = " ".join(copy)
    for d in range(0, 40, 2):
        texts[len(texts)] = texts[d].replace("w299", f"z{d}")
    asked = []
    plain = minhash._near
    monkeypatch.setattr(minhash, "_near", lambda pairs, *more: asked.append(pairs.count()) or plain(pairs, *more))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got, want = {r.doc_id for r in minhash.one_of_each(frame).collect()}, kept_ids(texts)
    print("groups kept", len(got), "of", len(want), "pairs compared", asked)
    assert got == want
    assert sum(asked) < 0.2 * len(texts) ** 2 / 2


def test_one_row_of_each(spark):
    rows = [(None, "no id here at all"), (7, "a b c d e f"), (7, "a b c d e f"), (None, "A b c d e f"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.one_of_each(frame).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == [
        "(3, None)", "(7, 'a b c d e f')", "(None, 'no id here at all')"]
    assert minhash.one_of_each(frame.limit(0)).count() == 0


def test_fingerprints_link_first(spark):
    """The stage links by op2's fingerprints: equal ones and those two bits apart, checked on the sets, before any band."""
    from leakscope.llm import minhash

    rows = [(1, 10, 0), (2, 10, 0), (3, 10, 3), (4, 10, 7), (5, 10, -1), (6, 9, 255), (7, 10, -1)]
    classes = spark.createDataFrame([(fp, n, [fp], sim) for fp, n, sim in rows], "fp long, n int, bands array<long>, sim long")
    pairs = {(r.src, r.dst) for r in minhash._fingerprint_pairs(classes).collect()}
    # 0 and 3 are two bits apart, 3 and 7 one, 0 and 7 three; linked fingerprints meet by their leaders.
    assert {(2, 1), (7, 5)} <= pairs and ((3, 1) in pairs) and {(4, 3), (4, 1)} & pairs and not any(6 in p for p in pairs)
    # No two share a band: what is linked is linked by fingerprints, if the sets are alike.
    items = {1: range(10), 2: range(10), 3: range(10), 4: range(50, 60), 5: range(20, 30), 6: range(10), 7: range(20, 30)}
    sets = spark.createDataFrame([(k, list(v)) for k, v in items.items()], "fp long, items array<long>")
    found = {(r.src, r.dst) for r in minhash._links(classes, lambda some: sets, 8).collect()}
    assert found == {(2, 1), (3, 1), (7, 5)}


def test_fingerprints_join_whoever_leads(spark):
    """Classes of one fingerprint, or of a chain of linked ones, are compared with each other, not with a leader alone (F10)."""
    # 1 and 4 lead fingerprints 0 and 1 and are like nobody; 2, 3 and 5 are alike. No two share a band.
    rows = [(1, 0), (2, 0), (3, 0), (4, 1), (5, 1)]
    classes = spark.createDataFrame([(fp, 10, [fp], sim) for fp, sim in rows], "fp long, n int, bands array<long>, sim long")
    items = {1: range(100, 110), 2: range(10), 3: range(10), 4: range(200, 210), 5: range(10)}
    sets = spark.createDataFrame([(k, list(v)) for k, v in items.items()], "fp long, items array<long>")
    roots = {r.node: r.root for r in minhash.components(minhash._links(classes, lambda some: sets, 8)).collect()}
    assert roots == {2: 2, 3: 2, 5: 2}


def test_every_row_of_a_class_tells_its_fingerprint(spark):
    """Texts of one shingle set that repeat their shingles differently have several fingerprints (F10)."""
    cycle = "a b c d e f g h"
    texts = [" ".join([cycle] * 3), " ".join([*[cycle] * 2, *["a b c d e f g h"] * 9, "a b c d e"])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = minhash._classes(frame, "doc_id", "text", 5).collect()
    assert len(found) == 1 and set(found[0].sims) == {_fingerprint(t, 5, 42) for t in texts}


def test_few_rows_fill_few_files(spark, monkeypatch):
    """Sets of many parts leave links of a few rows: each table is as many files as its own size asks for (F1)."""
    small = {"coalescePartitions.parallelismFirst": "false", "coalescePartitions.minPartitionSize": "1k", "advisoryPartitionSizeInBytes": "64k"}
    before = {k: spark.conf.get(f"spark.sql.adaptive.{k}") for k in small}
    files, plain = {}, minhash.stored

    def stored(df, name):
        out = plain(df, name)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(minhash, "stored", stored)
    rng, rows = np.random.default_rng(5), []
    for d in range(60):
        words = [f"w{i}" for i in rng.integers(0, 10**6, 400)]
        rows += [(2 * d, " ".join(words)), (2 * d + 1, " ".join([*words[:395], "other"]))]
    try:
        for k, v in small.items():
            spark.conf.set(f"spark.sql.adaptive.{k}", v)
        got = minhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted(r.doc_id for r in got.collect()) == list(range(0, 120, 2))
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.adaptive.{k}", v)
    print("files", files)
    assert files["shingle_sets"][0] > 2
    assert max(files["fingerprint_links"] + files["minhash_links"]) == 1
