"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns, hot groups."""

from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leakscope.llm import (
    chat,
    decontaminate,
    elias_fano,
    langid,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    substrings,
    token_ids,
)
from leakscope.llm.common import scratch

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 977} x{i % 13}" for i in range(60_000))
TEXTS = [
    (1, "The quick brown fox, a@b.example.com +1 (743) 555-3824 jumps", "en"), (2, None, "en"), (3, "", None),
    (4, " \n\t ", "en"), (5, LONG, "en"), (None, "no id here at all", None), (7, "12 34 !! ##", "de"),
    (8, "same text twice", "de"), (8, "same text twice", "de"), (8, "other text, same id", "fr"),
    (9, "the quick BROWN fox, a@b.example.com +1 (743) 555-3824 jumps", "en"), (10, "é" * 5000, "fr"),
]
# Names the operators use for their own columns.
EXTRA = "fp long, th long, shard int, words string, marks int, kind string, n_words string, items int, _text string"


@pytest.fixture(scope="module")
def odd(spark):
    extra = (1, 2, 3, "w", 4, "k", "n", 5, "t")
    return spark.createDataFrame([(i, t, lang, "s", 0, *extra) for i, t, lang in TEXTS],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


def keyed(rows, *columns):
    return Counter(tuple(r[c] for c in ("doc_id", *columns)) for r in rows)


def test_quality(odd, none):
    got = quality.robust_outliers(odd).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert keyed(got, *names) == Counter((i, *(brute.quality(t)[n] for n in names)) for i, t, _ in TEXTS)
    # Too few rows for any estimate: the base rules decide.
    assert all(r.kept == (not r.base_failed) and r.distance is None for r in got)
    assert quality.robust_outliers(none).count() == 0


def test_quality_rejects_outliers(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(4000)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(60, 400))) for _ in range(300)]
    junk = [" ".join(f"{w}###$$$" for w in rng.choice(vocabulary, 150)) for _ in range(20)]
    rows = [(i, t, "en", "a" if i % 2 else f"small{i}") for i, t in enumerate(texts + junk)]
    got = quality.robust_outliers(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert kept == set(range(300))


def test_simhash(odd, none):
    fps = [brute.fingerprint(t) for _, t, _ in TEXTS]
    roots = brute.components(fps)
    least = {r: min((TEXTS[k][0] for k in range(len(fps)) if roots[k] == r and TEXTS[k][0] is not None), default=None)
             for r in set(roots)}
    got = simhash.near_duplicates(odd).collect()
    assert keyed(got, "fingerprint", "component_id") == Counter(
        (i, f"{f:016x}", least[r]) for (i, _, _), f, r in zip(TEXTS, fps, roots, strict=True))
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("bucket", [2, 64])
def test_simhash_links(spark, distance, bucket):
    """A crowd of fingerprints few bits apart, in full and in calm buckets."""
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 4), replace=False)) for b in base for _ in range(5)]
    crowd = [int(base[0]) ^ 1 << int(i) ^ 1 << int(j) for i, j in rng.integers(0, 64, (150, 2))]
    fps = sorted({f if f < 2**63 else f - 2**64 for f in [*map(int, base), *near, *crowd]})
    from leakscope.llm.components import components

    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = {r.node: r.root for r in components(simhash.links(frame, distance, bucket)).collect()}
    roots = brute.components([f % 2**64 for f in fps], distance)
    assert [found.get(f, f) for f in fps] == [fps[r] for r in roots]


def test_allocation():
    cost = [[0, 5, 9, 50], [0, 1, 100, 900], [0, 4, 5, 6]]
    best, chosen = simhash._allocate(cost, 3)
    assert (best, sum(t + 1 for t in chosen)) == (6, 3)


def test_substrings(spark, odd, none):
    got = substrings.remove_repeats(odd).collect()
    rows = {(r.doc_id, r.kept_text): r for r in got}
    assert len(got) == len(TEXTS) and keyed(got, "n_words") == Counter((i, len(brute.words(t))) for i, t, _ in TEXTS)
    assert sum(r.n_removed for r in got if r.doc_id != 5) == 0 and (None, "no id here at all") in rows
    assert next(r.n_removed for r in got if r.doc_id == 5) == brute.substrings([(5, LONG)])[5][1] > 0
    assert substrings.remove_repeats(none).count() == 0


@pytest.mark.parametrize("hot", [3, 50_000])
def test_substrings_hot_passage(spark, hot):
    """A passage in most documents, with other words around it, and a repeated word."""
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(45))
    docs = []
    for i in range(60):
        w = [f"v{k}" for k in rng.integers(0, 300, 40)]
        docs.append((i, " ".join(w[:17]) + " " + passage + "\n" + " ".join(w[17:]) if i % 4 else " ".join(["a"] * 50)))
    got = substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), hot_runs=hot).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got} == brute.substrings(docs)


def test_chat(spark):
    rows = [(1, 0, "user", "a<|im_end|>b <\\| <\\\\| %"), (1, 1, "assistant", None), (2, 0, "assistant", "first"),
            (3, 0, "us<|er\n%0A", "x\ny"), (None, None, None, None), (4, 1, "user", "tie"), (4, 1, "user", "tie"),
            (5, 0, "system", ""), (5, 1, "user", LONG), (5, 2, "assistant", "<|im_start|>user\n")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(frame.selectExpr("*", "1 as place", "'x' as segments"))
    from pyspark.sql import functions as F

    got = out.select("conv_id", "valid", chat.parse(chat.formatted(F.col("segments"))).alias("t"),
                     chat.loss_text(F.col("segments")).alias("loss")).collect()
    want = defaultdict(list)
    for c, t, r, x in rows:
        want[c].append((-1 if t is None else t, r or "", x or ""))
    assert {r.conv_id: [(x.role, x.text) for x in r.t] for r in got} == {
        c: [(r, x) for _, r, x in sorted(v)] for c, v in want.items()}
    assert {r.conv_id for r in got if r.valid} == {1, 5}
    assert {r.conv_id: r.loss for r in got}[5] == "<|im_start|>user\n"
    assert chat.format_chats(frame.filter("false")).count() == 0


def test_language(spark, odd, none):
    from pyspark.sql import functions as F

    got = odd.select("doc_id", "text", langid.identify(F.col("text"), langid.fit(odd), spark).alias("l")).collect()
    for r in got:
        assert (r.l.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert 0 <= r.l.score <= 1
    nothing = langid.fit(none)
    assert odd.select(langid.identify(F.col("text"), nothing, spark)["lang_pred"].alias("p")).distinct().collect()[0].p == "und"


def test_codewords():
    assert langid.codewords(4).shape == (4, 7)
    code = langid.codewords(12).astype(int)
    apart = [(code[i] != code[j]).sum() for i in range(12) for j in range(i)]
    assert min(apart) >= 8


def test_personal_data(odd, none):
    got = pii.personal_data(odd).collect()
    assert keyed(got, "base_sha256") == Counter((i, brute.sha(brute.spans_text(brute.pii(t)))) for i, t, _ in TEXTS)
    assert pii.personal_data(none).count() == 0
    clean = pii.redact(odd)
    assert clean.columns == odd.columns
    texts = Counter((r.doc_id, r.text) for r in clean.collect())
    assert texts[(1, "The quick brown fox, [EMAIL] [PHONE] jumps")] == 1
    assert texts[(8, "same text twice")] == 2 and texts[(2, None)] == 1 and texts[(5, LONG)] == 1


PIECES = ["a", "B7", "@", ".", "-", " ", "+", "1", "22", "255", "4111111111111111", "(", ")", "é", "_", "%", "example.com", "\n"]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), min_size=30, max_size=60))
def test_personal_data_matches_plain_patterns(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.base_sha256 for r in pii.personal_data(frame).collect()}
    assert got == {i: brute.sha(brute.spans_text(brute.pii(t))) for i, t in enumerate(texts)}


def test_long_runs_do_not_stall(spark):
    texts = ["a" * 300_000, "1" * 300_000, "1." * 100_000, "a@b" + ".c" * 100_000, "+1" + " 2" * 100_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.personal_data(frame).collect()}
    assert {i for i, s in got.items() if s} >= {3}


def test_shards(odd, none):
    got = sharding.shard(odd, 4).collect()
    assert len(got) == len(TEXTS)
    assert keyed(got, "size") == Counter((i, len((t or "").encode()) + 16) for i, t, _ in TEXTS)
    assert len({r.shard for r in got if r.doc_id in (2, 3)}) == 1  # null counts as empty
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(none, 4).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 400), min_size=1, max_size=8), st.integers(1, 9))
def test_plan_is_longest_processing_time(classes, shards):
    plan = sharding.assign([(s, n, float(s)) for s, n in classes.items()], shards)
    loads = [0] * shards
    for s, ends in plan.items():
        for k, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
            loads[k] += s * (b - a)
        assert ends[-1] == classes[s]
    assert sorted(loads) == brute.lpt([s for s, n in classes.items() for _ in range(n)], shards)


def test_token_files(spark, odd, none):
    path = scratch(spark, "test_tokens")
    elias_fano.write(odd, path, BYTES, end_id=0, block_ids=2000)
    got = elias_fano.read_back(spark, path).collect()
    ids = {t: [*x, 0] for (_, t, _), x in zip(TEXTS, brute.tokens([t for _, t, _ in TEXTS], "byte_bpe_50k.json"), strict=True)}
    assert keyed(got, "n_tokens", "ids_crc32") == Counter((i, len(ids[t]), brute.crc(ids[t])) for i, t, _ in TEXTS)
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == list(np.cumsum([0] + [r.n_tokens for r in order[:-1]]))
    assert [r.doc_id for r in order] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d or 0))
    empty = scratch(spark, "test_tokens")
    elias_fano.write(none, empty, BYTES, end_id=0)
    assert elias_fano.read_back(spark, empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 300), max_size=700))
def test_elias_fano(values):
    values = sorted(values)
    code, end = elias_fano.EliasFano.from_bytes(memoryview(elias_fano.EliasFano.encode(np.array(values, np.uint64)).to_bytes()), 0)
    assert code.decode().tolist() == values
    assert [code[i] for i in range(len(values))] == values


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é'\n\t9.,|<>́ \x1cΣß "), max_size=12), max_size=30))
def test_cached_tokens_equal_the_library(texts):
    for path in (BYTES, WORDS):
        encoder = token_ids.token_ids(path)
        got = [list(x) for flat, n in encoder.encode(pa.array(texts, pa.string())) for x in np.split(flat, np.cumsum(n)[:-1])]
        assert got == brute.tokens(texts, path.rsplit("/", 1)[1])


def test_forgetting_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE_PIECES", 50)
    monkeypatch.setattr(token_ids, "SLAB", 300)
    texts = [" ".join(f"w{(i * k) % 91}" for k in range(40)) + " <|endoftext|>" * (i % 7 == 0) for i in range(60)]
    encoder = token_ids.TokenIds(BYTES)
    got = [list(x) for flat, n in encoder.encode(pa.array(texts)) for x in np.split(flat, np.cumsum(n)[:-1])]
    assert got == brute.tokens(texts, "byte_bpe_50k.json")


ITEMS = [(1, "alpha beta"), (2, " ".join(f"q{i}" for i in range(20))), (3, None), (4, "!!"), (None, "gamma"), (2, "delta")]


@pytest.mark.parametrize("limit", [1, 1 << 20])
def test_decontamination(spark, odd, none, limit):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    texts = [(1, "Alpha, BETA! alpha beta gamma"), (2, "alphabeta alpha-beta xalpha beta"), (3, None), (4, ""),
             (5, "é " + " ".join(f"q{i}" for i in range(3, 19)) + " delta"), (5, "repeated id gamma")]
    frame = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, n_hit int")
    got = decontaminate.contamination(frame, items, limit=limit).collect()
    want = [(i, *brute.contamination(t, [(x or "", b) for x, b in ITEMS])) for i, t in texts]
    assert keyed(got, "n_words", "n_hit") == Counter((i, n, h) for i, n, h, *_ in want)
    assert Counter(brute.sha(",".join(r["items"])) for r in got) == Counter(d for *_, d, _ in want)
    for r in got:
        text = next(t for i, t in texts if i == r.doc_id and len(brute.bench_words(t)) == r.n_words)
        words = [w for s in r.spans for w in brute.bench_words(text[s.start:s.stop])]
        assert len(words) == r.n_hit
    assert decontaminate.contamination(odd, items, limit=limit).count() == len(TEXTS)
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(odd, items.filter("false")).filter("n_hit > 0").count() == 0


def test_packing(spark, odd, none):
    got = packing.pack(odd, WORDS, end_id=1, capacity=64).collect()
    ids = {t: [*x, 1] for (_, t, _), x in zip(TEXTS, brute.tokens([t for _, t, _ in TEXTS], "word_bpe_49k.json"), strict=True)}
    want = Counter((i, p, p * 64, len(ids[t][p * 64:p * 64 + 64]), brute.crc(ids[t][p * 64:p * 64 + 64]))
                   for i, t, _ in TEXTS for p in range(-(-len(ids[t]) // 64)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    homes = defaultdict(list)
    for r in got:
        homes[r.sequence_id].append((r.offset, r.length))
    for parts in homes.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts[:-1]])) and sum(parts[-1]) <= 64
    assert packing.pack(none, WORDS).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_sum_of_squares(lengths):
    """Every placement leaves the least sum of squares among all possible ones."""
    bins, offsets = packing.sum_of_squares(np.array(lengths), 30)
    fill = Counter()

    def cost(f):
        return sum(n * n for n in Counter(30 - x for x in f.values() if x < 30).values())

    for s, b, o in zip(lengths, bins.tolist(), offsets.tolist(), strict=True):
        assert fill[b] == o and o + s <= 30
        options = [cost({**fill, k: fill[k] + s}) for k in [k for k, x in fill.items() if x and x + s <= 30] + ["new"]]
        fill[b] += s
        assert cost(fill) == min(options)


def test_one_of_each_group(odd, none):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    roots = brute.components([brute.fingerprint(t) for _, t, _ in TEXTS])
    assert sum(got.values()) == len(set(roots))
    assert got[(2, None)] == 1 and got[(3, "")] == 0 and got[(None, "no id here at all")] == 1
    assert got[(8, "same text twice")] == 1
    assert simhash.one_of_each(none).count() == 0


def test_pipeline_stages_take_odd_rows(spark, odd, none):
    import corpus_pipeline
    from conftest import SF

    for table in (odd, none):
        at = table
        for name, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, SF)
            if name != "packing":
                assert at.columns == odd.columns
        assert (at.count() > 0) == (table is odd)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_tokens_as_the_library_reads_them(name):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "<|ENDOFTEXT|> A", "<|startoftext|>Q  q", "plain text",
             None, " <|endoftext|>  <|endoftext|> ", "<| endoftext |>"]
    want = brute.tokens(texts, name)
    flat, lengths = zip(*token_ids.token_ids(public_tokenizers.path(name)).encode(pa.array(texts, pa.string())), strict=True)
    got = np.split(np.concatenate(flat), np.cumsum(np.concatenate(lengths))[:-1])
    assert [g.tolist() for g in got] == want
