"""The registered queries on the smallest tables against brute force."""

from collections import Counter, defaultdict

import brute
import pytest
from conftest import SF  # the one above this folder
from test_llm_minhash import kept_ids

from leakscope.llm.common import read
from leakscope.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}


def rows(spark, name):
    got = QUERIES[name](spark, SF).collect()
    return got


def test_quality_counts(spark, docs):
    got = rows(spark, "op1_quality_mcd")
    assert len(got) == len(docs)
    for r in got:
        want = brute.quality(docs[r.doc_id])
        assert {k: r[k] for k in want} == want
        assert not (r.base_failed and r.kept)
    passing = [r for r in got if not r.base_failed]
    assert sum(r.kept for r in passing) > 0.6 * len(passing)


def test_simhash_components(spark, docs):
    ids = sorted(docs)
    fps = [brute.fingerprint(docs[d]) for d in ids]
    roots = brute.components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op2_simhash_gph")}
    assert got == {d: (f"{f:016x}", ids[r]) for d, f, r in zip(ids, fps, roots, strict=True)}


def test_substrings(spark, docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows(spark, "op3_superkmer_dedup")}
    want = brute.substrings(docs.items())
    assert got == want
    assert sum(n for _, n, _ in want.values()) > 0


def test_chat(spark):
    table = defaultdict(list)
    for r in read(spark, SF, "conversations").collect():
        table[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    control = "<|im_end|><|im_start|>assistant ok"
    table[-1] = [(0, "user", control), (1, "assistant", control)]
    got = {r.conv_id: r for r in rows(spark, "op4_chat_format")}
    assert set(got) == set(table)
    for conv, turns in table.items():
        turns.sort()
        r = got[conv]
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), brute.sha("".join(f"{a}\n{t}\n" for _, a, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.sha(loss))


def test_language(spark, docs):
    lang = {r.doc_id: r.lang for r in read(spark, SF, "documents").collect()}
    got = rows(spark, "op5_language_ecoc")
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_personal_data(spark, docs):
    got = rows(spark, "op6_pii_boosted")
    assert len(got) == len(docs)
    for r in got:
        spans = brute.pii(docs[r.doc_id])
        assert r.base_sha256 == brute.sha(brute.spans_text(spans))
        counts = Counter(k for _, k, _ in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in range(4)]
        assert {x for x in brute.spans_text(spans).split(",") if x} <= set(r.spans.split(","))


def test_shards(spark, docs):
    got = rows(spark, "op7_shard_lpt")
    assert len(got) == len(docs)
    home, loads, slots, sizes = {}, Counter(), defaultdict(list), Counter()
    import zlib
    for r in got:
        text = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(text) + 16, zlib.crc32(text))
        assert home.setdefault(text, r.shard) == r.shard
        loads[r.shard] += r["size"]
        sizes[text] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < 40
    assert max(loads.values()) <= brute.lpt(sizes.values(), 40)[-1] * 1.001


def test_token_files(spark, docs):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op8_token_files")}
    at, want, order = 0, {}, sorted(docs)
    for d, ids in zip(order, brute.tokens([docs[d] for d in order], "byte_bpe_50k.json"), strict=True):
        want[d] = (at, len(ids) + 1, brute.crc([*ids, 0]))
        at += len(ids) + 1
    assert got == want


def test_decontamination(spark, docs):
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    got = rows(spark, "op9_decontaminate")
    assert len(got) == len(docs)
    for r in got:
        n, hit, digest, found = brute.contamination(docs[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.items_sha256, r.n_items) == (n, hit, digest, found)
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


def check_packing(got, texts, capacity=4096):
    ids = {d: [*x, 1] for d, x in zip(texts, brute.tokens(texts.values(), "word_bpe_49k.json"), strict=True)}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        parts.sort(key=lambda r: r.piece)
        want = [ids[d][i:i + capacity] for i in range(0, len(ids[d]), capacity)]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in parts] == [
            (k, k * capacity, len(p), brute.crc(p)) for k, p in enumerate(want)]
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence), sum(map(len, ids.values()))


def test_packing(spark, docs):
    sequences, total = check_packing(rows(spark, "op10_pack_sequences"), docs)
    assert sequences <= 1.03 * total / 4096 + 2


def test_pipeline(spark, docs):
    import corpus_pipeline
    from leakscope.llm import langid
    from leakscope.llm.common import stored

    at, seen = read(spark, SF, "documents"), {}
    columns = at.columns
    for name, stage in corpus_pipeline.STAGES:
        at = stored(stage(spark, at, SF), "test_pipeline")
        seen[name] = at.collect()
        if name != "packing":
            assert at.columns == columns
    letters = {d for d, t in docs.items() if t and any(c.isalpha() for c in t)}
    assert {r.doc_id for r in seen["language"]} == letters
    firsts = kept_ids({d: docs[d] for d in letters})
    assert sorted(r.doc_id for r in seen["near_duplicates"]) == sorted(firsts)
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    clean = {d for d in firsts if not (lambda n, h, *_: h > 0 and 20 * h >= n)(*brute.contamination(docs[d], items))}
    assert {r.doc_id: r.text for r in seen["decontamination"]} == {d: docs[d] for d in clean}
    redacted = {r.doc_id: r for r in seen["personal_data"]}
    assert set(redacted) == clean
    for d, r in redacted.items():
        assert r.n_chars == len(r.text)
        assert not brute.pii(r.text) and ("[" in r.text or not brute.pii(docs[d]))
    check_packing(seen["packing"], {d: r.text for d, r in redacted.items()})
    assert langid.UNKNOWN == "und"
