"""The trees choose looser forms that are personal data and leave counterfeits; how many rows there are does not matter."""

from pyspark.sql import functions as F
from tests.llm import brute

from leakscope.llm import pii

SF = "/root/testdata/sf0.01"
PLANTED = {
    "email": "john.smith [at] mail7.example [dot] com", "ip": "161[.]17[.]88[.]162", "card": "4111.1111.1111.1111",
    "phone": "(415) 555-1234",
}
# Digits that fail a check, a domain that ends in digits, a number that is named something else, a part of an address.
FALSE = ["met (at) 5.30", "161[.]17[.]88[.]962", "4111.1111.1111.1112", "order no. (415) 555-1234", "build 10.200.3000"]


def _planted(spark):
    """Documents whose id is divisible by 5 hold one looser form or one counterfeit behind their words."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    bits = [*PLANTED.values(), *FALSE]
    n = (F.col("doc_id") / 5).cast("int") % len(bits)
    bit = F.get(F.array(*map(F.lit, bits)), n)
    return docs.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat_ws(" ", "text", bit, F.lit("word"))).otherwise(F.col("text"))), bits


def _more(rows, texts):
    """(doc_id, kind, matched text) of the spans beyond the base ones."""
    out = set()
    for r in rows:
        base = {x for x in brute.spans_text(brute.pii(texts[r.doc_id])).split(",") if x}
        spans = {x for x in r.spans.split(",") if x}
        assert base <= spans
        for s in spans - base:
            kind, a, b = s.split(":")
            out.add((r.doc_id, kind, texts[r.doc_id][int(a):int(b)]))
    return out


def test_planted_forms_and_counterfeits(spark):
    docs, bits = _planted(spark)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    more = _more(pii.personal_data(docs).collect(), texts)
    want = {(d, kind, form) for i, (kind, form) in enumerate(PLANTED.items())
            for d in texts if d % 5 == 0 and d // 5 % len(bits) == i}
    right = len(more & want)
    print(f"{len(want)} planted, {len(more)} chosen, {right} of them planted")
    assert right >= 0.95 * len(want)
    assert right >= 0.95 * len(more)
    assert not {m for m in more if m[0] % 5 == 0 and m[0] // 5 % len(bits) >= len(PLANTED) and m[2] in FALSE}


def test_thresholds_do_not_hang_on_the_number_of_rows(spark):
    docs, _ = _planted(spark)
    found = pii.candidates(docs).cache()
    once = pii.fit(found)
    many = pii.fit(found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(20)))))
    assert set(once.thresholds) == set(many.thresholds) >= {(k, 1) for k in range(4)}
    assert all(abs(once.thresholds[k] - many.thresholds[k]) < 1e-6 for k in once.thresholds)


def test_redaction_takes_looser_forms(spark):
    docs, bits = _planted(spark)
    clean = {r.doc_id: r.text for r in pii.redact(docs).filter("doc_id % 5 = 0").collect()}
    kept = [d for d, t in clean.items() if t and any(form in t for form in PLANTED.values()) and d // 5 % len(bits) < len(PLANTED)]
    assert len(kept) <= 0.05 * len(clean)
