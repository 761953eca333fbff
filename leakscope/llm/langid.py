"""Language identification by error-correcting output codes (Dietterich, Bakiri 1995; Escalera, Pujol, Radeva 2010).

Each language has a codeword; one binary classifier over hashed character n-grams predicts each bit of it.
The language whose codeword has the least weighted loss wins; two nearly equal losses mark an ambiguous text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import small_batches, stored, whole_row

UNKNOWN = "und"
# About so many labelled rows are learned from, as many of each language, chosen by a hash of their id ...
TRAIN_ROWS = 6000
# ... but of each language so many, or all it has, however many languages there are.
LANG_ROWS = 100
PLACES = 1 << 40
# A text is of no learned language if its loss is above that of so many labelled texts kept from the learning, and above
# this share of what a text without any evidence loses.
CLEAN, BLIND = 0.999, 0.25
BUCKETS = 1 << 15  # per n-gram length
SLAB = 1 << 20  # characters worked on at once

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Code point -> lower-case letter, or a space for anything else."""
    if not _letters:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _letters.append(table)
    return _letters[0]


def _grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the 2- and 3-grams of the letters, words set apart by one space; nothing without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    for at in range(0, len(points), SLAB):
        x = _letter_table()[points[at:at + SLAB]]
        x = np.concatenate([[32], x, [32]]).astype(np.uint32)
        x = x[(x != 32) | (np.roll(x, 1) != 32)] if (x != 32).any() else x[:0]
        if not len(x):
            continue
        x = np.concatenate([np.zeros(int(x[0] != 32), np.uint32) + np.uint32(32), x])
        pair = x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA77)
        three = pair[:-1] * np.uint32(0xC2B2AE3D) + x[2:] * np.uint32(0x27D4EB2F)
        fold = lambda h: ((h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D)) >> np.uint32(17)
        yield np.concatenate([fold(pair), fold(three) + np.uint32(BUCKETS)])


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1 / -1: all splits of the languages in two for up to 7, random dense codes beyond.

    Of several random codes the one with the largest least distance between rows is taken.
    """
    if n <= 1:
        return np.ones((n, 0), np.int8)
    if n <= 7:
        columns = [[1 if k == 0 or s >> k - 1 & 1 else -1 for k in range(n)] for s in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.int8).T
    rng, length = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    codes = [np.where(rng.random((n, length)) < 0.5, 1, -1).astype(np.int8) for _ in range(50)]

    def distance(code: np.ndarray) -> int:
        agree = code.astype(np.int32) @ code.T.astype(np.int32)
        return int((length - (agree - np.diag(np.diag(agree))).max()) // 2)

    return max(codes, key=distance)


@dataclass
class Model:
    """Languages, codewords, n-gram weights per bit, and slope, offset and loss weight of each bit; above ``limit``
    the loss of the nearest language says that a text is of none."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    slope: np.ndarray
    offset: np.ndarray
    trust: np.ndarray
    limit: float = np.inf

    def evidence(self, text: str | None) -> np.ndarray | None:
        """Mean weight of a text's n-grams per bit; None without letters."""
        total, n = np.zeros(self.weights.shape[1]), 0
        for grams in _grams(text or ""):
            total += self.weights[grams].sum(axis=0, dtype=np.float64)
            n += len(grams)
        return total / n if n else None

    def decode(self, evidence: np.ndarray) -> tuple[int, float, float, float]:
        """Nearest language, its share of exp(-loss) over all, the loss it leads by, and its own loss."""
        margin = np.clip(self.slope * evidence + self.offset, -30, 30)
        loss = (np.logaddexp(0, -self.code * margin) * self.trust).sum(axis=1)
        best = int(loss.argmin())
        lead = float(np.partition(loss, 1)[1] - loss[best]) if len(loss) > 1 else np.inf
        return best, float(1 / np.exp(loss[best] - loss).sum()), lead, float(loss[best])


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> tuple[float, float]:
    """Slope and offset of a ridge logistic fit of y in {0, 1} by Newton steps."""
    scale = max(float(np.abs(x).max()), 1e-9)
    z, w = np.stack([x / scale, np.ones_like(x)]), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w @ z, -30, 30)))
        grad = z @ (p - y) + 1e-2 * w
        hess = (z * (p * (1 - p))) @ z.T + 1e-2 * np.eye(2)
        w -= np.clip(np.linalg.solve(hess, grad), -5, 5)
    return float(w[0] / scale), float(w[1])


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int) -> DataFrame:
    """About ``rows`` labelled rows with a letter outside the held-out third, by a hash of the id: of each language the
    same number, at least ``LANG_ROWS``, or all it has. ``quarter`` deals them into four parts; a language's first
    row is never in part 0."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
                        & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(PLACES)).alias("place"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit(4)), F.lit(4)).alias("quarter"))
    counts = stored(known.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("first")), "langid_counts")
    each = max(rows // max(counts.count(), 1), LANG_ROWS)
    return known.join(counts, "lang").filter(F.col("place") < F.lit(float(each * PLACES)) / F.col("n")).select(
        "lang", "text", F.when(F.col("place") == F.col("first"), 1).otherwise(F.col("quarter")).alias("quarter"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows: int = TRAIN_ROWS, calibrate: bool = False) -> Model:
    """A model learned from about ``rows`` labelled rows, as many of each language; every language with a labelled
    row outside the held-out third is learned, and no row of that third is read. With ``calibrate`` a third as many
    rows again, of the same kind but kept from the learning, set the limit; without it there is none.

    A bit's classifier weighs an n-gram by the log ratio of its mean smoothed share in the languages with
    that bit set and in the others. To the driver come counts per language and n-gram bucket, and one
    small vector per learned row.
    """
    small_batches(docs.sparkSession)
    sample = stored(_sample(docs, id_col, text_col, lang_col, rows * 4 // 3 if calibrate else rows), "langid_sample")
    clean = sample.filter("quarter = 0")
    if calibrate:
        sample = sample.filter("quarter > 0")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                for grams in _grams(text):
                    row = totals.setdefault(lang, np.zeros(2 * BUCKETS, np.int64))
                    row += np.bincount(grams, minlength=2 * BUCKETS)
        for lang, row in totals.items():
            at = np.flatnonzero(row)
            yield pd.DataFrame({"lang": lang, "gram": at, "n": row[at]})

    counted = sample.mapInPandas(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    code = codewords(len(languages))
    empty = np.zeros(0)
    if len(languages) < 2:
        return Model(languages, code, np.zeros((2 * BUCKETS, 0), np.float32), empty, empty, empty)
    share = np.full((len(languages), 2 * BUCKETS), 0.1)
    place = {lang: k for k, lang in enumerate(languages)}
    share[counted["lang"].map(place).to_numpy(), counted["gram"].to_numpy()] += counted["n"].to_numpy()
    share /= share.sum(axis=1, keepdims=True)
    yes = (code == 1).astype(np.float64)
    weights = (np.log((yes.T @ share) / yes.sum(axis=0)[:, None])
               - np.log(((1 - yes).T @ share) / (1 - yes).sum(axis=0)[:, None])).T.astype(np.float32)
    bits = code.shape[1]
    raw = Model(languages, code, np.ascontiguousarray(weights), np.ones(bits), np.zeros(bits), np.ones(bits))
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(lang, e) for lang, t in zip(b["lang"], b["text"], strict=True)
                   if (e := shared.value.evidence(t)) is not None]
            yield pd.DataFrame(got, columns=["lang", "evidence"])

    seen = sample.mapInPandas(measure, "lang string, evidence array<double>").toPandas().sort_values(
        "lang", kind="stable")
    x = np.stack(seen["evidence"].to_list())
    y = (code[seen["lang"].map(place).to_numpy()] == 1).astype(np.float64)
    lines = np.array([_logistic(x[:, b], y[:, b]) for b in range(bits)])
    wrong = ((x * lines[:, 0] + lines[:, 1] > 0) != (y > 0)).mean(axis=0)
    # Less error, more say: half the log odds of being right.
    trust = 0.5 * np.log((1 - np.clip(wrong, 1e-3, 0.499)) / np.clip(wrong, 1e-3, 0.499))
    model = Model(languages, code, raw.weights, lines[:, 0], lines[:, 1], trust / trust.sum() * bits)
    if not calibrate:
        return model
    losses = [model.decode(np.array(e))[3] for e in clean.filter(F.col("lang").isin(languages)).mapInPandas(
        measure, "lang string, evidence array<double>").toPandas()["evidence"]]
    model.limit = max([BLIND * bits * np.log(2), *(np.quantile(losses, [CLEAN]) if losses else [])])
    return model


def identify(text: Column, model: Model, spark, ambiguous: float = 0.5) -> Column:
    """Struct ``(lang_pred, score, ambiguous, foreign)`` of each text.

    ``score`` is the winner's share of exp(-loss) over all languages. ``ambiguous``: the runner-up's loss
    is less than ``ambiguous`` behind. ``foreign``: even the winner's loss is above the model's limit, as that of
    gibberish or of a language that was not learned, whose score may still be near 1. Without letters, with a null text, or if nothing was learned, the
    answer is ``und`` with score 0, marked ambiguous and foreign.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean, foreign boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m, rows = shared.value, []
        for t in texts:
            e = m.evidence(t) if m.languages else None
            if e is None:
                rows.append((UNKNOWN, 0.0, True, True))
            else:
                best, score, lead, loss = m.decode(e)
                rows.append((m.languages[best], score, lead < ambiguous, loss > m.limit))
        return pd.DataFrame(rows, columns=["lang_pred", "score", "ambiguous", "foreign"])

    return predict(text)


def known_only(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows in a language learned from them, as they are; ``und`` and foreign ones go. If no row is labelled
    nothing can be told, and all texts with a letter stay."""
    model = fit(docs, text_col=text_col, calibrate=True, **options)
    if not model.languages:
        return docs.filter(F.col(text_col).rlike(r"\p{L}"))
    told = docs.select(whole_row(docs), identify(F.col(text_col), model, docs.sparkSession).alias("l"))
    return told.filter((F.col("l.lang_pred") != UNKNOWN) & ~F.col("l.foreign")).select("row.*")
