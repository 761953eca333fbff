"""Personal data spans: generous generators propose overlapping candidates, boosted trees over format and
context choose among them, and checked formats always count.

What the trees learn from is labelled by checks: base matches by theirs, looser forms by the arithmetic of
their kind, and each base match once more as it would look in its looser form. All of it is SQL functions. Trees are fitted on a table of counts per feature cell, whose size is bounded
by the product of the features' bins, and applied as CASE expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import prod

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import stored, whole_row
from leakscope.llm.quality import let

KINDS = ("email", "ip", "card", "phone")
_MAIL = "[A-Za-z0-9._%+-]"
# Base formats. Possessive loops, and a start only at the head of a run or where the last match ended, leave
# the matches as they are but keep long runs from being tried from each of their characters.
BASE = {
    "email": rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser ones: at signs spelt out, bracketed dots, odd separators, numbers without a country code.
LOOSE = {
    "email": rf"(?:(?<!{_MAIL})|\G){_MAIL}++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){2}[./_][0-9]{3,4}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20./-])[0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9])",
}
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# Words before a span that speak for personal data, and those that speak against it.
CUES = r"(?i)\b(?:e-?mail|mail|tel|phone|mobile|call|fax|contact|card|visa|credit|account|ip|address|host)\b"
COUNTER_CUES = r"(?i)(?:token|key|hash|id|ref|order|version|isbn|serial|no)\W*$"
# Characters of context a feature may look at.
CONTEXT = 24

FEATURES = {"kind": 4, "digits": 8, "marks": 5, "lead": 4, "left": 5, "right": 5, "cue": 3, "loose": 2, "fits": 2}


@dataclass(frozen=True)
class PiiParams:
    """Boosting rounds, step, ridge (against the weight 1 of all rows of a kind and form), and the precision
    that a threshold must reach on the other half of the documents: ``precision`` for matches that fail a
    check, ``loose_precision`` for looser forms. ``prior`` is what the trees' own probability weighs beside the share counted there.
    """

    rounds: int = 20
    step: float = 0.3
    ridge: float = 0.01
    precision: float = 0.995
    loose_precision: float = 0.95
    prior: float = 0.02


def _found(text: Column, pattern: str) -> Column:
    """Matches in order: length of the gap before, the match, and a little context on both sides.

    Cutting the text at the pattern gives the gaps, extracting gives the matches.
    """
    return let(F.split(text, pattern), lambda gaps: F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m, i: F.struct(
            F.char_length(F.get(gaps, i)).alias("gap"), m.alias("match"),
            F.substring(F.get(gaps, i), -CONTEXT, CONTEXT).alias("left"),
            F.substring(F.get(gaps, i + 1), 1, 1).alias("right"))))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th")]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, th, kind, loose, start, stop, valid, made, fits, truth, features...)``: every match of every generator.

    Offsets are code points. The text is read once by all generators; only matches are shuffled, by
    document. ``valid``: a base match that passes its check. ``made``: not found in the text, but a base match
    rewritten in its looser form, to learn from. ``fits``: 0 for a looser form that fails its check.
    ``truth``: what a candidate is known to be, null if nothing tells. Rows of equal id and text count once.
    """
    text = F.col(text_col)
    gens = []
    for loose, table in ((0, BASE), (1, LOOSE)):
        for k, kind in enumerate(KINDS):
            wanted = text.contains("@") if kind == "email" and not loose else (
                text.rlike(r"[\[(]at[\])]") if kind == "email" else text.rlike(
                    r"\[\.\]" if loose and kind == "ip" else "[0-9]"))
            empty = F.array().cast("array<struct<gap:int,match:string,left:string,right:string>>")
            gens.append(F.struct(F.lit(k).alias("kind"), F.lit(loose).alias("loose"),
                                 F.when(wanted, _found(text, table[kind])).otherwise(empty).alias("found")))
    rows = (docs.select(*_keyed(docs, id_col, text_col), F.explode(F.array(*gens)).alias("g"))
            .select("doc_id", "th", "g.kind", "g.loose", F.posexplode("g.found").alias("pos", "m"))
            .select("doc_id", "th", "kind", "loose", "pos", "m.*")
            .repartition("doc_id", "th").dropDuplicates(["doc_id", "th", "kind", "loose", "pos"]))
    length = F.char_length("match")
    upto = Window.partitionBy("doc_id", "th", "kind", "loose").orderBy("pos")
    placed = rows.withColumn("stop", F.sum(F.col("gap") + length).over(upto)).withColumn("start", F.col("stop") - length)
    # A looser phone number that begins in a match of another kind is a part of that match.
    other = F.max(F.when((F.col("loose") == 0) & (F.col("kind") != 3), F.col("stop"))).over(
        Window.partitionBy("doc_id", "th").orderBy("start", "loose", "kind"))
    checked = placed.withColumn("inside", F.coalesce(other > F.col("start"), F.lit(False))).withColumn(
        "valid", (F.col("loose") == 0) & _check(F.col("kind"), F.col("match")))
    forms = checked.select(
        "doc_id", "th", "kind", "start", "stop", "valid", "inside", "left", "right", F.explode(F.filter(F.array(
            F.struct(F.lit(0).alias("made"), F.col("loose"), F.col("match")),
            F.struct(F.lit(1).alias("made"), F.lit(1).alias("loose"), F.when(F.col("loose") == 0, _loosened()).alias("match"))),
            lambda f: f["match"].isNotNull())).alias("f")).select("*", "f.*")
    counter = F.col("left").rlike(COUNTER_CUES)
    fits = F.when(F.col("loose") == 0, F.lit(True)).otherwise(_loose_check(F.col("kind"), F.col("match"), counter))
    truth = (F.when(F.col("made") == 1, F.col("valid") & fits).when(F.col("loose") == 0, F.col("valid"))
             .when(F.col("kind") < 3, fits).when(F.col("inside"), F.lit(False)))
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.char_length(digits)
    marks = F.regexp_replace("match", "[A-Za-z0-9]", "")
    return forms.select(
        "doc_id", "th", "kind", "loose", "start", "stop", ((F.col("made") == 0) & F.col("valid")).alias("valid"),
        "made", fits.cast("int").alias("fits"), truth.alias("truth"),
        (sum((n >= b).cast("int") for b in (8, 10, 12, 14, 16, 17, 20))).alias("digits"),
        F.when(marks == "", 0).when(~marks.rlike("[^ ]"), 1).when(~marks.rlike("[^-]"), 2)
        .when(~marks.rlike("[^.]"), 3).otherwise(4).alias("marks"),
        F.when(F.col("match").startswith("+"), 0).when(F.col("match").startswith("("), 1)
        .when(F.col("match").rlike("^[0-9]"), 2).otherwise(3).alias("lead"),
        _side(F.substring("left", -1, 1)).alias("left"), _side(F.col("right")).alias("right"),
        F.when(F.col("left").rlike(CUES), 2).when(counter, 1).otherwise(0).alias("cue"))


def _check(kind: Column, match: Column) -> Column:
    """Whether a base match passes the check of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.char_length(digits)
    return (F.when(kind == 0, F.lit(True)).when(kind == 1, match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
            .when(kind == 2, F.when(n.between(14, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False)))
            .otherwise(n.between(10, 15)))


def _loose_check(kind: Column, match: Column, counter: Column) -> Column:
    """The check of a looser form: a last domain label of letters, bytes, Luhn's sum; a phone number has
    9 to 12 digits and no word before it that names another number."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    return (F.when(kind == 0, match.rlike(r"[.\x20\])][A-Za-z]{2,24}$"))
            .when(kind == 1, F.regexp_replace(match, r"\[\.\]", ".").rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
            .when(kind == 2, F.when(F.char_length(digits).between(14, 19), F.call_function("luhn_check", digits))
                  .otherwise(F.lit(False)))
            .otherwise(F.char_length(digits).between(9, 12) & ~counter))


def _loosened() -> Column:
    """A base match as it would look in the looser form of its kind; null where it has none."""
    match, kind = F.col("match"), F.col("kind")
    digits = F.regexp_replace(match, "[^0-9]", "")
    bare = F.regexp_replace(match, r"^\+[0-9]{1,3}[\x20.-]?", "")
    return (F.when(kind == 0, F.regexp_replace(F.replace(match, F.lit("@"), F.lit(" [at] ")), r"\.(?=[A-Za-z0-9-]+$)", " [dot] "))
            .when(kind == 1, F.replace(match, F.lit("."), F.lit("[.]")))
            .when((kind == 2) & F.char_length(digits).between(15, 16), F.regexp_replace(digits, "(?<=^(?:[0-9]{4}){1,3})(?=[0-9])", "."))
            .when((kind == 3) & bare.rlike(f"^(?:{LOOSE['phone']})$"), bare))


def _side(char: Column) -> Column:
    return (F.when(char.rlike(r"^\s?$"), 0).when(char.rlike(r"^\p{L}"), 1).when(char.rlike("^[0-9]"), 2)
            .when(char.rlike(r"""^[.,;:!?"')(]"""), 3).otherwise(4))


# A tree: a margin, or (feature, bin, tree where the feature is at most that bin, tree elsewhere).
Tree = float | tuple


@dataclass
class Model:
    """Sum of trees, and the margin from which candidates of a kind and form (0: base, 1: looser) are taken."""

    bias: float
    trees: list[Tree]
    thresholds: dict[tuple[int, int], float]

    def margin(self) -> Column:
        return sum((_as_case(t) for t in self.trees), F.lit(self.bias))

    def selected(self) -> Column:
        out = F.lit(False)
        for (kind, loose), least in self.thresholds.items():
            out = F.when((F.col("kind") == kind) & (F.col("loose") == loose), self.margin() >= least).otherwise(out)
        return out & (F.col("fits") == 1)


def _as_case(tree: Tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, at, low, high = tree
    return F.when(F.col(feature) <= at, _as_case(low)).otherwise(_as_case(high))


def _grow(x: np.ndarray, names: list[str], grad: np.ndarray, hess: np.ndarray, depth: int, p: PiiParams) -> Tree:
    """A regression tree on cell sums of gradients, split where the Newton gain is largest."""
    g, h = grad.sum(), hess.sum()
    leaf = float(-p.step * g / (h + p.ridge))
    if not depth:
        return leaf
    best = (1e-6, None)
    for f in range(x.shape[1]):
        gs, hs = (np.cumsum(np.bincount(x[:, f], v, FEATURES[names[f]])) for v in (grad, hess))
        gain = gs**2 / (hs + p.ridge) + (g - gs)**2 / (h - hs + p.ridge) - g**2 / (h + p.ridge)
        at = int(gain[:-1].argmax())
        if gain[at] > best[0]:
            best = (float(gain[at]), (f, at))
    if best[1] is None:
        return leaf
    f, at = best[1]
    low = x[:, f] <= at
    return (names[f], at, _grow(x[low], names, grad[low], hess[low], depth - 1, p),
            _grow(x[~low], names, grad[~low], hess[~low], depth - 1, p))


def _apply(tree: Tree, x: np.ndarray, names: list[str]) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    feature, at, low, high = tree
    return np.where(x[:, names.index(feature)] <= at, _apply(low, x, names), _apply(high, x, names))


def fit(found: DataFrame, params: PiiParams | None = None) -> Model:
    """Boosted trees that tell true candidates from false ones by form and context.

    The check of a base match is no feature, that of a looser form is one and must hold as well. One half of the documents (by the hash of their text) is fitted; all
    rows of a kind and form weigh 1 together, so neither their number nor that of other kinds matters. The
    other half sets the threshold of each kind and form: the least margin at which the share of true
    candidates, averaged with the trees' own probability, reaches the precision asked for, never below even odds. A kind
    and form that never reaches it, or has no labelled row, gets no further spans.
    """
    p = params or PiiParams()
    names = list(FEATURES)
    half = F.pmod(F.col("th"), F.lit(2))
    cells = found.filter(F.col("truth").isNotNull()).groupBy(*names).agg(*[
        F.count_if((F.col("truth") == v) & (half == h)).alias(f"n{int(v)}_{h}") for h in (0, 1) for v in (False, True)])
    got = cells.collect()  # at most one row per combination of bins
    if len(got) > prod(FEATURES.values()):
        raise ValueError("a feature left its bins")
    x = np.array([[r[n] for n in names] for r in got], np.int64).reshape(len(got), len(names))
    bad, good = (np.array([r[f"n{v}_0"] for r in got], np.float64) for v in (0, 1))
    form = np.array([2 * r["kind"] + r["loose"] for r in got], np.int64)
    weight = np.bincount(form, bad + good, 2 * len(KINDS))[form]
    bad, good = (np.divide(v, weight, out=np.zeros_like(v), where=weight > 0) for v in (bad, good))
    share = (good.sum() + p.ridge) / (good.sum() + bad.sum() + 2 * p.ridge)
    bias = float(np.log(share / (1 - share)))
    margin, trees = np.full(len(got), bias), []
    for _ in range(p.rounds if len(got) else 0):
        prob = 1 / (1 + np.exp(-margin))
        tree = _grow(x, names, (good + bad) * prob - good, (good + bad) * prob * (1 - prob), 3, p)
        trees.append(tree)
        margin += _apply(tree, x, names)
    thresholds = {}
    for key in sorted(set(form.tolist())):
        kind, loose = divmod(key, 2)
        wanted = p.loose_precision if loose else p.precision
        rows = sorted(((float(m), r["n0_1"], r["n1_1"]) for m, r, f in zip(margin, got, form, strict=True) if f == key), reverse=True)
        fails = passes = 0
        for i, (m, b, g) in enumerate(rows):
            fails, passes = fails + b, passes + g
            tied = i + 1 < len(rows) and rows[i + 1][0] == m
            expected = (passes / max(passes + fails, 1) + p.prior / (1 + np.exp(-m))) / (1 + p.prior)
            if not tied and passes and m > 0 and expected >= wanted:
                thresholds[kind, loose] = m - 1e-9
    return Model(bias, trees, thresholds)


def spans(found: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, th, kind, start, stop, valid)``: all passing base matches, and of the others those the trees
    take. Where candidates overlap, a passing base match stands, else the best of them does."""
    taken = found.filter("made = 0").withColumn("margin", model.margin()).filter(F.col("valid") | model.selected())
    doc = Window.partitionBy("doc_id", "th")
    order = doc.orderBy("start", "stop", "kind", "loose")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = Window.partitionBy("doc_id", "th", "cluster")
    best = within.orderBy(F.desc("margin"), "start", "stop", "kind", "loose")
    return (taken.withColumn("reach", F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("cluster", F.sum(F.when(F.col("start") < F.col("reach"), 0).otherwise(1)).over(so_far))
            .withColumn("base", F.max("valid").over(within)).withColumn("place", F.row_number().over(best))
            .filter(F.col("valid") | (~F.col("base") & (F.col("place") == 1)))
            .select("doc_id", "th", "kind", "start", "stop", "valid"))


def find(docs: DataFrame, params: PiiParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of all documents; candidates are kept in the shared folder between fitting and choosing."""
    found = stored(candidates(docs, id_col, text_col), "pii_candidates")
    return spans(found, fit(found, params))


def _named(parts: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(parts, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def personal_data(docs: DataFrame, params: PiiParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of passing base matches per kind, a digest of them, and all spans, for every row.

    A null text has none. Spans are ``kind:start:end`` in code points, by start, then kind.
    """
    found = find(docs, params, id_col, text_col)
    per_doc = found.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(
        F.struct("start", "kind", "stop", "valid"))).alias("spans"))
    rows = docs.select(*_keyed(docs, id_col, text_col)).alias("r").join(
        per_doc.alias("s"), F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.th") == F.col("s.th")), "left")
    all_spans = F.coalesce(F.col("s.spans"), F.array().cast(per_doc.schema["spans"].dataType))
    base = F.filter(all_spans, lambda s: s["valid"])

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "r.doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_named(base).cast("binary"), 256).alias("base_sha256"), _named(all_spans).alias("spans"))


def redact(docs: DataFrame, params: PiiParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in brackets; overlapping spans become one, named after
    the first. Other columns stay as they are."""
    found = find(docs, params, id_col, text_col)
    order = Window.partitionBy("doc_id", "th").orderBy("start", "stop", "kind")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    islands = (found.withColumn("reach", F.max("stop").over(before))
               .withColumn("island", F.sum(F.when(F.col("start") < F.col("reach"), 0).otherwise(1)).over(
                   order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
               .groupBy("doc_id", "th", "island").agg(
                   F.min("start").alias("start"), F.max("stop").alias("stop"), F.min_by("kind", F.struct("start", "stop", "kind")).alias("kind")))
    per_doc = islands.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop", "kind"))).alias("_cut"))
    rows = docs.select(whole_row(docs), F.col(id_col).alias("_i"), F.xxhash64(text_col).alias("_h"))
    # Merged at every size: the spans of all documents are never broadcast.
    met = rows.join(per_doc.hint("merge"), F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_th")), "left")
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text, cut = F.col("row")[text_col], F.col("_cut")
    begun = lambda i: F.coalesce(F.get(cut, i - 1)["stop"], F.lit(0))
    pieces = F.transform(cut, lambda s, i: F.concat(
        F.substring(text, (begun(i) + 1).cast("int"), (s["start"] - begun(i)).cast("int")), F.get(tags, s["kind"])))
    tail = F.substring(text, (F.element_at(cut, -1)["stop"] + 1).cast("int"), F.char_length(text))
    clean = F.when(cut.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return met.select(*[(clean if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
