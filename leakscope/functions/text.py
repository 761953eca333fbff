"""Tokens, light stems, phrase-cover ranking and trigram similarity over text columns.

A document's lexeme list is its raw tokens followed by their stems, so a stem's position is its
token's position plus the token count. A query is a pair of term lists and matches when all raw
terms, or all stems, occur.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = r"[^\p{L}\p{N}]+"
# Suffixes dropped from words that keep at least three characters before them.
STEM_PATTERN = r"([\p{L}\p{N}]{3})(ings|ing|ied|ies|edly|ed|es|ly|s)([^\p{L}\p{N}]|$)"
# Weight of an unlabelled lexeme position in the cover-density formula.
COVER_WEIGHT = 0.1
_SHIFT = 1 << 31


def tokens(text: Column) -> Column:
    """Lower-case words of a text, in order."""
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def stems(text: Column) -> Column:
    """Stemmed words of a text, aligned with :func:`tokens`."""
    stripped = F.regexp_replace(F.lower(text), STEM_PATTERN, "$1$3")
    return F.array_remove(F.split(stripped, SEPARATORS), "")


def lexemes(text: Column) -> Column:
    return F.concat(tokens(text), stems(text))


def contains_all(lexeme_list: Column, terms: list[str]) -> Column:
    """True when every literal term is in the list; false for no terms."""
    if not terms:
        return F.lit(False)
    found = F.array_contains(lexeme_list, terms[0])
    for term in terms[1:]:
        found = found & F.array_contains(lexeme_list, term)
    return found


def text_matches(text: Column, raw_terms: list[str], stem_terms: list[str]) -> Column:
    """True when a text without stored lexemes holds all raw terms or all stems.

    The one-element array binds the lexeme list, so the text is cut once and not per term.
    """
    tested = F.transform(F.array(lexemes(text)), lambda lex: contains_all(lex, raw_terms) | contains_all(lex, stem_terms))
    return F.get(tested, F.lit(0))


def cover_density(lexeme_list: Column, raw_terms: Column, stem_terms: Column) -> Column:
    """Cover-density rank of a lexeme list for an "all raw terms or all stems" query.

    A cover is a minimal span that satisfies the query (Clarke, Cormack and Tudhope 1999). Each
    adds ``COVER_WEIGHT / (1 + words in the span that are not query terms)``. The fold walks only
    the query-term hits of one document and keeps, for each term, its last hit packed as
    ``hit number * 2^31 + position``; the latest span start that still satisfies the query is then
    the least last hit over the terms. A span is minimal when its start moved forward.
    """
    hits = F.filter(
        F.transform(
            lexeme_list,
            lambda word, i: F.struct(
                i.cast("bigint").alias("pos"),
                F.array_position(raw_terms, word).alias("a"),
                F.array_position(stem_terms, word).alias("b"),
            ),
        ),
        lambda h: (h["a"] > 0) | (h["b"] > 0),
    )
    return cover_density_of(hits, raw_terms, stem_terms)


def cover_density_of(hits: Column, raw_terms: Column, stem_terms: Column) -> Column:
    """:func:`cover_density` of ready hits: ``(pos, a, b)`` in order of position, ``a`` and ``b`` the place of the
    word among the raw terms and the stems, 0 for none."""
    base = F.lit(_SHIFT).cast("bigint")
    numbered = F.transform(
        hits,
        lambda h, n: F.struct((n.cast("bigint") * base + h["pos"]).alias("key"), h["a"].alias("a"), h["b"].alias("b")),
    )

    def touch(last: Column, slot: Column, key: Column) -> Column:
        return F.transform(last, lambda v, i: F.when(i + 1 == slot, key).otherwise(v))

    def unseen(terms: Column) -> Column:
        return F.transform(terms, lambda _: F.lit(-1).cast("bigint"))

    none = F.lit(-1).cast("bigint")

    def latest_start(raw_last: Column, stem_last: Column) -> Column:
        return F.greatest(F.coalesce(F.array_min(raw_last), none), F.coalesce(F.array_min(stem_last), none))

    def seen(state: Column, h: Column) -> Column:
        return F.struct(
            touch(state["raw_last"], h["a"], h["key"]).alias("raw_last"),
            touch(state["stem_last"], h["b"], h["key"]).alias("stem_last"),
            state["start"].alias("start"), state["score"].alias("score"), h["key"].alias("key"),
        )

    def located(state: Column) -> Column:
        return F.struct(state.alias("s"), latest_start(state["raw_last"], state["stem_last"]).alias("from"))

    def scored(x: Column) -> Column:
        state, start = x["s"], x["from"]
        mask = F.lit(_SHIFT - 1).cast("bigint")
        words = state["key"].bitwiseAND(mask) - start.bitwiseAND(mask)
        hit_steps = F.shiftright(state["key"], 31) - F.shiftright(start, 31)
        gained = F.when(start > state["start"], F.lit(COVER_WEIGHT) / (F.lit(1) + words - hit_steps)).otherwise(0.0)
        return F.struct(
            state["raw_last"].alias("raw_last"), state["stem_last"].alias("stem_last"),
            F.greatest(start, state["start"]).alias("start"), (state["score"] + gained).alias("score"),
        )

    def step(state: Column, h: Column) -> Column:
        # one-element arrays bind each intermediate value once inside the lambda
        after = F.transform(F.array(seen(state, h)), located)
        return F.get(F.transform(after, scored), F.lit(0))

    empty = F.struct(
        unseen(raw_terms).alias("raw_last"), unseen(stem_terms).alias("stem_last"),
        none.alias("start"), F.lit(0.0).alias("score"),
    )
    return F.aggregate(numbered, empty, step, lambda s: F.round(s["score"], 6))


def trigrams(text: Column) -> Column:
    """Distinct 3-character pieces of each word, padded two blanks in front and one behind."""
    padded = F.transform(F.array_distinct(tokens(text)), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    per_word = F.transform(
        padded,
        lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(per_word))


def trigram_similarity(left: Column, right: Column) -> Column:
    """Shared trigrams over all trigrams of two texts, 0..1."""
    a, b = trigrams(left), trigrams(right)
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return F.try_divide(shared, F.size(a) + F.size(b) - shared)
