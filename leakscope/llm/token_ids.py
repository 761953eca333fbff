"""Token ids of whole texts with a tokenizers file, through a cache of space-separated pieces.

Both tokenizers used here look at a text one pre-token at a time, and a single space between two
characters that are not white space always starts a new pre-token. So ids of a text are the ids of its
pieces, each with its leading space, one after the other. Most pieces of a batch were met before; only
new ones go through the library. Texts in which a space stands beside other white space, or at an end,
go through it whole. A tokenizer that lower-cases and drops white space gives no ids for the space itself,
so there any space or line feed is a cut, and pieces that differ in ASCII case only are one. A text that holds a
special token goes through the library whole, as it is, so it gets the ids a plain call gives.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces kept per worker, some 60 MB; beyond it those met in one slab only are forgotten.
CACHE_PIECES = 1_000_000
# Bytes of text worked on at once.
SLAB = 8 << 20
# Pieces encoded together.
JOINED = 4096

_open: dict[str, "TokenIds"] = {}


def token_ids(path: str) -> "TokenIds":
    """The encoder of a tokenizers file, one per worker process."""
    if path not in _open:
        _open[path] = TokenIds(path)
    return _open[path]


class TokenIds:
    """Encodes text arrays to one flat id array and the length of each text's part."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        # For pieces, which hold no special token; folding its case must not make one.
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The plain one, for texts with a special token; the last of these can also stand between pieces.
        self.plain = Tokenizer.from_file(path)
        added = sorted(self.plain.get_added_tokens_decoder().items())
        self.added = [t.content for _, t in added]
        self.mark_id, mark = [t for t in added if t[1].special][-1]
        self.mark = mark.content
        self.folds = self._drops_case_and_space()
        self._reset()

    def _drops_case_and_space(self) -> bool:
        step = json.loads(self.tokenizer.to_str())["normalizer"] or {}
        lower = any(s.get("type") == "Lowercase" for s in step.get("normalizers", [step]))
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        return lower and ids(" \n\t ") == [] and ids("A.\n 9") == ids("a. 9") == [*ids("a."), *ids("9")]

    def _reset(self) -> None:
        self.pieces = pa.array([], pa.large_string())
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")
        self.slabs = np.zeros(0, np.int32)  # slabs each piece was met in

    def _forget(self) -> None:
        """Drop the pieces met in one slab only, or all if that is not enough."""
        keep = self.slabs > 1
        if 2 * keep.sum() > CACHE_PIECES:
            return self._reset()
        self.ids = self.ids[np.repeat(keep, self.lengths)]
        self.pieces = self.pieces.filter(pa.array(keep))
        self.lengths, self.slabs = self.lengths[keep], np.ones(int(keep.sum()), np.int32)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Like ``_encode`` for many short texts: a batch goes through the library as one text, with the
        special token between pieces. A batch with a piece that may hold such a token itself goes one by one."""
        if any("<|" in p for p in pieces):
            return self._encode(pieces)
        parts, lengths = [], []
        for at in range(0, len(pieces), JOINED):
            some = pieces[at:at + JOINED]
            joined = self.plain.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)[0].ids
            ids = np.array(joined, "<u4")
            marks = np.flatnonzero(ids == self.mark_id)
            parts.append(np.delete(ids, marks))
            lengths.append(np.diff(marks, prepend=-1, append=len(ids)) - 1)
        return (np.concatenate(parts), np.concatenate(lengths)) if parts else self._encode([])

    def _encode(self, texts: list[str], plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
        tokenizer = self.plain if plain else self.tokenizer
        got = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((i for ids in got for i in ids), "<u4", int(lengths.sum()))
        return flat, lengths

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Cache places of distinct pieces; new ones are encoded first."""
        if len(self.pieces) > CACHE_PIECES:
            self._forget()
        places = pc.index_in(pieces, value_set=self.pieces)
        new = pieces.filter(pc.is_null(places))
        if len(new):
            flat, lengths = self._encode_pieces(new.to_pylist())
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, flat])
            first = len(self.pieces)
            self.pieces = pa.concat_arrays([self.pieces, new])
            out = places.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            out[out < 0] = np.arange(first, len(self.pieces))
            self.slabs = np.concatenate([self.slabs, np.zeros(len(new), np.int32)])
        else:
            out = places.to_numpy(zero_copy_only=False).astype(np.int64)
        self.slabs[out] += 1
        return out

    def _slab(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        raw, special = texts, np.zeros(len(texts), bool)
        for content in self.added:
            special |= pc.match_substring(raw, content).to_numpy(zero_copy_only=False)
        if self.folds:
            texts = pc.ascii_lower(pc.replace_substring(texts, "\n", " "))
        spaced = pc.split_pattern(texts, " ")
        per_text = pc.list_value_length(spaced).to_numpy(zero_copy_only=False).astype(np.int64)
        values = spaced.flatten()
        coded = values.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # A piece that is empty, or has white space at an end, stood beside another white space.
        loose = pc.or_(pc.not_equal(pc.utf8_trim_whitespace(coded.dictionary), coded.dictionary),
                       pc.equal(coded.dictionary, "")).to_numpy(zero_copy_only=False)
        if self.folds:
            loose = np.zeros(len(loose), bool)
        ends = np.cumsum(per_text)
        odd = np.add.reduceat(loose[codes], ends - per_text) > 0 if len(codes) else np.zeros(0, bool)
        odd |= special
        lead = np.zeros(len(codes), bool)
        lead[ends - per_text] = True
        if odd.any():
            keep = ~np.repeat(odd, per_text)
            codes, lead, ends = codes[keep], lead[keep], np.cumsum(per_text[~odd])
        seen = np.zeros(len(coded.dictionary), bool)  # as anything but the first piece of a text
        seen[codes[~lead]] = True
        place = np.zeros(len(seen), np.int64)
        with_space = pc.binary_join_element_wise(
            pa.scalar("", pa.large_string()), coded.dictionary.filter(pa.array(seen)), pa.scalar(" ", pa.large_string()))
        place[seen] = self._places(with_space)
        at = place[codes]
        first_codes, back = np.unique(codes[lead], return_inverse=True)
        firsts = coded.dictionary.take(pa.array(first_codes))
        flat_first, len_first = self._encode_pieces(firsts.to_pylist())
        base = len(self.ids)
        pool = np.concatenate([self.ids, flat_first])
        starts, lengths = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        starts[~lead], lengths[~lead] = self.starts[at[~lead]], self.lengths[at[~lead]]
        starts[lead] = (base + np.cumsum(len_first) - len_first)[back]
        lengths[lead] = len_first[back]
        total = int(lengths.sum())
        out_at = np.cumsum(lengths) - lengths
        flat = pool[np.repeat(starts - out_at, lengths) + np.arange(total)]
        token_ends = np.concatenate([[0], np.cumsum(lengths)])
        text_ends = np.concatenate([[0], ends])
        counts = np.diff(token_ends[text_ends])
        if not odd.any():
            return flat, counts
        whole, whole_n = self._encode(raw.filter(pa.array(odd)).to_pylist(), plain=True)
        parts = [None] * len(texts)
        for idx, ids, n in ((np.flatnonzero(~odd), flat, counts), (np.flatnonzero(odd), whole, whole_n)):
            for i, part in zip(idx, np.split(ids, np.cumsum(n)[:-1]) if len(n) else [], strict=True):
                parts[i] = part
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def encode(self, texts: pa.Array):
        """Slabs ``(ids, lengths)`` over a string array in order; nulls count as empty texts."""
        texts = texts.fill_null("").cast(pa.large_string())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        slab = np.cumsum(sizes) // SLAB
        cuts = [0, *(np.flatnonzero(np.diff(slab)) + 1), len(texts)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield self._slab(texts.slice(a, b - a))
                pa.default_memory_pool().release_unused()

