"""Plain Python versions of the operators' results, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile("[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def quality(text):
    w = words(text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
            "base_failed": len(w) < 50 or 100 * len(hit) > 50 * len(w)}


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, distance=2):
    """Root index of each fingerprint."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def substrings(docs, window=20):
    """{doc_id: (n_words, n_removed, sha)} of (doc_id, text) with distinct ids."""
    first = {}
    split = {d: words(t) for d, t in docs}
    for d in sorted(split):
        w = split[d]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), (d, i))
    out = {}
    for d, w in split.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] != (d, i):
                gone.update(range(i, i + window))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii(text):
    """Base spans (start, kind number, end)."""
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def spans_text(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


BENCH_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text):
    return BENCH_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(text, items, size=13):
    """(n_words, n_hit, items digest, n_items)."""
    w = bench_words(text)
    hit, found = set(), set()
    for item, body in items:
        b = bench_words(body)
        for j in range(max(1, len(b) - size + 1) if b else 0):
            win = b[j:j + size]
            for i in range(len(w) - len(win) + 1):
                if w[i] == win[0] and w[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    found.add(str(item))
    return len(w), len(hit), sha(",".join(sorted(found))), len(found)


def tokens(texts, name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def lpt(sizes, shards):
    """Loads of longest-processing-time scheduling, sorted."""
    import heapq

    heap = [(0, k) for k in range(shards)]
    for s in sorted(sizes, reverse=True):
        load, k = heap[0]
        heapq.heapreplace(heap, (load + s, k))
    return sorted(load for load, _ in heap)


def mcd_distances(x, floors, share=0.75, near=12.83, starts=40, seed=0):
    """Squared distances from the reweighted least-determinant estimate: exact concentration from random starts."""
    rng, h, add = np.random.default_rng(seed), share * len(x), np.diag(np.square(floors))

    def distance(m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)

    def moments(weight):
        m = weight @ x / weight.sum()
        return m, ((x - m) * weight[:, None]).T @ (x - m) / weight.sum() + add

    best = None
    for _ in range(starts):
        weight, last = np.zeros(len(x)), None
        weight[rng.choice(len(x), 6, replace=False)] = 1
        for _ in range(200):
            m, c = moments(weight)
            logdet = np.linalg.slogdet(c)[1]
            if last is not None and abs(last - logdet) < 1e-9:
                break
            last, weight = logdet, np.zeros(len(x))
            order = np.argsort(distance(m, c), kind="stable")
            weight[order[:int(h)]] = 1
            if int(h) < h:
                weight[order[int(h)]] = h - int(h)
        if best is None or logdet < best[0]:
            best = logdet, m, c
    d2 = distance(*best[1:])
    close = (d2 <= near * max(np.median(d2) / 4.351, 1)).astype(float)
    d2 = distance(*moments(close))
    return d2 / max(np.median(d2) / 4.351, 1), best[0]
