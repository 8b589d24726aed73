"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    text = text or ""
    own = words(text)
    windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(own) < 20 or 100 * len(repeated) > 30 * len(own)
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


def targets(sizes, weights=(3, 1, 2)):
    """sizes: source to words; water filling by rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()) * 1.5, set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def shingle_set(text, k):
    own = words((text or "").translate(_LOWER))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + k]) for i in range(max(1, len(own) - k + 1)))


def components(rows, k, percent):
    """rows: (id, text); all pairs."""
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in up}


def covered(texts, length):
    """Per text a list of flags: bytes in a string of ``length`` that starts anywhere else too."""
    data = [(t or "").encode() for t in texts]
    times = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        flags = [False] * len(d)
        for i in range(len(d) - length + 1):
            if times[d[i : i + length]] > 1:
                flags[i : i + length] = [True] * length
        out.append(flags)
    return out


def without(text, flags):
    data = (text or "").encode()
    kept = bytes(b for b, f in zip(data, flags, strict=True) if not f)
    runs = sum(f and not g for f, g in zip(flags, [False, *flags], strict=False))
    return len(data), sum(flags), runs, hashlib.sha256(kept).hexdigest()


def unigram(train, text):
    """Tokens, known tokens, training tokens, base score; train: texts."""
    tokens = lambda t: [*words((t or "").translate(_LOWER)), None]
    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    own = tokens(text)
    return len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)


def runs(own, least=6, times=4):
    """(start, length, period) of the maximal stretches with their smallest period."""
    found = {}
    for q in range(1, len(own) // times + 1):
        i = 0
        while i < len(own) - q:
            j = i
            while j < len(own) - q and own[j] == own[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((i, n, q) for (i, n), q in found.items())


def tail_repeated(doc_id, own):
    h, n = zlib.crc32(str(doc_id).encode()), len(own)
    if h % 10 or not n:
        return own
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]


def run_row(doc_id, text):
    own = tail_repeated(doc_id, words(text))
    all_ = runs(own)
    dropped = {i for s, n, q in all_ for i in range(s + q, s + n)}
    best = min(all_, key=lambda r: (-r[1], r[0], r[2])) if all_ else (None, None, None)
    kept = " ".join(w for i, w in enumerate(own) if i not in dropped)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in all_)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return doc_id, len(all_), *best, best[1] * 1000 // best[2] if all_ else None, sha(lines), sha(kept)


def whole_vectors(rows):
    """(id, label, whole numbers) of the rows (id, vector, label) that take part."""
    fine = [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(r[0], r[2], [math.floor(256 * x) for x in r[1]]) for r in fine]


def ranked(one, rows):
    """(score, id, label) of the other rows with vectors as long, best first."""
    scored = [(sum(x * y for x, y in zip(one[2], r[2], strict=True)), r[0], r[1]) for r in rows if r is not one and len(r[2]) == len(one[2])]
    return sorted(scored, key=lambda r: (-r[0], r[1]))


def hard_negatives(rows, every=100):
    full = [r for r in whole_vectors(rows) if r[1] is not None]
    out = []
    for a in (r for r in full if r[0] % every == 0):
        others = ranked(a, full)
        for score, positive, _ in [r for r in others if r[2] == a[1]][:5]:
            band = [r for r in others if r[2] != a[1] and 80 * score <= 100 * r[0] <= 100 * score][:5]
            out += [(a[0], positive, k + 1, r[1], score, r[0]) for k, r in enumerate(band)]
    return sorted(out)
