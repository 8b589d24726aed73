"""Squares in a growing sequence of words, caught online by blocks of power-of-two length.

Every completed block of 2 ** j words at a multiple of 2 ** j has a catcher. A
square of period p with 2 * 2 ** j <= p < 4 * 2 ** j holds such a block in its
first half, and the block occurs again p words later. So an appended word, which
completes one window of every such length, is compared with two catchers of
each: those whose distance to it lies in their range. A catch starts a suffix
comparison: how far the words before and behind agree at that distance. Each
word appended later carries it on until one differs. A stretch that agrees at
distance p over p words or more is a chain of squares, one ending at each word,
which merge into one run.

Words are compared through fingerprints of two primes; whoever reports a run
checks it word by word (:meth:`Squares.runs`).
"""

from __future__ import annotations

import numpy as np

from tallygrid.llm.textnum import mixed

#: Two primes below 2 ** 31 and a base for each.
PRIMES = ((2147483647, 1103515245), (2147483629, 1664525))


class Collision(Exception):
    """Different words had equal fingerprints; another seed tells them apart."""


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled : filled + step] = out[:step] * np.uint64(pow(base, filled, prime)) % np.uint64(prime)
        filled += step
    return out


class _Sums:
    """Fingerprints of any windows of a growing sequence modulo one prime."""

    def __init__(self, prime: int, base: int, seed: int) -> None:
        self.prime, self.base, self.inverse, self.seed = np.uint64(prime), base, pow(base, -1, prime), np.uint64(seed)
        self.up = self.down = np.ones(1, dtype=np.uint64)
        self.sums = np.zeros(1, dtype=np.uint64)

    def append(self, words: np.ndarray) -> None:
        n = len(self.sums) + len(words)
        if n > len(self.up):
            self.up, self.down = (_powers(b, int(self.prime), 2 * n) for b in (self.base, self.inverse))
        values = mixed(words.astype(np.uint64) ^ self.seed) % self.prime
        terms = values * self.up[len(self.sums) - 1 : n - 1] % self.prime
        self.sums = np.concatenate([self.sums, self.sums[-1] + np.cumsum(terms)])  # below 2 ** 31 times the words

    def windows(self, first: int, stop: int, length: int) -> np.ndarray:
        """Of the windows that start at first..stop-1."""
        inner = self.sums[first + length : stop + length] - self.sums[first:stop]
        return inner % self.prime * self.down[first:stop] % self.prime

    def same(self, x: np.ndarray, y: np.ndarray, length: int) -> np.ndarray:
        """Whether the windows at x and y (x < y) are equal."""
        left, right = ((self.sums[at + length] - self.sums[at]) % self.prime for at in (x, y))
        return left * self.up[y - x] % self.prime == right


class Squares:
    """The squares of all words appended so far.

    ``stretches`` has one entry per chain of squares, (period, start) to the
    end of the stretch that agrees: words start..end-1 equal those one period
    later. A stretch that has reached the last word is kept even while it is
    shorter than its period: words to come may make it a square. Parts that no
    square may cross are parted by words that occur once (see :func:`joined`).
    """

    def __init__(self, seed: int = 0) -> None:
        self.words = np.zeros(0, dtype=np.int64)
        self.sums = [_Sums(prime, base, seed * 0x9E3779B97F4A7C15 % (1 << 64)) for prime, base in PRIMES]
        self.catchers: list[np.ndarray] = []
        self.stretches: dict[tuple[int, int], int] = {}

    def append(self, words: np.ndarray) -> None:
        """One word or many; the order of the words alone decides the result."""
        old = len(self.words)
        self.words = np.concatenate([self.words, words])
        for sums in self.sums:
            sums.append(words)
        self._carry_on(old)
        level = 0
        while 4 << level <= len(self.words) or level == 0:
            self._catch(level, old)
            level += 1

    def _carry_on(self, old: int) -> None:
        """Advance the stretches that had reached the end; those that stop short of a square go."""
        still = [(key, end) for key, end in self.stretches.items() if end + key[0] == old]
        if still:
            ends, periods = np.array([end for _, end in still]), np.array([key[0] for key, _ in still])
            for (key, _), end in zip(still, ends + self._agree(ends, ends + periods), strict=True):
                self.stretches[key] = int(end)
                if end - key[1] < key[0] and end + key[0] < len(self.words):
                    del self.stretches[key]

    def _windows(self, first: int, stop: int, length: int) -> np.ndarray:
        a, b = (sums.windows(first, stop, length) for sums in self.sums)
        return a << np.uint64(32) | b

    def _catch(self, level: int, old: int) -> None:
        """Compare the windows of 2 ** level words that the appended words completed with the catchers."""
        length, n = 1 << level, len(self.words)
        first = max(old - length + 1, 0)
        if level == len(self.catchers):
            self.catchers.append(np.zeros(0, dtype=np.uint64))
            first = 0
        if n - length + 1 <= first:
            return
        own = self._windows(first, n - length + 1, length)
        starts = np.arange(first, n - length + 1)
        held = self.catchers[level]
        self.catchers[level] = np.concatenate([held, own[len(held) * length - first :: length]])
        blocks, caught = self.catchers[level], []
        for back in (1, 2, 3) if level == 0 else (2, 3):
            at = starts // length - back
            skip = int(np.searchsorted(at, 0))
            hit = np.flatnonzero(blocks[at[skip:]] == own[skip:]) + skip
            caught.append((at[hit] * length, starts[hit]))
        block, window = (np.concatenate(x) for x in zip(*caught, strict=True))
        inside = window + length <= self._known_until(level)[block // length]
        block, window = block[~inside], window[~inside]
        if len(block):
            self._compare(block, window - block, length)

    def _known_until(self, level: int) -> np.ndarray:
        """Per block the end of the known run of at most half its length in period that holds it, else 0.

        There is at most one. Within it the block recurs at multiples of that
        period only, so what it catches there is no new run.
        """
        length = 1 << level
        until = np.zeros(len(self.catchers[level]), dtype=np.int64)
        for (period, start), end in self.stretches.items():
            if 2 * period <= length and end + period - start >= 2 * length:
                until[-(-start // length) : (end + period) // length] = end + period
        return until

    def _compare(self, block: np.ndarray, period: np.ndarray, length: int) -> None:
        """Suffix comparisons of blocks with their copies a period later; the first of each chain of adjoining blocks is enough."""
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        chained = np.zeros(len(block), dtype=bool)
        chained[1:] = (period[1:] == period[:-1]) & (block[1:] - block[:-1] == length)
        block, period = block[~chained], period[~chained]
        before = self._agree(block, block + period, back=True)
        after = self._agree(block, block + period)
        held = (before + after >= period) | (block + after + period == len(self.words))
        for p, start, end in zip(period[held].tolist(), (block - before)[held].tolist(), (block + after)[held].tolist(), strict=True):
            self.stretches[p, start] = end

    def _agree(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from x and y on are equal; with ``back``, how many before them."""
        n, agreed = len(self.words), np.zeros(len(x), dtype=np.int64)
        for level in range(n.bit_length(), -1, -1):
            length = 1 << level
            a, b = (x - agreed - length, y - agreed - length) if back else (x + agreed, y + agreed)
            open_ = np.flatnonzero(a >= 0 if back else b + length <= n)
            if len(open_):
                equal = self.sums[0].same(a[open_], b[open_], length)
                open_ = open_[equal]
                agreed[open_[self.sums[1].same(a[open_], b[open_], length)]] += length
        return agreed

    def runs(self, least: int, times: int) -> np.ndarray:
        """Rows (start, length, period) by start and period: the runs of at least ``least`` words and ``times`` periods.

        Of squares with equal bounds the smallest period counts: the others are
        its multiples. Raises :class:`Collision` if words of a run differ.
        """
        found: dict[tuple[int, int], int] = {}
        for (period, start), end in self.stretches.items():
            size = end + period - start
            if size >= max(least, times * period):
                found[start, size] = min(period, found.get((start, size), period))
        for (start, size), period in found.items():
            if not np.array_equal(self.words[start : start + size - period], self.words[start + period : start + size]):
                raise Collision
        return np.array(sorted((start, size, period) for (start, size), period in found.items()), dtype=np.int64).reshape(-1, 3)


def joined(parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, each part followed by a number of its own, and where the parts start."""
    known: dict[str, int] = {}
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    out = np.empty(int(sizes.sum()) + len(parts), dtype=np.int64)
    number = known.setdefault
    for i, (start, part) in enumerate(zip(starts.tolist(), parts, strict=True)):
        out[start : start + len(part)] = [number(w, len(known)) for w in part]
        out[start + len(part)] = -1 - i
    return out, starts


def runs_of(parts: list[list[str]], least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Per run its part, and (start in the part, length, period), in order."""
    words, starts = joined(parts)
    seed = 0
    while True:
        squares = Squares(seed)
        squares.append(words)
        try:
            runs = squares.runs(least, times)
            break
        except Collision:
            seed += 1
    part = np.searchsorted(starts, runs[:, 0], "right") - 1
    runs[:, 0] -= starts[part]
    return part, runs
