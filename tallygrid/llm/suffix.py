"""Suffix arrays of many short byte strings at once, and their common prefixes, in numpy."""

from __future__ import annotations

import numpy as np


class Shard:
    """Strings laid end to end with one zero between them, and their suffix array.

    The array is refined as Larsson and Sadakane do: suffixes are ranked by
    their first h symbols, and only those whose rank is still shared are ranked
    anew, by the rank h places on, which doubles h, until all ranks differ.
    ``depth`` is the longest common prefix that matters.
    """

    def __init__(self, strings: list[bytes], depth: int) -> None:
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.ends = self.starts + sizes
        n = int((sizes + 1).sum())
        self.text = np.zeros(n + 8, dtype=np.uint16)  # symbols 1 to 256; 0 ends a string
        inside = np.ones(n, dtype=bool)
        inside[self.ends] = False
        self.text[:n][inside] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.uint16) + 1
        self.depth = depth
        self.array, self.rank = self._sorted(n)

    def _sorted(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        key = np.zeros(n, dtype=np.int64)
        for i in range(7):  # seven symbols of nine bits
            key = (key << 9) | self.text[i : n + i].astype(np.int64)
        array = np.argsort(key, kind="stable")
        key = key[array]
        new = np.empty(n, dtype=bool)
        new[:1], new[1:] = True, key[1:] != key[:-1]
        heads = np.flatnonzero(new)
        group = heads[np.cumsum(new) - 1]  # each place's group is named by the group's first place
        rank = np.full(n + 1, -1, dtype=np.int64)
        rank[array] = group
        h = 7
        size = np.diff(np.append(heads, n))
        open_ = np.flatnonzero(np.repeat(size > 1, size))  # places in groups of more than one
        while len(open_):
            suffix = array[open_]
            own = rank[suffix]
            after = rank[np.minimum(suffix + h, n)]
            order = np.lexsort((after, own)) if n >= 1 << 31 else np.argsort(own * (n + 1) + after + 1, kind="stable")
            suffix, own, after = suffix[order], own[order], after[order]
            array[open_] = suffix
            new = np.empty(len(open_), dtype=bool)
            new[:1], new[1:] = True, (own[1:] != own[:-1]) | (after[1:] != after[:-1])
            heads = np.flatnonzero(new)
            rank[suffix] = open_[heads[np.cumsum(new) - 1]]
            size = np.diff(np.append(heads, len(open_)))
            open_ = open_[np.repeat(size > 1, size)]
            h *= 2
        return array, rank[:n]

    def common(self) -> np.ndarray:
        """For each place of the array the common prefix with the suffix before it, at most ``depth``, within both strings.

        Kasai's pass: going to the next suffix in the text, the common prefix
        shrinks by one at most. All strings are walked in step, up to their last
        suffix of ``depth`` symbols; shorter ones keep 0.
        """
        n = len(self.array)
        place = np.empty(n, dtype=np.int64)
        place[self.array] = np.arange(n)
        out = np.zeros(n, dtype=np.int64)
        text = self.text.astype(np.int32)
        text[np.append(self.ends, np.arange(n, len(text)))] = -1 - np.arange(len(self.ends) + len(text) - n)  # no two ends agree
        order = np.argsort(-(self.ends - self.starts), kind="stable")
        starts, sizes = self.starts[order], (self.ends - self.starts)[order] - self.depth + 1
        length = np.zeros(len(starts), dtype=np.int64)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -step, "left"))  # strings with a suffix at step
            at = starts[:live] + step
            where = place[at]
            before = self.array[where - 1]
            k = np.maximum(length[:live] - 1, 0)
            k[where == 0] = 0
            going = np.flatnonzero((where > 0) & (k < self.depth))
            while len(going):
                same = text[at[going] + k[going]] == text[before[going] + k[going]]
                going = going[same]
                k[going] += 1
                going = going[k[going] < self.depth]
            length[:live] = k
            out[where] = k
        return out

    def repeated(self) -> np.ndarray:
        """Per place of the text: whether its ``depth`` symbols start anywhere else in the shard."""
        n = len(self.array)
        equal = self.common() >= self.depth
        both = equal.copy()
        both[:-1] |= equal[1:]
        found = np.zeros(n, dtype=bool)
        found[self.array[both]] = True
        return found
