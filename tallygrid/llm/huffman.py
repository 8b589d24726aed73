"""Canonical length-limited Huffman codes of token ids, in numpy.

Blocks are coded independently. A block has a checkpoint, the bit offset, every
STRIDE ids; decoding walks all checkpoints of a block in step, each by one
table lookup an id.
"""

from __future__ import annotations

import numpy as np

#: Longest code in bits, and ids between two checkpoints.
LIMIT, STRIDE = 16, 64


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Code lengths of at most LIMIT bits by package-merge; 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << LIMIT:
        raise ValueError("too many symbols for the longest code")
    leaves = used[np.argsort(counts[used], kind="stable")]
    weights = counts[leaves].astype(np.float64)
    merged = weights
    is_leaf: list[np.ndarray] = []
    for _ in range(LIMIT - 1):  # lists from the deepest level up: leaves merged with the pairs of the list below
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        is_leaf.append(order < len(weights))
        merged = both[order]
    take = 2 * len(leaves) - 2
    for level in reversed(is_leaf):
        chosen = int(np.count_nonzero(level[:take]))
        lengths[leaves[:chosen]] += 1
        take = 2 * (take - chosen)
    lengths[leaves[:take]] += 1
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: by length, then id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    out = np.zeros(len(lengths), dtype=np.uint64)
    if len(order):
        own = lengths[order].astype(np.uint64)
        steps = np.uint64(1) << (np.uint64(LIMIT) - own)
        first = np.concatenate([[0], np.cumsum(steps)[:-1]]).astype(np.uint64)
        out[order] = first >> (np.uint64(LIMIT) - own)
    return out


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each LIMIT bits: the id that they begin with, and its length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = np.int64(1) << (LIMIT - lengths[order].astype(np.int64))
    ids, widths = np.repeat(order, spans), np.repeat(lengths[order], spans)
    rest = (1 << LIMIT) - len(ids)
    return np.pad(ids, (0, rest)).astype(np.int64), np.pad(widths, (0, rest)).astype(np.int64)


def encode_block(ids: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The block's bits, most significant first, and the bit offset of every STRIDE-th id."""
    if not len(ids):
        return b"", np.zeros(0, dtype=np.int64)
    widths = lengths[ids].astype(np.int64)
    if not widths.all():
        raise ValueError("an id without a code")
    ends = np.cumsum(widths)
    starts = ends - widths
    word, shift = starts >> 5, 64 - (starts & 31) - widths  # each code lies in the 64 bits from its 32-bit word on
    value = table[ids] << shift.astype(np.uint64)
    firsts = np.flatnonzero(np.diff(word, prepend=-1))
    packed = np.zeros((int(ends[-1]) >> 5) + 2, dtype=np.uint64)
    sums = np.add.reduceat(value, firsts)  # codes don't overlap, so sums are unions
    at = word[firsts]
    packed[at] += sums >> np.uint64(32)
    packed[at + 1] += sums & np.uint64(0xFFFFFFFF)
    data = packed.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8]
    return data, starts[::STRIDE]


def decode_block(data: bytes, n: int, checkpoints: np.ndarray, ids: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The block's n ids."""
    if not n:
        return np.zeros(0, dtype=np.int64)
    padded = np.frombuffer(data + bytes(8), dtype=np.uint8).astype(np.uint32)
    window = (padded[:-2] << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | padded[2:]  # 24 bits from every byte on
    at = checkpoints.astype(np.int64).copy()
    out = np.zeros((STRIDE, len(at)), dtype=np.int64)
    last = len(window) - 1
    for step in range(min(n, STRIDE)):
        # The last checkpoint may end early; what it reads beyond is cut off below.
        bits = (window[np.minimum(at >> 3, last)] >> (8 - (at & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
        out[step] = ids[bits]
        at += widths[bits]
    return out.T.reshape(-1)[:n]
