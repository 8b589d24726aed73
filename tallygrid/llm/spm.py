"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding.

Spaces are written as a marker, and one stands before the text. The best
segmentation has the greatest sum of the pieces' log scores; a character that
no piece begins with alone falls back to its bytes. A marker in the text itself
does so too, so decoding gives back every text exactly.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.bpe import kept
from tallygrid.llm.common import freed
from tallygrid.llm.textnum import raw

MARK = "▁"
_MARK_BYTES = MARK.encode()
#: What an uncovered character scores below the worst piece.
PENALTY = 10.0
#: Remembered stretches of a worker process, and those it may keep (some 10 MB) when a task has ended.
REMEMBERED, KEPT = 600_000, 60_000
_RUNS = re.compile(r" +[^ ]*|[^ ]+")


class DoubleArray:
    """A trie of byte strings: the child of node s by byte c is base[s] + c + 1 if check[] there is s; by 0 it holds the value."""

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        order = sorted(range(len(keys)), key=lambda i: keys[i])
        self.base, self.check = [0] * 1024, [-1] * 1024
        self.check[0] = 0
        self._free = 1
        work = [(0, 0, len(order), 0)]
        while work:
            node, a, b, depth = work.pop()
            symbols, cuts = [], []
            for i in range(a, b):
                key = keys[order[i]]
                symbol = key[depth] + 1 if len(key) > depth else 0
                if not symbols or symbols[-1] != symbol:
                    symbols.append(symbol)
                    cuts.append(i)
            cuts.append(b)
            base = self._room(symbols)
            self.base[node] = base
            for symbol in symbols:
                self.check[base + symbol] = node
            for symbol, low, high in zip(symbols, cuts, cuts[1:], strict=False):
                if symbol:
                    work.append((base + symbol, low, high, depth + 1))
                else:
                    self.base[base] = -1 - values[order[low]]

    def _room(self, symbols: list[int]) -> int:
        base = max(1, self._free - symbols[0])
        while True:
            if base + 300 > len(self.check):
                self.base += [0] * len(self.base)
                self.check += [-1] * len(self.check)
            if all(self.check[base + s] < 0 for s in symbols):
                break
            base += 1
        while self.check[self._free] >= 0:
            self._free += 1
        return base

    def matches(self, data: bytes, at: int) -> list[tuple[int, int]]:
        """(end, value) of every key that begins at ``at``, shortest first."""
        base, check, node, out = self.base, self.check, 0, []
        size = len(check)
        while True:
            leaf = base[node]
            if check[leaf] == node and base[leaf] < 0:
                out.append((at, -1 - base[leaf]))
            if at == len(data):
                return out
            child = leaf + data[at] + 1
            if child >= size or check[child] != node:
                return out
            node = child
            at += 1


@dataclass
class Pieces:
    """A model's pieces: text, log score, and kind: normal, byte or other."""

    texts: list[str]
    scores: list[float]
    byte_ids: list[int]
    normal: list[int]

    @staticmethod
    def load(path: str) -> Pieces:
        """From a model file. A unigram model's scores are log scores already.

        A merge model's are whole numbers and say only the order of its merges; a piece of rank r is
        then taken to be as likely as Zipf's law has it, 1 / (r + 1) over the
        sum of all.
        """
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        texts, scores = [model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        bytes_ = {int(texts[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(bytes_) < 256:
            raise ValueError("the model has no byte pieces")
        ranked = sorted(normal, key=lambda i: (-scores[i], i))
        if all(float(scores[i]).is_integer() for i in ranked):
            total = float(np.log((1 / np.arange(1, len(ranked) + 1)).sum()))
            for r, i in enumerate(ranked):
                scores[i] = -float(np.log(r + 1)) - total
        return Pieces(texts, scores, [bytes_[b] for b in range(256)], normal)


class Codec:
    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.trie = DoubleArray([pieces.texts[i].encode() for i in pieces.normal], pieces.normal)
        self.unknown = min(pieces.scores[i] for i in pieces.normal) - PENALTY
        inner = [pieces.texts[i] for i in pieces.normal]
        #: No piece goes on behind a word into the next marker, or over a line end: stretches between them are independent.
        self.split = not any(MARK in t.lstrip(MARK) for t in inner)
        self.lines = not any("\n" in t for t in inner)
        self.known: dict[str, bytes] = {}
        out = [t.replace(MARK, " ").encode() for t in pieces.texts]
        for b, i in enumerate(pieces.byte_ids):
            out[i] = bytes([b])
        self.out = out

    def segment(self, stretch: str) -> list[int]:
        """Ids of the best segmentation of a stretch in which spaces stand for markers; of equal ones that with the shorter last pieces."""
        parts = stretch.split(MARK)
        data = b"\xff".join(raw(p.replace(" ", MARK)) for p in parts)  # a marker of the text itself: no piece has this byte
        n = len(data)
        best, back, scores = [-1e300] * (n + 1), [(0, -1)] * (n + 1), self.pieces.scores
        best[0] = 0.0
        at = 0
        while at < n:
            first = data[at]
            width = 1 if first < 0x80 or first == 0xFF else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            here, single = best[at], False
            if here > -1e299:
                for end, piece in self.trie.matches(data, at):
                    single = single or end == at + width
                    total = here + scores[piece]
                    if total > best[end]:
                        best[end], back[end] = total, (at, piece)
                if not single and here + self.unknown > best[at + width]:
                    best[at + width], back[at + width] = here + self.unknown, (at, -1)
            at += width
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            else:
                own = data[start:at] if data[start] != 0xFF else _MARK_BYTES
                ids += [self.pieces.byte_ids[b] for b in reversed(own)]
            at = start
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.uint32)
        text = " " + text
        if not self.split:
            stretches = [text]
        elif "  " in text or "\x00" in text:
            stretches = _RUNS.findall(text)
        else:
            parts = text.replace(" ", "\x00 ")
            stretches = (parts.replace("\n", "\x00\n\x00") if self.lines else parts).split("\x00")
        known = self.known
        try:
            found = b"".join(map(known.__getitem__, stretches))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for s in set(stretches).difference(known):
                known[s] = np.array(self.segment(s), dtype="<u4").tobytes()
            found = b"".join(map(known.__getitem__, stretches))
        return np.frombuffer(found, dtype="<u4")

    def rest(self) -> None:
        """Between tasks: what grew large goes, as the process may wait through other stages."""
        if len(self.known) > KEPT:
            self.known = {}

    def decode(self, ids) -> str:
        return b"".join(map(self.out.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


def codec(path: str) -> Codec:
    return kept(f"spm:{path}", lambda: Codec(Pieces.load(path)))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): one row per row of ``docs``; a null text has no ids."""

    @freed
    def run(frames):
        own = codec(path)
        for frame in frames:
            for a in range(0, len(frame), 500):
                part = frame.iloc[a : a + 500]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "ids": [own.encode(t).astype(np.int32) for t in part["text"].fillna("")]})
        own.rest()

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    @freed
    def run(frames):
        own = codec(path)
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "text": [own.decode(i.tolist()) for i in frame["ids"]]})

    return encoded.mapInPandas(run, "doc_id long, text string")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_ids, n_byte_ids, ids_crc32 (little-endian 32-bit ids), and of the decoded text
    decoded_sha256 and whether it is the text again (exact).

    A null text is empty. Rows that share an id are coded one by one; other
    columns are left aside.
    """
    schema = "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, decoded_sha256 string, exact boolean"

    @freed
    def run(frames):
        own = codec(path)
        is_byte = np.zeros(len(own.out), dtype=bool)
        is_byte[own.pieces.byte_ids] = True
        for frame in frames:
            rows = []
            for text in frame["text"].fillna(""):
                ids = own.encode(text)
                back = own.decode(ids.tolist())
                rows.append((len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.tobytes()), hashlib.sha256(raw(back)).hexdigest(), back == text))
            out = pd.DataFrame(rows, columns=["n_ids", "n_byte_ids", "ids_crc32", "decoded_sha256", "exact"])
            out.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy())
            yield out
        own.rest()

    return docs.select("doc_id", "text").mapInPandas(run, schema)


def coded_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, source, n_ids, ids: what a trainer reads; one row per row of ``docs``."""

    @freed
    def run(frames):
        own = codec(path)
        for frame in frames:
            for a in range(0, len(frame), 500):
                part = frame.iloc[a : a + 500]
                ids = [own.encode(t).astype(np.int32) for t in part["text"].fillna("")]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "source": part["source"], "n_ids": [len(i) for i in ids], "ids": ids})
        own.rest()

    return docs.select("doc_id", F.col("source").cast("string").alias("source"), "text").mapInPandas(run, "doc_id long, source string, n_ids long, ids array<int>")
