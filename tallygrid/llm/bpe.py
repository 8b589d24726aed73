"""Whole texts to ids of a tokenizers file, remembering what each stretch between spaces becomes."""

from __future__ import annotations

import os
import re
import string
import sys
from collections.abc import Callable

import numpy as np

#: Remembered stretches of a worker process; beyond that it forgets all and starts again.
REMEMBERED = 1_000_000

_PAIRED_SPACE = re.compile(r"\s\s|\s\Z")

#: Characters that behind letters start a part of their own and go together there; an apostrophe may go with letters.
_MARKS = "".join(c for c in string.punctuation if c != "'")


def kept(name: str, make: Callable):
    """An object that outlives the task: functions travel by value, so their module's globals don't."""
    place = vars(sys.modules["pyspark"]).setdefault("_llm_kept", {})
    if name not in place:
        place[name] = make()
    return place[name]


def byte_characters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes with: printable Latin-1 as it is, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class Stretches(dict):
    """Each stretch's ids as little-endian 16-bit bytes, found out when first asked for."""

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.tokenizer, self.model, self.written = tokenizer, tokenizer.model, byte_characters()
        self.space, self.pairs = self.written[32], [i.to_bytes(2, "little") for i in range(1 << 16)]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def __missing__(self, stretch: str) -> bytes:
        word = stretch.rstrip(_MARKS)
        spaced = word[:1] == " "
        if not (word[1:] if spaced else word).isalpha():
            ids = self.whole(stretch)
        elif len(word) < len(stretch):
            ids = self[word] + self[stretch[len(word) :]]
        else:  # one token of the first split, as letters go together
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(self.written)
            elif spaced:
                word = self.space + word[1:]
            pairs = self.pairs
            ids = b"".join([pairs[t.id] for t in self.model.tokenize(word)])
        self[stretch] = ids
        return ids


class Encoder:
    """Ids as little-endian 16-bit bytes.

    This vocabulary first splits a text by character classes. A single space or
    line end between two other characters always starts a new part there, and
    after a line end too. So a text is the concatenation of its stretches, a
    space going with what follows it. Texts with two white spaces in a row or
    one at the end are encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        if tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids don't fit 16 bits")
        self.known = Stretches(tokenizer)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        get, out = self.known.__getitem__, []
        for t in texts:
            if "\x00" in t or _PAIRED_SPACE.search(t):
                out.append(self.known.whole(t))
            else:
                out.append(b"".join(map(get, t.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00"))))
        return out


def batches(texts: list[str], size: int = 1 << 20):
    """Runs of texts of about ``size`` characters."""
    at = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
