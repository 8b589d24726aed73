"""Runs of repeated words in each text, found online by dyadic square catching, and the texts without the repeats.

Documents stand alone, so this is one pass without a shuffle; a task numbers the
words of some documents at a time and appends them to one catcher (:mod:`squares`).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import WORD, body
from tallygrid.llm.squares import runs_of

#: Fixed by the task: a run has so many words and periods at least.
LEAST, TIMES = 6, 4
#: Characters of the documents that are looked at together.
TOGETHER = 1 << 20

Change = Callable[[str | None, list[str]], list[str]]


def repeated_tail(doc_id: str | None, words: list[str]) -> list[str]:
    """The task's change: in a tenth of the documents, told by the id, the words from some place on repeat with some period.

    Documents without an id stay as they are.
    """
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def kept_words(words: list[str], runs: np.ndarray) -> list[str]:
    """The words outside of all runs and in the first period of each, unless another run drops them."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def with_runs(docs: DataFrame, change: Change | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs, kept.

    ``runs`` are structs of start (number of the word, from 0), length and
    period in words, by start and period: maximal stretches of at least
    ``least`` words and ``times`` smallest periods. ``kept`` has the words that
    no run holds behind its first period, joined by a space. ``change`` may
    alter the words of a document first, by its id as text.

    A null text counts as empty: no runs, an empty text. Rows that share an id
    stay apart, and a null id stays null; other columns are left aside.
    """
    split = re.compile(WORD).findall

    def found(ids: list, texts: list) -> pd.DataFrame:
        parts = [split(t) for t in texts]
        if change:
            parts = [change(i, words) for i, words in zip(ids, parts, strict=True)]
        part, runs = runs_of(parts, least, times)
        cuts = np.searchsorted(part, np.arange(len(parts) + 1))
        own = [runs[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        columns = {name: [r[:, i] for r in own] for i, name in enumerate(("start", "length", "period"))}
        return pd.DataFrame({"id": ids, **columns, "kept": [" ".join(kept_words(w, r)) for w, r in zip(parts, own, strict=True)]})

    def run(frames):
        for frame in frames:
            ids, texts = frame["id"].tolist(), frame["text"].tolist()
            first = size = 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= TOGETHER or i == len(texts) - 1:
                    yield found(ids[first : i + 1], texts[first : i + 1])
                    first, size = i + 1, 0

    told = docs.select(F.col("doc_id").cast("string").alias("id"), body().alias("text"))  # ids as text: a null would make them floats
    rows = told.mapInPandas(run, "id string, start array<long>, length array<long>, period array<long>, kept string")
    return rows.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.arrays_zip("start", "length", "period").alias("runs"), "kept")


def run_digests(found: DataFrame) -> DataFrame:
    """The query's columns from ``with_runs``: how many runs, the longest, and digests of all runs and of the text that stays."""
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = found.withColumn("_best", longest)
    start, length, period = -F.col("_best.start"), F.col("_best.length"), -F.col("_best.period")
    return told.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor((length * 1000 - F.pmod(length * 1000, period)) / period).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
