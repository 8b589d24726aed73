import os

import pytest

# Tests of the folder above import this from "conftest", which is this file where both folders are collected.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows; extra columns have names that operators use inside."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        frame = spark.createDataFrame(full, DOCUMENT)
        clashing = ("size", "n", "key", "rep", "comp", "shard", "part", "row", "_text", "score")
        return frame.selectExpr("*", *(f"'x' AS {name}" for name in clashing))

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and long texts, repeated rows, an id with two texts."""
    long = " ".join(f"w{i % 977} v{i}" for i in range(30_000))
    return [
        (None, None, None), (1, None, None), (2, "", "a"), (3, " \n\t ", "a"), (4, "one", "b"), (5, "one two three", "b"),
        (6, "The cat sat on the mat " * 12, None), (6, "The cat sat on the mat " * 12, None), (7, long, "c"), (8, "Ünïcödé 漢字 😀 ▁ end", "c"),
        (9, "x" * 5000, "c"), (10, "a b c d e", "a"), (10, "another text for the same id", "a"), (None, "a row without an id", "b"),
    ]


@pytest.fixture(scope="session")
def vocabularies():
    public = pytest.importorskip("public_tokenizers")
    return {name: public.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model") if os.path.exists(public.path(name))}
