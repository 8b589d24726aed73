"""Exact top-k, hard negatives and periodic runs."""

import random
from collections import Counter

import numpy as np
import pytest

from compare import connect, differences
from tallygrid.llm import cells, entry, negatives, repetition, squares, threshold
import llm_brute as brute

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors():
    """A hot vector in several labels, ties, zero and odd vectors, nulls."""
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(420, 10)) * 0.2).astype(np.float32)
    base[100:240] = base[7]
    base[300:320] = base[300:301] * np.linspace(0.1, 3, 20, dtype=np.float32)[:, None]
    base[400] = 0
    base[350:380] = np.round(base[350:380] * 8) / 64
    rows = [(i, v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(base)]
    odd = [None] * 10, [float("nan")] * 10, [float("inf")] * 10
    rows += [(500 + 100 * i, list(v), 1) for i, v in enumerate(odd)] + [(900, None, 1), (None, [1.0] * 10, 1), (1000, [0.5] * 10, None), (1100, [0.5, 0.25], 2), (1101, [0.5, 1.0], 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS q", "'x' AS ids", "2 AS cell", "3 AS level", "4 AS score", "5 AS rank", "6 AS dim")


@pytest.mark.parametrize("cell_rows", [8192, 50])
def test_highest_against_scan(spark, vectors, monkeypatch, cell_rows):
    for name, n in (("CELL_ROWS", cell_rows), ("BLOCK_QUERIES", cell_rows // 10), ("TOGETHER", 7)):
        monkeypatch.setattr(threshold, name, n)
    got = [tuple(r) for r in threshold.highest(frame(spark, vectors), every=20).collect()]
    full = brute.whole_vectors(vectors)
    want = [(a[0], k + 1, r[1], r[0]) for a in full if a[0] % 20 == 0 for k, r in enumerate(brute.ranked(a, full)[:5])]
    assert sorted(got) == sorted(want)


def test_an_id_twice_is_listed_once(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (1, [2.0, 0.0], 1), (0, [3.0, 0.0], 1), (2, [1.0, 1.0], 1)]
    got = [tuple(r) for r in threshold.highest(frame(spark, rows)).collect()]
    assert {r[2] for r in got} == {1, 2} and all(r[0] == 0 for r in got)
    found = negatives.hard_negatives(frame(spark, rows)).collect()
    assert found == []


def test_a_uniform_cutoff_loses_no_vector():
    rng = np.random.default_rng(1)
    vectors, queries = rng.integers(-90, 90, (300, 9)), rng.integers(-90, 90, (20, 9))
    lists = threshold.Lists(vectors, np.arange(300))
    exact = queries @ vectors.T
    for share in (0, 50, 299):
        cutoff = np.sort(exact, axis=1)[:, share].astype(float)
        query, vector, score = lists.reaching(queries, cutoff, 400)
        assert sorted(zip(query, vector, score, strict=True)) == sorted((q, v, exact[q, v]) for q, v in zip(*np.nonzero(exact >= cutoff[:, None]), strict=True))
    query, _, score = lists.heads(queries, 6)
    assert all((score[query == q] <= np.sort(exact[q])[::-1][:6]).all() for q in range(20))


def test_exact_types_hold_the_products():
    rng = np.random.default_rng(4)
    for most, kind in ((100, "float32"), (1 << 20, "float64"), (1 << 28, "int64")):
        a, b = rng.integers(-most, most, (30, 8)), rng.integers(-most, most, (30, 8))
        a[0, 0] = b[0, 0] = most
        x, y = cells.exact_types(a, b)
        assert x.dtype.name == y.dtype.name == kind
        assert ((x @ y.T).astype(object) == a.astype(object) @ b.T.astype(object)).all()


@pytest.mark.parametrize("cell_rows", [8192, 40])
def test_hard_negatives_against_scan(spark, vectors, monkeypatch, cell_rows):
    for name, n in (("CELL_ROWS", cell_rows), ("BLOCK_QUERIES", cell_rows // 4), ("TOGETHER", 3), ("BUCKET", 16)):
        monkeypatch.setattr(negatives, name, n)
    got = sorted(tuple(r) for r in negatives.hard_negatives(frame(spark, vectors), every=20).collect())
    assert got == brute.hard_negatives(vectors, 20)


def test_coordinate_ranges_hold_every_answer():
    """Clustered vectors, where the lists leave a small part of a bucket."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 12))
    points = np.round((centres[rng.integers(0, 40, 3000)] + 0.05 * rng.normal(size=(3000, 12))) * 100).astype(np.int64)
    buckets, exact = negatives.Buckets(points, np.arange(3000)), points[:60] @ points.T
    sparse = []
    within = negatives.Bucket.within
    negatives.Bucket.within = lambda self, *args: (sparse.append(within(self, *args)), sparse[-1])[1]
    try:
        top = np.sort(exact, axis=1)[:, -40].astype(float)[:, None]
        anchor, _, row, score = buckets.search(points[:60], top, np.full((60, 1), np.inf), 10)
    finally:
        negatives.Bucket.within = within
    want = [(a, r, exact[a, r]) for a in range(60) for r in np.lexsort((np.arange(3000), -exact[a]))[:10]]
    assert sorted(zip(anchor, row, score, strict=True)) == sorted(want)
    assert sparse and sum(map(len, sparse)) < 0.2 * negatives.BUCKET * len(sparse)


@pytest.mark.parametrize("name", ["op11_threshold_top", "op12_hard_negatives"])
def test_searches_against_sql(spark, small, name):
    assert differences(entry.QUERIES[name](spark, small), connect(small), entry.SQL[name]) == {}


# periodic runs


def _parts(rng):
    parts = []
    for _ in range(rng.randint(0, 4)):
        own = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6 and own:
            a = rng.randrange(len(own))
            p = rng.randint(1, max(1, (len(own) - a) // 3))
            own = [w if i < a else own[a + (i - a) % p] for i, w in enumerate(own)] + [rng.choice("abc") for _ in range(rng.randint(0, 9))]
        parts.append(own)
    return parts


def test_runs_against_plain_search():
    rng = random.Random(5)
    for _ in range(300):
        parts = _parts(rng)
        for least, times in ((6, 4), (2, 2)):
            part, runs = squares.runs_of(parts, least, times)
            assert [(p, *r) for p, r in zip(part.tolist(), runs.tolist(), strict=True)] == [(i, *r) for i, own in enumerate(parts) for r in brute.runs(own, least, times)]


def test_words_one_by_one_give_the_same_squares():
    rng = random.Random(6)
    for _ in range(60):
        words, _ = squares.joined(_parts(rng))
        whole, online, at = squares.Squares(), squares.Squares(), 0
        whole.append(words)
        while at < len(words):
            step = rng.choice([1, 1, 1, 2, 7])
            online.append(words[at : at + step])
            at += step
        assert (online.runs(2, 2) == whole.runs(2, 2)).all()


def test_equal_fingerprints_are_noticed(monkeypatch):
    monkeypatch.setattr(squares, "PRIMES", ((3, 2), (3, 2)))
    found = squares.Squares()
    found.append(np.arange(40))
    with pytest.raises(squares.Collision):
        found.runs(6, 4)


def test_long_periodic_texts_take_little_work():
    for own in (["a"] * 30_000, (["a"] * 1000 + ["b"]) * 20, [str(i % 7000) for i in range(40_000)]):
        part, runs = squares.runs_of([own], 6, 4)
        assert [0, len(own)] in runs[:, :2].tolist()


def test_run_rows(docs_of, awkward):
    rng = random.Random(8)
    rows = [r for r in awkward if r[0] != 7] + [(100 + i, " ".join(rng.choice("ab") + rng.choice("cd") for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(7, "x y " * 3000), (20, "a " * 50 + "b " * 50)]
    got = Counter(tuple(r) for r in repetition.run_digests(repetition.with_runs(docs_of(rows), repetition.repeated_tail)).collect() if r.doc_id is not None)
    assert got == Counter(brute.run_row(r[0], r[1]) for r in rows if r[0] is not None)
    without_id = [r for r in repetition.with_runs(docs_of([(None, "a b " * 20)]), repetition.repeated_tail).collect()]
    assert [(r.doc_id, r.kept, [tuple(x) for x in r.runs]) for r in without_id] == [(None, "a b", [(0, 40, 2)])]


def test_runs_on_the_table(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in entry.QUERIES["op13_periodic_runs"](spark, small).collect()}
    few = [i for i in sorted(texts) if len(texts[i] or "") < 20_000]
    assert len(got) == len(texts) and {i: got[i] for i in few} == {i: brute.run_row(i, texts[i]) for i in few}
    assert sum(r[1] > 0 for r in got.values()) > 5
