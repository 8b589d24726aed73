"""Exact top-k by inner product with a three-phase uniform threshold.

The coordinates are cut into slices; a vector's score is the sum of its partial
scores, one from each slice's list. Vectors are dealt over cells by hash, so all
lists of a vector lie in one task and only queries, cutoffs and results travel.

1. Each cell gathers, for every query, the head of each slice's list and adds up
   the scores of those vectors. The k-th best of all cells is a cutoff that k
   vectors reach for sure.
2. The cutoff goes back to all cells with the query. A vector that reaches it
   has a partial score of at least cutoff / slices in some list, so each cell
   collects the entries of its lists down to there.
3. The remaining partial scores of those vectors are looked up, and the vectors
   whose exact sums reach the cutoff are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.cells import BLOCK_QUERIES, CELL_ROWS, best_ids, best_rows, classes, exact_types, finite, matrix, name_of, visited, whole
from tallygrid.llm.common import written

#: Fixed by the task: every EVERY-th id is a query, with MOST answers.
EVERY, MOST = 50, 5
#: Lists of a vector (with few the cutoff of a list is high), and queries whose lists are made together.
SLICES, TOGETHER = 2, 128


class Lists:
    """The score lists of one cell."""

    def __init__(self, vectors: np.ndarray, firsts: np.ndarray) -> None:
        self.vectors, self.firsts = vectors, firsts
        self.cuts = np.linspace(0, vectors.shape[1], SLICES + 1).astype(int)

    def partial(self, queries: np.ndarray) -> np.ndarray:
        """Per slice, query and vector the partial score; exact."""
        queries, vectors = exact_types(queries, self.vectors)
        return np.stack([queries[:, a:b] @ vectors[:, a:b].T for a, b in zip(self.cuts, self.cuts[1:], strict=False)])

    def heads(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phase 1: (query, vector, score) of the best among the vectors that lead a list."""
        lists = self.partial(queries)
        n, most = lists.shape[2], min(most, lists.shape[2])
        seen = np.concatenate([np.argpartition(own, n - most, axis=1)[:, n - most :] for own in lists], axis=1)
        seen.sort(axis=1)
        fresh = np.diff(seen, axis=1, prepend=-1) != 0
        query, vector = np.nonzero(fresh)[0], seen[fresh]
        score = lists[:, query, vector].sum(axis=0)
        best = best_rows(query, score, self.firsts[vector], most)
        return query[best], vector[best], score[best]

    def reaching(self, queries: np.ndarray, cutoff: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phases 2 and 3: the best of the vectors whose score reaches the query's cutoff."""
        lists = self.partial(queries)
        uniform = np.floor(cutoff / SLICES)  # rounded down, so no vector is lost
        query, vector = np.nonzero((lists >= uniform[:, None]).any(axis=0))
        score = lists[:, query, vector].sum(axis=0)
        enough = score >= cutoff[query]
        query, vector, score = query[enough], vector[enough], score[enough]
        best = best_rows(query, score, self.firsts[vector], most)
        return query[best], vector[best], score[best]


def _searched(points: DataFrame, asked: DataFrame, most: int) -> DataFrame:
    """(q, score, ids) from all cells: heads where ``asked`` has no cutoff column, else what reaches it."""
    final = "cutoff" in asked.columns
    counts = points.groupBy("dim").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("cells"))
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
    grid = counts.join(blocks, "dim")  # one row for each length of vectors
    total = grid.agg(F.sum(F.col("cells") * F.col("blocks"))).first()[0] or 1
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = points.join(grid, "dim").select("dim", F.pmod(F.xxhash64("ints", F.lit(5)), "cells").cast("int").alias("cell"), numbers("blocks").alias("block"), "ints", "ids")
    held = ["q", "asked", *(["cutoff"] if final else [])]
    visits = asked.join(grid, "dim").select("dim", numbers("cells").alias("cell"), F.pmod(F.xxhash64("q"), "blocks").cast("int").alias("block"), *held)

    def build(rows: pd.DataFrame):
        ids = rows["ids"].to_numpy()
        lists = Lists(matrix(rows["ints"]), np.array([i[0] for i in ids], dtype=np.int64))

        def ask(visits: pd.DataFrame) -> pd.DataFrame:
            parts = []
            for a in range(0, len(visits), TOGETHER):
                part = visits.iloc[a : a + TOGETHER]
                queries = matrix(part["asked"])
                if final:
                    cutoff = part["cutoff"].fillna(-np.inf).to_numpy(dtype=np.float64)
                    query, vector, score = lists.reaching(queries, np.where(np.abs(cutoff) < 1 << 53, cutoff, np.nextafter(cutoff, -np.inf)), most)
                else:
                    query, vector, score = lists.heads(queries, most)
                parts.append(pd.DataFrame({"q": part["q"].to_numpy()[query], "score": score.astype(np.int64), "ids": ids[vector]}))
            return pd.concat(parts)

        return ask

    return visited(members, visits, ["dim", "cell", "block"], int(total), build, "q string, score long, ids array<long>")


def highest(rows: DataFrame, every: int = EVERY, most: int = MOST) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by ``every`` the ``most`` other ids of highest integer inner product.

    Rows whose id is null, or whose vector is null or holds a null or non-finite
    component, take no part; zero vectors do. Equal vectors are one point with
    several ids. An id that occurs twice is listed once, with its highest
    score, and never for itself. Vectors of different lengths are never
    compared. Other columns are left aside.
    """
    usable = rows.where(F.col("vec_id").isNotNull() & finite()).select("vec_id", whole().alias("ints"))
    points = written(classes(usable, [], most + 1).withColumn("dim", F.size("ints")))
    named = usable.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), name_of("ints").alias("q"), "ints")
    queries = written(named.select("query_id", "q").distinct())
    asked = written(named.groupBy("q").agg(F.first("ints").alias("asked")).withColumn("dim", F.size("asked")))
    gathered = best_ids(_searched(points, asked, most + 1), ["q"], most + 1)
    # The query itself may be listed: so with one more than are asked for, enough others reach the last score.
    cutoffs = gathered.select("q", F.when(F.size("list") > most, F.element_at("list", -1)["score"]).alias("cutoff"))
    answered = best_ids(_searched(points, written(asked.join(cutoffs, "q", "left")), most + 1), ["q"], most + 1)
    others = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, most)
    out = queries.join(answered, "q").select("query_id", F.posexplode(others).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
