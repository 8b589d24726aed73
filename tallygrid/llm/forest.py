"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree hashes every vector to a long string of bits, the signs of random
projections, and keeps the strings in a sorted array. A query descends every
tree to the longest prefixes that it shares with any vector; then all trees
ascend together, a bit at a time, until the vectors that share so long a prefix
are enough. Those are measured exactly.

The vectors are dealt over shards by hash, each with a forest of its own; the
queries, in batches, visit all shards, and a query's best of each are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.llm.common import written

#: Fixed by the task: every EVERY-th id is a query, with NEAREST neighbours.
EVERY, NEAREST = 100, 10
#: Trees of a shard, bits of a string, vectors of a shard (about), and vectors that are measured for a query in each (at least).
TREES, BITS, SHARD_ROWS, MEASURED = 192, 32, 1 << 15, 8192
#: Prefixes longer than this are not told apart: so many bits seldom part more than a few vectors of a shard.
DEEPEST = 20


def usable(vector: str = "embedding") -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def classes(rows: DataFrame) -> DataFrame:
    """(cls, dim, embedding, ids): equal vectors once, with their NEAREST + 1 least ids: no answer can hold more of them."""
    most = NEAREST + 1

    def run(frames):
        for frame in frames:
            found: dict[bytes, list] = {}
            for vec_id, vector in zip(frame["vec_id"], frame["embedding"], strict=True):
                found.setdefault(np.asarray(vector, dtype=np.float32).tobytes(), []).append(vec_id)
            yield pd.DataFrame(
                {"embedding": [np.frombuffer(k, dtype=np.float32) for k in found], "ids": [sorted(set(v))[:most] for v in found.values()]}
            )

    held = rows.select("vec_id", "embedding").mapInPandas(run, "embedding array<float>, ids array<long>")
    summed = held.groupBy("embedding").agg(F.flatten(F.collect_list("ids")).alias("ids"))  # a few ids from each batch
    ids = F.slice(F.array_sort(F.array_distinct("ids")), 1, most)
    return summed.select(F.xxhash64("embedding").alias("cls"), F.size("embedding").alias("dim"), "embedding", ids.alias("ids"))


class Forest:
    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        rng = np.random.default_rng(vectors.shape[1])
        self.mean = vectors.mean(axis=0)
        self.planes = rng.normal(size=(vectors.shape[1], TREES * BITS)).astype(np.float32)
        own = self.strings(vectors)
        self.order = np.argsort(own, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(own, self.order, axis=1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """Per tree and vector the string, as an unsigned number."""
        out = np.empty((TREES, len(vectors)), dtype=np.uint32)
        for a in range(0, len(vectors), 1000):
            signs = (vectors[a : a + 1000] - self.mean).astype(np.float32) @ self.planes > 0
            packed = np.packbits(signs.reshape(-1, TREES, BITS), axis=2)
            out[:, a : a + 1000] = packed.reshape(-1, TREES, BITS // 8).copy().view(">u4")[:, :, 0].T
        return out

    def candidates(self, queries: np.ndarray, least: int) -> list[np.ndarray]:
        """Per query the vectors that share a prefix with it in any tree, at the longest length at which they (counted by tree) reach ``least``."""
        own = self.strings(queries)
        low = np.zeros((TREES, len(queries)), dtype=np.int64)
        high = np.full((TREES, len(queries)), self.sorted.shape[1], dtype=np.int64)
        open_ = np.arange(len(queries))
        for length in range(DEEPEST, 0, -1):
            rest = np.uint32((1 << (BITS - length)) - 1)
            for tree in range(TREES):
                q = own[tree, open_]
                low[tree, open_] = np.searchsorted(self.sorted[tree], q & ~rest, "left")
                high[tree, open_] = np.searchsorted(self.sorted[tree], q | rest, "right")
            open_ = open_[(high - low)[:, open_].sum(axis=0) < least]
            if not len(open_):
                break
        low[:, open_], high[:, open_] = 0, self.sorted.shape[1]  # not even one bit suffices: all
        found = []
        for i in range(len(queries)):
            near = np.zeros(len(self.vectors), dtype=bool)
            for tree in range(TREES):
                near[self.order[tree, low[tree, i] : high[tree, i]]] = True
            found.append(np.flatnonzero(near))
        return found

    def nearest(self, queries: np.ndarray, firsts: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the nearest candidates and their distances; of equal ones those with the least ``firsts``."""
        out = []
        for query, near in zip(queries, self.candidates(queries, MEASURED), strict=True):
            score = np.sqrt(((self.vectors[near].astype(np.float64) - query.astype(np.float64)) ** 2).sum(axis=1))
            best = np.lexsort((firsts[near], score))[:most]
            out.append((near[best], score[best]))
        return out


def searched(points: DataFrame, asked: DataFrame) -> DataFrame:
    """(q, ids, score): for each asked class the nearest classes of every shard.

    ``points``: cls, dim, embedding, ids; ``asked``: those that are queries. A
    shard's vectors come first in its task, then the queries in batches.
    """
    shards = points.groupBy("dim").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"))  # a row for each length
    own = F.pmod(F.xxhash64("cls", F.lit(9)), F.col("shards")).cast("int")
    members = points.join(shards, "dim").select("dim", own.alias("shard"), F.lit(False).alias("query"), "cls", "embedding", "ids")
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    visits = asked.join(shards, "dim").select("dim", every.alias("shard"), F.lit(True).alias("query"), "cls", "embedding", "ids")
    columns = ["q", "ids", "score"]

    def run(frames):
        name = forest = None
        held: list[pd.DataFrame] = []
        for frame in frames:
            keys = list(zip(frame["dim"], frame["shard"], frame["query"], strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                rows, (dim, shard, query) = frame.iloc[a:b], keys[a]
                if (dim, shard) != name:
                    name, forest, held = (dim, shard), None, []
                if not query:
                    held.append(rows)
                    continue
                if forest is None and held:
                    whole = pd.concat(held)
                    forest = Forest(np.array(whole["embedding"].tolist(), dtype=np.float32))
                    ids = whole["ids"].to_numpy()
                    firsts = np.array([i[0] for i in ids], dtype=np.int64)
                if forest is None:
                    continue
                for c in range(0, len(rows), 500):
                    part = rows.iloc[c : c + 500]
                    found = forest.nearest(np.array(part["embedding"].tolist(), dtype=np.float32), firsts, NEAREST + 1)
                    out = [(q, ids[i], s) for q, (near, scores) in zip(part["cls"], found, strict=True) for i, s in zip(near, scores, strict=True)]
                    yield pd.DataFrame(out, columns=columns)

    both = members.unionByName(visits).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "query")
    return both.mapInPandas(run, "q long, ids array<long>, score double")


def nearest(rows: DataFrame) -> DataFrame:
    """The query: query_id, rank, vec_id, score; see the module.

    Rows whose id is null, or whose vector is null, empty, zero or holds a null
    or non-finite component, take no part. Equal vectors are one point with
    several ids. An id that occurs twice is listed once, and never for itself.
    Vectors of different lengths are never compared. Other columns are left
    aside.
    """
    rows = rows.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable())
    points = written(classes(rows))
    queries = written(rows.where(F.col("vec_id") % EVERY == 0).select(F.col("vec_id").alias("query_id"), F.xxhash64("embedding").alias("q")).distinct())
    asked = points.join(queries.select(F.col("q").alias("cls")).distinct(), "cls", "left_semi")
    measured = searched(points, asked).select("q", "score", F.explode("ids").alias("vec_id"))
    nearest_first = Window.partitionBy("q").orderBy("score", "vec_id")
    listed = measured.withColumn("_rank", F.row_number().over(nearest_first)).where(F.col("_rank") <= NEAREST + 1)
    listed = listed.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("list"))  # NEAREST + 1 of each
    others = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, NEAREST)
    out = queries.join(listed, "q").select("query_id", F.posexplode(others).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
