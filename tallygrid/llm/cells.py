"""What exact vector searches share: whole-number vectors, equal ones once, and cells of vectors that queries visit in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors of a cell and queries of a block (about). A cell is one task's work at a time, whatever the input.
CELL_ROWS, BLOCK_QUERIES = 8192, 8192
#: Tasks at most; with more cells a task has several, one after the other.
TASKS = 20_000

#: From a cell's members to what answers blocks of its visits.
Build = Callable[[pd.DataFrame], Callable[[pd.DataFrame], pd.DataFrame]]


def finite(vector: str = "embedding") -> Column:
    """Whether a vector and all its components are there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & fine


def whole(vector: str = "embedding") -> Column:
    """Fixed by the task: floor(256 * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256))


def name_of(*columns: str) -> Column:
    """A text that tells rows with different values apart; arrays become texts."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def classes(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Equal rows in ``ints`` and ``keys`` once, with their ``most`` least ids, sorted: more of them never show in one answer.

    The rank limits what each task passes on, so a vector that a third of all
    rows share costs no more than others.
    """
    same = ["_hash", *keys, "ints"]
    hashed = rows.select(F.xxhash64("ints").alias("_hash"), *keys, "ints", "vec_id")
    ranked = hashed.withColumn("_rank", F.dense_rank().over(Window.partitionBy(*same).orderBy("vec_id"))).where(F.col("_rank") <= most)
    return ranked.groupBy(*same).agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).drop("_hash")


def best_ids(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """From (keys, score, ids) the ``most`` ids of highest score per key, as ``list`` of (score, vec_id); ties go to smaller ids.

    An id counts once, with its highest score.
    """
    each = found.select(*keys, "score", F.explode("ids").alias("vec_id")).groupBy(*keys, "vec_id").agg(F.max("score").alias("score"))
    ranked = each.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")))
    entry = F.struct((-F.col("score")).alias("_down"), "vec_id", "score")
    listed = ranked.where(F.col("_rank") <= most).groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("list"))
    return listed.withColumn("list", F.transform("list", lambda x: F.struct(x["score"], x["vec_id"])))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), -1)


def exact_types(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the fastest type whose inner products, partial sums too, are exact."""
    size = lambda x: float(np.abs(x.astype(np.float64)).max()) if x.size else 0.0
    bound = size(a) * size(b) * max(a.shape[1], 1)
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return a.astype(kind), b.astype(kind)


def best_rows(group: np.ndarray, score: np.ndarray, first: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores of each group, in order; ties go to the smaller ``first``."""
    order = np.lexsort((first, -score, group))
    own = group[order]
    heads = np.flatnonzero(np.diff(own, prepend=-1))
    rank = np.arange(len(own)) - np.repeat(heads, np.diff(np.append(heads, len(own))))
    return order[rank < most]


def visited(members: DataFrame, visits: DataFrame, keys: list[str], cells: int, build: Build, schema: str) -> DataFrame:
    """What ``build`` answers for the visits of each cell.

    Rows with the same ``keys`` meet in one task: first the members, then the
    visits in batches. Only one cell's members are held at a time.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, held, ask = None, [], None
        for frame in frames:
            names = list(zip(*(frame[k] for k in [*keys, "_visit"]), strict=True))
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                rows, (*cell, visit) = frame.iloc[a:b], names[a]
                if cell != name:
                    name, held, ask = cell, [], None
                if not visit:
                    held.append(rows)
                elif held or ask:
                    if ask is None:
                        ask, held = build(pd.concat(held)), []
                    yield ask(rows)

    both = members.withColumn("_visit", F.lit(False)).unionByName(visits.withColumn("_visit", F.lit(True)), allowMissingColumns=True)
    dealt = both.repartition(max(1, min(cells, TASKS)), *keys).sortWithinPartitions(*keys, "_visit")
    return dealt.mapInPandas(run, schema)
