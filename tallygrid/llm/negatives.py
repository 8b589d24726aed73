"""Hard negatives by pruning along lengths and coordinates.

The rows of a cell lie in length buckets, longest first, and each bucket has a
sorted list of every coordinate of its unit vectors. An anchor with a score to
reach needs a certain cosine in a bucket, whatever the bucket's length allows;
where that is over 1, neither this bucket nor a shorter one has an answer. Else
the cosine bounds what each coordinate of an answer may be, by the anchor's own
coordinate. The lists of the anchor's largest coordinates give the rows in those
ranges; rows in all of them are verified by their exact inner product. Where the
ranges leave most of a bucket, it is verified as a whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.cells import BLOCK_QUERIES, CELL_ROWS, best_ids, best_rows, classes, exact_types, finite, matrix, name_of, visited, whole
from tallygrid.llm.common import written

#: Fixed by the task: every EVERY-th id is an anchor, with MOST positives and, for each, MOST negatives.
EVERY, MOST = 100, 5
#: Rows of a length bucket, coordinates an anchor looks at, and anchors that pass through the buckets together.
BUCKET, FOCUS, TOGETHER = 512, 6, 256
#: Ranges that leave more than this share of a bucket don't pay.
DENSE = 0.2
#: What rounding may do to a unit vector's coordinate.
SLACK = 1e-9


class Bucket:
    """Rows of similar length with the sorted lists of their coordinates."""

    def __init__(self, vectors: np.ndarray, lengths: np.ndarray) -> None:
        self.vectors, self.longest = vectors, float(lengths.max())
        unit = vectors / np.maximum(lengths, 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        lists = np.take_along_axis(unit, self.order, axis=0)
        self.lists = (lists + 4.0 * np.arange(unit.shape[1])).T.ravel()  # list after list, each in a stretch of its own

    def ranges(self, unit: np.ndarray, focus: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per anchor and focus coordinate the places in its list that can hold an answer of at least that cosine."""
        angle = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1, 1))
        around = np.arccos(np.clip(cosine - SLACK, -1, 1))[:, None]
        least, most = np.cos(np.minimum(np.pi, angle + around)) - SLACK, np.cos(np.maximum(0, angle - around)) + SLACK
        base = focus * len(self.vectors)
        return np.searchsorted(self.lists, 4.0 * focus + least, "left") - base, np.searchsorted(self.lists, 4.0 * focus + most, "right") - base

    def within(self, focus: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows that lie in the ranges of all focus coordinates of one anchor, the narrowest first."""
        times = np.zeros(len(self.vectors), dtype=np.int32)
        for f, a, b in zip(focus, low, high, strict=True):
            times[self.order[a:b, f]] += 1
        return np.flatnonzero(times == len(focus))


class Buckets:
    """The rows of one cell."""

    def __init__(self, vectors: np.ndarray, firsts: np.ndarray) -> None:
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.order = np.argsort(-lengths, kind="stable")
        self.firsts, self.all = firsts, vectors
        cuts = [self.order[a : a + BUCKET] for a in range(0, len(vectors), BUCKET)]
        self.parts = [(rows, Bucket(vectors[rows], lengths[rows])) for rows in cuts]

    def search(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
        """(anchor, band, row, score): per anchor and band of scores, low to high, the ``most`` highest in it; ties go to smaller ids.

        ``low`` and ``high`` have a column per band; a band that an anchor
        lacks has an infinite ``low``. What a band has found raises the score
        to reach in the next buckets.
        """
        bands = low.shape[1]
        exact, _ = exact_types(anchors, self.all)
        length = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1))
        unit = anchors / np.maximum(length, 1e-300)[:, None]
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        reach = low.copy()
        group = row = np.zeros(0, dtype=np.int64)
        score = np.zeros(0, dtype=exact.dtype)
        for rows, bucket in self.parts:
            least = reach.min(axis=1)
            allowed = length * bucket.longest * (1 + SLACK)
            open_ = np.flatnonzero(least <= allowed)
            if not len(open_):
                break
            query, found, value = self._verified(bucket, open_, exact, unit, focus, least, allowed)
            if not len(query):
                continue
            fits = (value[:, None] >= reach[query]) & (value[:, None] <= high[query])
            entry, band = np.nonzero(fits)
            group = np.concatenate([group, query[entry] * bands + band])
            row = np.concatenate([row, rows[found[entry]]])
            score = np.concatenate([score, value[entry]])
            kept = best_rows(group, score, self.firsts[row], most)
            group, row, score = group[kept], row[kept], score[kept]
            full = np.flatnonzero(np.bincount(group, minlength=low.size) >= most)
            lasts = np.searchsorted(group, full, "right") - 1
            reach.ravel()[full] = np.maximum(reach.ravel()[full], score[lasts])
        return group // bands, group % bands, row, score

    def _verified(self, bucket: Bucket, open_: np.ndarray, exact: np.ndarray, unit: np.ndarray, focus: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
        """(anchor, row of the bucket, score) of the candidates that reach ``least``."""
        vectors = bucket.vectors.astype(exact.dtype)
        bounded = open_[(least[open_] > 0) & (allowed[open_] > 0)]
        whole_ = np.setdiff1d(open_, bounded)
        parts = []
        if len(bounded):
            low, high = bucket.ranges(unit[bounded], focus[bounded], least[bounded] / allowed[bounded])
            share = np.prod((high - low) / len(vectors), axis=1)
            whole_ = np.concatenate([whole_, bounded[share > DENSE]])
            for at in np.flatnonzero((share > 0) & (share <= DENSE)):
                anchor = bounded[at]
                rows = bucket.within(focus[anchor], low[at], high[at])
                parts.append((np.full(len(rows), anchor), rows, vectors[rows] @ exact[anchor]))
        if len(whole_):
            scores = exact[whole_] @ vectors.T
            query, rows = np.nonzero(scores >= least[whole_][:, None])
            parts.append((whole_[query], rows, scores[query, rows]))
        if not parts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=exact.dtype)
        query, rows, value = (np.concatenate(x) for x in zip(*parts, strict=True))
        enough = value >= least[query]
        return query[enough], rows[enough], value[enough]


def _cells(points: DataFrame) -> DataFrame:
    """Per length of vectors, label and length bucket: how many cells, and the largest squared length. A few hundred rows a label at most."""
    return points.groupBy("dim", "label", "level").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("cells"), F.max("squared").alias("longest"))


def _searched(points: DataFrame, sizes: DataFrame, asked: DataFrame, visits_to: Column, most: int) -> DataFrame:
    """(q, band, score, ids) from the cells that each anchor visits; ``asked``: q, dim, own, asked, low, high."""
    keys = ["dim", "label", "level", "cell", "block"]
    blocks = int(asked.agg(F.ceil(F.count("*") / BLOCK_QUERIES)).first()[0] or 1)
    total = sizes.agg(F.sum("cells")).first()[0] or 1
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    cell = F.pmod(F.xxhash64("ints", F.lit(5)), "cells").cast("int").alias("cell")
    members = points.join(sizes.drop("longest"), ["dim", "label", "level"]).select("dim", "label", "level", cell, numbers(F.lit(blocks)).alias("block"), "ints", "ids")
    places = sizes.withColumnRenamed("dim", "_dim")
    visits = asked.join(places, (F.col("dim") == F.col("_dim")) & visits_to).select(
        "dim", "label", "level", numbers(F.col("cells")).alias("cell"), F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("block"), "q", "asked", "low", "high"
    )

    def build(rows: pd.DataFrame):
        ids = rows["ids"].to_numpy()
        buckets = Buckets(matrix(rows["ints"]), np.array([i[0] for i in ids], dtype=np.int64))

        def ask(visits: pd.DataFrame) -> pd.DataFrame:
            parts = []
            for a in range(0, len(visits), TOGETHER):
                part = visits.iloc[a : a + TOGETHER]
                low, high = (np.array(part[c].tolist(), dtype=np.float64) for c in ("low", "high"))
                query, band, row, score = buckets.search(matrix(part["asked"]), low, high, most)
                parts.append(pd.DataFrame({"q": part["q"].to_numpy()[query], "band": band.astype(np.int32), "score": score.astype(np.int64), "ids": ids[row]}))
            return pd.concat(parts)

        return ask

    return visited(members, visits, keys, int(total) * blocks, build, "q string, band int, score long, ids array<long>")


def moved_label(label: Column, vec_id: Column) -> Column:
    """Fixed by the task: where the id is divisible by 7 the label is the next of ten."""
    return F.when(vec_id % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)


def hard_negatives(rows: DataFrame, every: int = EVERY, most: int = MOST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id, embedding, label. For each anchor (an id divisible by
    ``every``) its ``most`` positives, the other ids of its label with the
    highest scores, and for each of those the ``most`` rows of other labels with
    the highest scores between 80 % and 100 % of the positive's.

    Rows whose id or label is null, or whose vector is null or holds a null or
    non-finite component, take no part. Equal vectors of a label are one point
    with several ids. An id that occurs twice is listed once in each list, with
    its highest score, and is never its own positive. An anchor without another
    row of its label, and a positive without a row in its band, give no rows.
    Vectors of different lengths are never compared. Other columns are left
    aside.
    """
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite()).select("vec_id", F.col("label").cast("long").alias("label"), whole().alias("ints"))
    squared = F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    level = F.floor(F.log2(squared + 1) * 8).cast("int")
    points = written(classes(usable, ["label"], most + 1).withColumns({"dim": F.size("ints"), "squared": squared}).withColumn("level", level))
    sizes = written(_cells(points))
    named = usable.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("anchor_id"), name_of("label", "ints").alias("q"), "label", "ints")
    anchors = written(named.select("anchor_id", "q").distinct())
    asked = written(named.groupBy("q").agg(F.first("label").alias("own"), F.first("ints").alias("asked")).withColumns({"dim": F.size("asked"), "squared": F.aggregate("asked", F.lit(0.0), lambda s, x: s + x.cast("double") * x)}))

    everything = asked.withColumns({"low": F.array(F.lit(float("-inf"))), "high": F.array(F.lit(float("inf")))})
    alike = written(best_ids(_searched(points, sizes, everything, F.col("label") == F.col("own"), most + 1), ["q"], most + 1))
    others = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("anchor_id")), 1, most)
    pairs = anchors.join(alike, "q").select("anchor_id", "q", F.explode(others).alias("hit"))
    pairs = pairs.select("anchor_id", "q", F.col("hit.vec_id").alias("positive_id"), F.col("hit.score").alias("positive_score"))

    # Bands of an anchor: one for each score of a positive; a negative score's band is empty.
    tops = F.array_sort(F.array_distinct(F.transform(F.filter("list", lambda x: x["score"] >= 0), lambda x: x["score"])))
    bound = alike.select("q", tops.alias("tops")).where(F.size("tops") > 0)
    padded = lambda x, fill: F.concat(x, F.array_repeat(F.lit(fill), F.lit(most + 1) - F.size("tops")))
    floor = F.transform("tops", lambda s: F.ceil((s * 4).cast("decimal(25,0)") / 5).cast("double"))
    banded = written(asked.join(bound, "q").withColumns({"low": padded(floor, float("inf")), "high": padded(F.transform("tops", lambda s: s.cast("double")), float("-inf"))}))
    may_reach = F.col("squared") * F.col("longest") * (1 + SLACK) >= F.pow(F.col("low")[0], 2)
    found = _searched(points, sizes, banded, (F.col("label") != F.col("own")) & may_reach, most)
    tops_of = banded.select("q", F.posexplode("tops").alias("band", "positive_score"))
    unlike = best_ids(found.join(tops_of, ["q", "band"]), ["q", "positive_score"], most)
    out = pairs.join(unlike, ["q", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.posexplode("list").alias("at", "hit"))
    return out.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("negative_id"), "positive_score", F.col("hit.score").alias("negative_score")
    )
