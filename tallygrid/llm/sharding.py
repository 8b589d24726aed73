"""Shards by a hierarchical weighted hash tree: region, rack, shard.

Every shard draws -ln(u) / weight with u from a hash of the row's id and the
shard's name; the draw of a rack is the least draw below it, that of a region
the least of its racks. Such a draw is distributed as one with the summed
weight, so descending to the child with the least draw, level by level, picks
each subtree in proportion to its weight. A changed weight changes only draws
on the path to it: rows move into or out of that subtree and nowhere else, and
a new shard takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.llm.common import body

#: Rows of a shard are numbered in so many independent pieces.
PIECES = 4096


@dataclass(frozen=True)
class Shard:
    number: int
    region: int
    rack: int
    weight: float = 1.0


def even_tree(n: int, racks: int = 3, shards: int = 4) -> tuple[Shard, ...]:
    """n shards of weight 1, filled up region by region: ``racks`` racks of ``shards`` shards each."""
    return tuple(Shard(i, i // (racks * shards), i // shards) for i in range(n))


def _draw(key: Column, shard: Shard) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard.number)), 12).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / F.lit(float(shard.weight))


def _least(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.least(*columns)


def _descend(tree: dict, draws: dict[int, Column]) -> tuple[Column, Column]:
    """The shard that a subtree's draws lead to, and the subtree's own draw. Ties go to the earlier child."""
    if isinstance(tree, Shard):
        return F.lit(tree.number), draws[tree.number]
    below = [_descend(child, draws) for child in tree.values()]
    least = _least([draw for _, draw in below])
    chosen = below[-1][0]
    for number, draw in reversed(below[:-1]):
        chosen = F.when(draw == least, number).otherwise(chosen)
    return chosen, least


def place(frame: DataFrame, key: str, shards: tuple[Shard, ...], name: str) -> DataFrame:
    """Adds the shard of each row. Rows with equal keys, null included, share a shard; weights of 0 take no rows."""
    live = [s for s in shards if s.weight > 0]
    if not live:
        raise ValueError("no shard has a weight")
    tree: dict = {}
    for s in live:
        tree.setdefault(s.region, {}).setdefault(s.rack, {})[s.number] = s
    held = frame.withColumns({f"_draw{s.number}": _draw(F.col(key), s) for s in live})
    draws = {s.number: F.col(f"_draw{s.number}") for s in live}
    return held.withColumn(name, _descend(tree, draws)[0].cast("int")).drop(*(f"_draw{s.number}" for s in live))


def numbered(frame: DataFrame, shard: str, order: list[str], name: str) -> DataFrame:
    """Numbers the rows of each shard from 0 without gaps; no task gets a whole shard.

    Rows of a shard are cut into PIECES by a hash of ``order``; a piece starts
    where the pieces before it end. Rows that agree in ``order`` get the numbers
    of a run in any order.
    """
    cut = frame.withColumn("_piece", F.pmod(F.xxhash64(*order), F.lit(PIECES)))
    counts = cut.groupBy(shard, "_piece").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(shard).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(shard, "_piece").orderBy(*order)
    ranked = cut.withColumn("_rank", F.row_number().over(within))
    joined = ranked.join(starts, [shard, "_piece"])
    return joined.withColumn(name, (F.col("_start") + F.col("_rank") - 1).cast("long")).drop("_piece", "_start", "_rank")


def shard_documents(docs: DataFrame, n: int) -> DataFrame:
    """One row per row of ``docs``: size, checksum, shard, place in it, and the shard after one more was added.

    A null text has size 8 and the checksum of no bytes. Rows with the same
    doc_id (a null one too) share a shard. Other columns are left aside.
    """
    rows = docs.select(
        "doc_id",
        (F.octet_length(body()) + 8).cast("long").alias("size"),
        F.crc32(body().cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    shards = even_tree(n + 1)
    placed = place(place(rows, "doc_id", shards[:n], "shard"), "doc_id", shards, "grown_shard")
    order = ["doc_id", "text_crc32", "size"]
    return numbered(placed, "shard", order, "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
