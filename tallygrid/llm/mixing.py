"""Mixing sources to target weights by weighted fair queueing.

Each source's documents queue in a shuffled order, and queue a second time
behind that. A copy's virtual finish is the source's tokens up to its end over
the source's target. Sorted by finish over all sources, the mix serves every
source in proportion to its target at any point; it is cut at virtual time 1,
where the served tokens sum to the budget, and a copy in service there is taken
up to the cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.llm.common import word_count, written

#: Fixed by the task: weights by rank of the source, share of all words, most copies of a document.
WEIGHTS, SHARE_NUM, SHARE_DEN, MOST = (3, 1, 2), 3, 2, 2
#: A source's queue is summed up in so many pieces of its shuffled order.
PIECES = 4096


def source_targets(sizes: DataFrame, weights=WEIGHTS, num: int = SHARE_NUM, den: int = SHARE_DEN, most: int = MOST) -> DataFrame:
    """From (source, source_size) to (source, source_size, weight, target); one row per source, the only frame sorted in one task.

    num / den of all words is shared by weight; a target stops at ``most``
    times the source's size and the excess goes to the others by weight. With
    sources in the order of cap over weight, the capped ones are a prefix: the
    first source whose cap reaches the fair level of what is left ends it.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    listed = F.array(*(F.lit(w) for w in weights))
    weighed = ranked.withColumn("weight", F.element_at(listed, (F.col("_rank") % len(weights) + 1).cast("int")).cast("long"))
    capped = weighed.withColumn("_cap", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("_cap") / F.col("weight"), "_rank")
    before, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = capped.select(
        "*",
        (F.sum("source_size").over(whole) * num / den - F.coalesce(F.sum("_cap").over(before), F.lit(0))).alias("_left"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("_weights"),
    )
    level = left.withColumn("_level", F.col("_left") / F.col("_weights"))
    open_level = F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.col("_level"))
    first = F.first(open_level, ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = level.withColumn("_at", first)
    target = F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_at") * F.col("weight"), F.col("_cap").cast("double")))
    return last.select("source", "source_size", "weight", target.alias("target"))


def queued(rows: DataFrame) -> DataFrame:
    """Adds to (doc_id, source, size) the words of the source's shuffled documents before this one.

    The order is that of md5(doc_id), then doc_id and size. A source is summed
    in pieces of that order, so a source with most rows still spreads out.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    piece = (F.conv(F.substring("_key", 1, 3), 16, 10)).cast("int")
    keyed = rows.withColumn("_key", key).withColumn("_piece", piece)
    sums = keyed.groupBy("source", "_piece").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_source"), F.col("_piece").alias("_part"), F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy("source", "_piece").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inner = keyed.withColumn("_inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = inner.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_piece") == F.col("_part")))
    return joined.withColumn("before", F.col("_start") + F.col("_inner")).drop("_key", "_piece", "_source", "_part", "_start", "_inner")


def targets_of(rows: DataFrame) -> DataFrame:
    """(doc_id, source, size) with source_size and target added; the per-source table has one row per source."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = source_targets(sizes).withColumnRenamed("source", "_of")
    return rows.join(aimed, F.col("source").eqNullSafe(F.col("_of"))).drop("_of", "weight")


def serve(rows: DataFrame, most: int = MOST) -> DataFrame:
    """Every queued copy with its virtual start and finish and the words taken of it; copies behind the cut are left out."""
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    begun = copies.withColumn("_from", F.col("before") + F.col("copy") * F.col("source_size"))
    room = F.floor(F.col("target")) - F.col("_from")
    taken = F.greatest(F.lit(0), F.least(F.col("size"), room)).cast("long")
    start, finish = F.col("_from") / F.col("target"), (F.col("_from") + F.col("size")) / F.col("target")
    served = begun.where((F.col("target") > 0) & (F.col("_from") < F.col("target")))
    return served.select(*rows.columns, "copy", start.alias("start"), finish.alias("finish"), taken.alias("words"))


def in_order(rows: DataFrame) -> DataFrame:
    """The copies that the mix takes of :func:`queued` rows, with the words taken, globally sorted by virtual finish."""
    order = ["finish", "source", "doc_id", "copy"]
    items = serve(rows).where(F.col("words") > 0).select("doc_id", "source", "copy", "finish", "words", "before")
    return items.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself, globally sorted by virtual finish: one row per copy taken, (doc_id, source, copy, finish, words)."""
    return in_order(queued(targets_of(sized(docs)))).drop("before")


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count().alias("size"))


def mix_counts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its words, its source's words and target, and the words the mix takes of it.

    The queue is served in order of virtual finish and stored so; what a row
    gives is the sum over its copies there. A null text has size 0 and is never
    taken; a null source is a source of its own, ranked last; rows that share an
    id are queued one by one, and are told by their source and place in its queue.
    """
    rows = written(queued(targets_of(written(sized(docs)))))
    served = written(in_order(rows)).groupBy(F.col("source").alias("_of"), F.col("before").alias("_at")).agg(F.sum("words").alias("_words"))
    own = F.col("source").eqNullSafe(F.col("_of")) & (F.col("before") == F.col("_at")) & (F.col("size") > 0)
    taken = F.coalesce(F.col("_words"), F.lit(0)).cast("long").alias("taken")
    return rows.join(served, own, "left").select("doc_id", "size", "source_size", "target", taken)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it, all columns as they are.

    Here documents stay whole: the copy in service at the cut is taken if at
    least half of it lies before the cut. Rows that agree in id and text are
    queued once and share their copies.
    """
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(key.alias("doc_id"), "source", word_count().alias("size")).dropDuplicates(["doc_id"])
    items = serve(queued(targets_of(rows))).where(2 * F.col("words") >= F.greatest("size", F.lit(1)))
    copies = items.groupBy(F.col("doc_id").alias("_key")).agg(F.count("*").cast("int").alias("_copies"))
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), key.alias("_key"))
    taken = packed.join(copies, "_key").select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
    return taken.select("_doc.*")
