"""What the operators share: tables, the shared folder, words, bounded filters."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.session import remove_folder, shuffles_freed

#: Fixed by the task: a word is a maximal run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

_local_roots: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only for a local master without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_roots.setdefault(context.applicationId, tempfile.mkdtemp(prefix="llm-"))
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


#: Folders that the stages of a pipeline wrote for themselves, and whether one is being built.
_kept: list[str] = []
_keeping = False


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage of a pipeline, whose predecessor's result is stored when it starts.

    So what earlier stages staged for themselves goes first, but for folders
    that ``docs`` still reads, and with it shuffle files that no frame needs.
    """

    @functools.wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _keeping
        read = "\n".join(docs.inputFiles()) if _kept else ""
        for path in [p for p in _kept if p.rsplit("/", 1)[1] not in read]:
            remove_folder(spark, path)
            _kept.remove(path)
        gc.collect()
        spark._jvm.System.gc()  # lets the cleaner see which shuffles are out of use
        _keeping = True
        try:
            return work(spark, docs, sf_dir)
        finally:
            _keeping = False

    return run


def written(frame: DataFrame) -> DataFrame:
    """The frame, written once to the shared folder and read from there: a cut in the lineage that survives lost executors.

    Its shuffle files go with the write, its own with :func:`dropped`.
    """
    spark = frame.sparkSession
    path = shared_folder(spark)
    if _keeping:
        _kept.append(path)
    with shuffles_freed(spark):
        frame.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(frame.schema).parquet(path)
    stored._written_to = path
    return stored


def dropped(*frames: DataFrame) -> None:
    """Remove the files of frames that came from :func:`written` and that nothing reads any more."""
    for frame in frames:
        remove_folder(frame.sparkSession, frame._written_to)
        if frame._written_to in _kept:
            _kept.remove(frame._written_to)


def freed(work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The work of a task over frames, after which its worker process gives back the memory that it no longer uses.

    Workers wait for further tasks, and several of them share an executor's
    memory with its JVM; what the C library and Arrow keep for reuse would
    stay with each of them while stages without Python run.
    """

    @functools.wraps(work)
    def run(frames):
        try:
            yield from work(frames)
        finally:
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return run


def body(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def commonest(counts: DataFrame, most: int) -> list[tuple[int, int]]:
    """The commonest keys of (key, n), at most ``most``, by falling n.

    Counts are binned by size first (at most 512 bins), and the largest bins
    that fit are taken whole. So neither the driver nor any task holds more than
    ``most`` keys; a limit over a sort would send that many from each task.
    """
    level = F.floor(F.log2(F.col("n")) * 8)
    held, least = 0, None
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        if held + row["count"] > most:
            break
        held, least = held + row["count"], row["level"]
    if least is None:
        return []
    rows = [(r["key"], r["n"]) for r in counts.where(level >= least).select("key", "n").collect()]
    return sorted(rows, key=lambda r: (-r[1], r[0]))


#: Rows and bits of the filter below: 65,536 rows of 64 bits, about 1 MB, whatever the input.
FILTER_ROWS, FILTER_BITS = 1 << 16, 64


def maybe_in(frame: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``frame`` whose key may be among ``keys`` (a Bloom filter with one hash): all that are, and some more.

    The broadcast table has at most FILTER_ROWS rows. It spares a shuffle of
    wide rows that a later exact join would drop; where ``keys`` outgrow it, it
    only spares less.
    """
    return _by_filter(frame, keys, key, "inner", lambda hit: hit != 0)


def surely_not_in(frame: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The other rows of ``frame``, none of whose keys is among ``keys``."""
    return _by_filter(frame, keys, key, "left", lambda hit: F.coalesce(hit, F.lit(0)) == 0)


def _by_filter(frame: DataFrame, keys: DataFrame, key: str, how: str, test: Callable[[Column], Column]) -> DataFrame:
    h = F.xxhash64(F.col(key), F.lit(77))
    slot, bit = F.pmod(h, F.lit(FILTER_ROWS)), F.pmod(F.shiftrightunsigned(h, 20), F.lit(FILTER_BITS)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bits = keys.select(slot.alias("_slot"), one.alias("_bit")).groupBy("_slot").agg(F.bit_or("_bit").alias("_bits"))
    kept = frame.withColumn("_at", slot).join(F.broadcast(bits), F.col("_at") == F.col("_slot"), how)
    return kept.where(test(F.col("_bits").bitwiseAND(one))).drop("_at", "_slot", "_bits")
