"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}

#: Bytes of table files per shuffle partition; posted lines take some twenty times their files' bytes in a task.
PART_BYTES = 4 << 20
#: Of staged frames, which lie on the disks for most of a run.
CODEC = "zstd"
#: Shuffled bytes that adaptive execution merges into one task, at most.
MERGED_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every plan here relies on.

    Skewed join partitions are split even if that costs one more shuffle,
    because a single account may own a large share of all lines. Bloom filters
    of accounts and invoices may hold tens of millions of ids (64 MB at most);
    Spark adds them where the scanned side is large enough to pay for one.
    A union keeps the partitions of its branches apart: lined up, one task would
    read a partition of every branch, and of the branches of these. Partitions
    are merged to ``MERGED_BYTES`` at most, since a task sorts and groups wide rows
    several times over: their memory is some forty times what it reads.
    """
    advised = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advised) > MERGED_BYTES:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(MERGED_BYTES))
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "2GB")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.maxNumItems", "50000000")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.maxNumBits", str(1 << 29))
    return spark


def fit_partitions(spark: SparkSession, *tables: DataFrame, part: int = PART_BYTES) -> int:
    """Raises the number of shuffle partitions, and with it of buckets, to one per ``part`` bytes of the tables' files.

    With a fixed number a task's rows grow with the input. Few rows cost little
    then: adaptive execution merges small partitions.
    """
    size = sum(int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables)
    needed = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part))
    spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return needed


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master without that setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    set_by_caller = spark.sparkContext.getCheckpointDir()
    if set_by_caller:
        return set_by_caller.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        root = tempfile.mkdtemp(prefix="tallygrid-")
        atexit.register(shutil.rmtree, root, True)
        _local_roots[context.applicationId] = root
    return _local_roots[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{uuid.uuid4().hex}/{name}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each write inside go when it ends.

    Otherwise they stay until the driver collects the garbage that refers to
    them, which a driver with memory to spare rarely does: the disks then hold
    the shuffles of all writes of a run at once. Only for writes, whose frames
    are planned anew where they are used again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Staging:
    """Writes intermediates as Parquet below ``root`` and reads them back.

    Unlike a cached frame the written table survives lost executors, and later
    readers still get column pruning and pushed filters. As a context manager
    it removes its tables and its folder at the end, so results must be stored
    before that; with :meth:`leave` the files outlive the results' readers.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None) -> None:
        self.spark = spark
        self.root = root
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: list[str] = []

    def __call__(self, frame: DataFrame, name: str, by: str | None = None, parts: str | None = None) -> DataFrame:
        """The stored frame. With ``by`` it lies in sorted buckets of that column, with ``parts`` in a folder per value.

        Joins, windows and aggregates whose keys include the bucket column then
        need no exchange of it. The frame should come dealt by ``by`` into
        ``buckets`` partitions, which gives each bucket one file; otherwise
        every task writes a file for each bucket it has rows of. Folders are
        filled by tasks of even size: small values share one, large ones have several.
        """
        path = f"{self.root}/{name}"
        table = f"stage_{uuid.uuid4().hex}" if by and not parts else None
        writer = (frame.hint("rebalance", parts) if parts else frame).write.mode("errorifexists").option("compression", CODEC)
        with shuffles_freed(self.spark):
            if table:
                self.tables.append(table)
                writer.bucketBy(self.buckets, by).sortBy(by).option("path", path).format("parquet").saveAsTable(table)
                return self.spark.table(table)
            (writer.partitionBy(parts) if parts else writer).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def forget(self) -> None:
        """Drop the tables' names; frames read from them still find the files."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def leave(self) -> None:
        """For results that are read later: the files go when the driver's JVM ends."""
        self.forget()
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(place)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.forget()
        remove_folder(self.spark, self.root)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete ``path`` in whatever file system it names; nothing happens where it is missing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def inline(frame: DataFrame, name: str, by: str | None = None, parts: str | None = None) -> DataFrame:
    """Staging replacement that keeps the plan lazy."""
    return frame
