"""Token ids as files of Huffman-coded blocks, in ascending doc_id order, and the way back.

The files are Parquet files of blocks: part and from, the place of the block's
first id in the order; the documents and their numbers of ids; the coded ids
and their checkpoints. A folder beside them holds the code lengths. Both are
all that reading needs, and any block can be read alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.llm import huffman
from tallygrid.llm.bpe import Encoder, batches, kept
from tallygrid.llm.common import shared_folder, written

#: Id after each document, and ids a block takes before it ends with its last document.
END_ID, BLOCK_IDS = 0, 1 << 17

BLOCKS = "part int, start long, doc_ids array<long>, doc_tokens array<int>, n int, checkpoints array<int>, bits binary"


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids with END_ID, as compressed 16-bit values."""

    def run(frames):
        encoder = kept(f"bpe:{vocabulary}", lambda: Encoder(vocabulary))
        pack = zstandard.ZstdCompressor(level=1).compress
        end = np.array([END_ID], dtype="<u2").tobytes()
        for frame in frames:
            texts = frame["text"].fillna("").tolist()
            for a, b in batches(texts):
                ids = [x + end for x in encoder(texts[a:b])]
                yield pd.DataFrame(
                    {"doc_id": frame["doc_id"].iloc[a:b].astype("Int64"), "n_tokens": [len(x) // 2 for x in ids], "ids": [pack(x) for x in ids]}
                )

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_tokens long, ids binary")


def _unpacked(column: pd.Series) -> list[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [np.frombuffer(unpack(x), dtype="<u2") for x in column]


def id_counts(encoded: DataFrame) -> np.ndarray:
    """Occurrences of each of the 65,536 possible ids."""

    def run(frames):
        total = np.zeros(1 << 16, dtype=np.int64)
        for frame in frames:
            for a in range(0, len(frame), 500):
                total += np.bincount(np.concatenate(_unpacked(frame["ids"].iloc[a : a + 500])), minlength=1 << 16)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    rows = encoded.select("ids").mapInPandas(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << 16, dtype=np.int64)
    for row in rows:  # at most 65,536
        counts[row["id"]] = row["n"]
    return counts


def write(encoded: DataFrame, path: str) -> None:
    """Writes (doc_id, n_tokens, ids) to ``path``/lengths and ``path``/blocks."""
    spark = encoded.sparkSession
    lengths = huffman.code_lengths(id_counts(encoded))
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pd.DataFrame({"id": used.astype(np.int32), "length": lengths[used].astype(np.int32)}), "id int, length int").coalesce(1).write.parquet(f"{path}/lengths")

    def run(frames):
        codes, part, start = huffman.codes(lengths), TaskContext.get().partitionId(), 0
        names, sizes, held, n = [], [], [], 0

        def block():
            ids = np.concatenate(held).astype(np.int64)
            bits, checkpoints = huffman.encode_block(ids, lengths, codes)
            row = (part, start, names, sizes, len(ids), checkpoints.astype(np.int32), bits)
            return pd.DataFrame([row], columns=["part", "start", "doc_ids", "doc_tokens", "n", "checkpoints", "bits"])

        for frame in frames:
            for doc_id, ids in zip(frame["doc_id"].astype(object), _unpacked(frame["ids"]), strict=True):
                names.append(None if pd.isna(doc_id) else int(doc_id))
                sizes.append(len(ids))
                held.append(ids)
                n += len(ids)
                if n >= BLOCK_IDS:
                    yield block()
                    start += n
                    names, sizes, held, n = [], [], [], 0
        if names:
            yield block()

    ordered = encoded.select("doc_id", "n_tokens", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "n_tokens", "ids")
    ordered.select("doc_id", "ids").mapInPandas(run, BLOCKS).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids (as array<int>, the end id included)."""
    return _decoded(spark, path, "ids array<int>", lambda ids: ids.astype(np.int32))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """As read, with the CRC of the ids as little-endian 32-bit values in place of the ids."""
    return _decoded(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))


def _decoded(spark: SparkSession, path: str, column: str, made) -> DataFrame:
    lengths = np.zeros(1 << 16, dtype=np.uint8)
    for row in spark.read.schema("id int, length int").parquet(f"{path}/lengths").collect():  # at most 65,536
        lengths[row["id"]] = row["length"]

    def run(frames):
        ids_of, widths = huffman.decode_table(lengths)
        for frame in frames:
            for part, start, names, sizes, n, checkpoints, bits in zip(*(frame[c] for c in frame.columns), strict=True):
                ids = huffman.decode_block(bits, n, np.asarray(checkpoints), ids_of, widths)
                ends = np.cumsum(sizes)
                rows = [(part, start + e - s, None if x is None or x != x else int(x), s, made(ids[e - s : e])) for x, s, e in zip(names, sizes, ends, strict=True)]
                yield pd.DataFrame(rows, columns=["part", "inner", "doc_id", "n_tokens", column.split()[0]]).astype({"doc_id": "Int64"})

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n").alias("_n"))  # a row for each task that wrote
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    docs = blocks.mapInPandas(run, f"part int, inner long, doc_id long, n_tokens long, {column}")
    out = docs.join(bases, "part")
    return out.select("doc_id", (F.col("_base") + F.col("inner")).alias("start"), "n_tokens", column.split()[0])


def stored_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encodes, writes the files to the shared folder, reads them back: doc_id, start, n_tokens, ids_crc32.

    A null text is empty and has the end id alone; a null doc_id sorts first;
    rows that share an id follow each other by length and ids. Other columns
    are left aside.
    """
    path = f"{shared_folder(docs.sparkSession)}/tokens"
    write(written(encode(docs, vocabulary)), path)
    return checksums(docs.sparkSession, path)
