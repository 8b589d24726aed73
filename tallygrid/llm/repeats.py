"""Removal of long byte strings that occur again, with suffix arrays in shards.

Every 400-byte string names an anchor, the 64 bytes in it with the least hash;
equal strings have equal anchors at equal places. The strings around one anchor
of a document are one fragment. Fragments are dealt by their anchor, so all
occurrences of a string meet in one shard, whose suffix array finds them.
Fragments that are equal as a whole go in once. An anchor with more fragments
than a shard holds is dealt over several, whose sorted strings are then merged
by binary search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import body, dropped, freed, maybe_in, surely_not_in, written
from tallygrid.llm.suffix import Shard
from tallygrid.llm.textnum import SpanHasher, mixed, raw, word_spans

#: Fixed by the task.
LENGTH = 400
#: Bytes that stand for a word where passages are told by words.
CODE = 8
#: Bytes of an anchor, and of a shard's fragments.
ANCHOR, SHARD_BYTES = 64, 1 << 20


def anchored(data: np.ndarray, hasher: SpanHasher, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Per fragment: the anchor's hash, the hash of all its bytes, its start, and how many strings of ``length`` start in it."""
    n, width = len(data), min(ANCHOR, length)
    if n < length:
        return (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    places = np.arange(n - width + 1)
    own = hasher(data, places, places + width)
    key = (own & ~np.uint64(0xFFFFFFFF)) | places.astype(np.uint64)  # the first of equal hashes wins
    reach, span = length - width + 1, 1
    while 2 * span <= reach:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < reach:
        key = np.minimum(key[: n - length + 1], key[reach - span :])
    at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    counts = np.diff(np.append(starts, len(at)))
    whole = hasher(data, starts, starts + counts + length - 1)
    return own[at[starts]], mixed(whole + (at[starts] - starts).astype(np.uint64)), starts, counts


def _bytes(text: str | bytes | None) -> bytes:
    return bytes(text) if isinstance(text, bytes | bytearray) else raw(text)


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def _fragments(docs: DataFrame, length: int) -> DataFrame:
    """(key, a, f, n, k, starts): per document and distinct fragment its places; a, f: hashes of anchor and fragment, k: strings in it."""

    @freed
    def run(frames):
        hasher = SpanHasher()
        for frame in frames:
            out, held = [], 0
            for key, text in zip(frame["key"], frame["text"], strict=True):
                a, f, starts, counts = anchored(np.frombuffer(_bytes(text), dtype=np.uint8), hasher, length)
                if not len(a):
                    continue
                order = np.lexsort((f, a))
                a, f, starts, counts = a[order].astype(np.int64), f[order].astype(np.int64), starts[order], counts[order]
                new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (f[1:] != f[:-1])]))
                groups = np.split(starts.astype(np.int32), new[1:])
                out.append(pd.DataFrame({"key": key, "a": a[new], "f": f[new], "n": [len(g) for g in groups], "k": counts[new], "starts": groups}))
                held += len(new)
                if held > 50_000:
                    yield pd.concat(out)
                    out, held = [], 0
            if out:
                yield pd.concat(out)

    return docs.mapInPandas(run, "key long, a long, f long, n int, k int, starts array<int>")


def _cut(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted fragments (key, a, f, sure, start, k, part): (a, part, f, sure, k, bytes)."""
    by_doc = wanted.groupBy("key").agg(F.collect_list(F.struct("a", "part", "f", "sure", "start", "k")).alias("cuts"))
    near = maybe_in(docs, by_doc.select("key"), "key").dropDuplicates(["key"])

    @freed
    def run(frames):
        for frame in frames:
            out = []
            for text, cuts in zip(frame["text"], frame["cuts"], strict=True):
                data = _bytes(text)
                out += [(c["a"], c["part"], c["f"], c["sure"], c["k"], data[c["start"] : c["start"] + c["k"] + length - 1]) for c in cuts]
                if len(out) > 5000:
                    yield pd.DataFrame(out, columns=["a", "part", "f", "sure", "k", "bytes"])
                    out = []
            yield pd.DataFrame(out, columns=["a", "part", "f", "sure", "k", "bytes"])

    return near.join(by_doc, "key").select("text", "cuts").mapInPandas(run, "a long, part int, f long, sure boolean, k int, bytes binary")


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    change = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()


def _in_shards(cuts: DataFrame, length: int) -> DataFrame:
    """Per fragment that isn't sure to repeat as a whole: which of its strings repeat in its shard, as runs (a, part, f, k, froms, tos)."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(list(rows["bytes"]), length)
        found = shard.repeated()
        out = []
        for i, (a, part, f, sure, k) in enumerate(zip(rows["a"], rows["part"], rows["f"], rows["sure"], rows["k"], strict=True)):
            if not sure:
                at = int(shard.starts[i])
                froms, tos = _runs(found[at : at + k])
                if froms:
                    out.append((a, part, f, froms, tos))
        return pd.DataFrame(out, columns=["a", "part", "f", "froms", "tos"])

    @freed
    def run(frames):
        held, size = [], 0
        for frame in frames:
            names = list(zip(frame["a"], frame["part"], strict=True))
            sizes = np.cumsum(frame["bytes"].str.len().to_numpy())
            begin = taken = 0
            for i in range(len(frame)):
                ends = i + 1 < len(frame) and names[i + 1] != names[i]
                if ends and size + sizes[i] - taken >= SHARD_BYTES:  # a shard ends with a whole anchor
                    held.append(frame.iloc[begin : i + 1])
                    yield work(pd.concat(held))
                    held, size, begin, taken = [], 0, i + 1, sizes[i]
            held.append(frame.iloc[begin:])
            size += sizes[-1] - taken if len(frame) else 0
        rows = pd.concat(held) if held else None
        if rows is not None and len(rows):
            yield work(rows)

    dealt = cuts.repartition("a", "part").sortWithinPartitions("a", "part")
    return dealt.mapInPandas(run, "a long, part int, f long, froms array<int>, tos array<int>")


def _across_shards(cuts: DataFrame, length: int) -> DataFrame:
    """For anchors dealt over several shards: strings that occur in two of them, as runs (a, part, f, froms, tos).

    Each shard's distinct strings are sorted by hash and cut into as many ranges
    as there are shards; a range's sorted runs are looked up in each other.
    """

    @freed
    def split(frames):
        hasher = SpanHasher()
        for frame in frames:
            rows = []
            for a, parts, part, f, k, data in zip(frame["a"], frame["parts"], frame["part"], frame["f"], frame["k"], frame["bytes"], strict=True):
                places = np.arange(k)
                marks = hasher(np.frombuffer(data, dtype=np.uint8), places, places + length)
                spread = ((marks >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                for r in np.unique(spread):
                    own = spread == r
                    order = np.argsort(marks[own])
                    rows.append((a, int(r), part, f, marks[own][order].tobytes(), places[own][order].astype(np.int32).tobytes()))
            yield pd.DataFrame(rows, columns=["a", "range", "part", "f", "marks", "places"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        marks = [np.frombuffer(x, dtype=np.uint64) for x in rows["marks"]]
        parts = np.repeat(rows["part"].to_numpy(), [len(m) for m in marks])
        whole = np.concatenate(marks)
        order = np.argsort(whole, kind="stable")
        sorted_, part_of = whole[order], parts[order]
        heads = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        several = np.minimum.reduceat(part_of, heads) != np.maximum.reduceat(part_of, heads)
        shared = sorted_[heads[several]]
        out = []
        for a, part, f, m, p in zip(rows["a"], rows["part"], rows["f"], marks, rows["places"], strict=True):
            if len(shared):
                hit = shared[np.minimum(np.searchsorted(shared, m), len(shared) - 1)] == m
                at = np.sort(np.frombuffer(p, dtype=np.int32)[hit])
                if len(at):
                    out.append((a, part, f, at.tolist(), (at + 1).tolist()))
        return pd.DataFrame(out, columns=["a", "part", "f", "froms", "tos"])

    marks = cuts.where("parts > 1").mapInPandas(split, "a long, range int, part int, f long, marks binary, places binary")
    return marks.groupBy("a", "range").applyInPandas(merge, "a long, part int, f long, froms array<int>, tos array<int>")


def removed_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, froms, tos): per document (by row_key) with any, the maximal runs of bytes covered by repeated strings of ``length``."""
    return _spans(docs.select(row_key().alias("key"), "text"), length)


def removed_words(docs: DataFrame, words: int) -> DataFrame:
    """(key, froms, tos): as removed_spans, in numbers of words, covered by repeated runs of ``words`` words.

    Each word is told by CODE bytes of its hash, white space counts for nothing.
    A run of codes that repeats off their bounds is cut back to whole words.
    """

    @freed
    def code(frames):
        hasher = SpanHasher()
        for frame in frames:
            found = []
            for text in frame["text"]:
                data = np.frombuffer(raw(text), dtype=np.uint8)
                found.append(hasher(data, *word_spans(data)).astype(np.uint64).tobytes())
            yield pd.DataFrame({"key": frame["key"], "text": found})

    coded = docs.select(row_key().alias("key"), "text").mapInPandas(code, "key long, text binary")
    whole = lambda name, add: F.transform(name, lambda x: F.floor((x + add) / CODE).cast("int")).alias(name)
    coded = written(coded)
    spans = _spans(coded, CODE * words).select("key", whole("froms", CODE - 1), whole("tos", 0))
    dropped(coded)
    return spans


def _spans(keyed: DataFrame, length: int) -> DataFrame:
    """Written, so what it was made of needs no room any more."""
    fragments = written(_fragments(keyed, length))
    first = F.min(F.struct("key", F.col("starts")[0].alias("start")))
    kinds = fragments.groupBy("a", "f").agg(F.sum("n").alias("n"), first.alias("rep"), F.first("k").alias("k"))
    kinds = written(kinds.select("a", "f", (F.col("n") > 1).alias("sure"), "rep.key", "rep.start", "k"))
    anchors = kinds.groupBy("a").agg(
        F.count("*").alias("kinds"), F.bool_and("sure").alias("all_sure"), F.sum(F.col("k") + (length - 1)).alias("bytes")
    )
    anchors = anchors.where("kinds > 1 and not all_sure").select("a", F.ceil(F.col("bytes") / SHARD_BYTES).cast("int").alias("parts"))
    wanted = kinds.join(anchors, "a").withColumn("part", F.pmod(F.xxhash64("f"), F.col("parts")).cast("int"))
    cuts = written(_cut(keyed, wanted, length).join(anchors, "a"))
    inside = _in_shards(cuts.select("a", "part", "f", "sure", "k", "bytes"), length).select("a", "f", "froms", "tos")
    across = _across_shards(cuts, length).select("a", "f", "froms", "tos")
    part = inside.union(across)
    sure = kinds.where("sure").select("a", "f", F.array(F.lit(0)).alias("froms"), F.array("k").alias("tos"))
    found = sure.union(part)

    @freed
    def spans(frames):
        for frame in frames:
            froms, tos = [], []
            for starts, a, b in zip(frame["starts"], frame["froms"], frame["tos"], strict=True):
                base = np.asarray(starts, dtype=np.int64)[:, None]
                froms.append((base + np.asarray(a)).ravel())
                tos.append((base + np.asarray(b) + (length - 1)).ravel())
            yield pd.DataFrame({"key": frame["key"], "froms": froms, "tos": tos})

    @freed
    def union(frames):
        for frame in frames:
            out = []
            for key, froms, tos in zip(frame["key"], frame["froms"], frame["tos"], strict=True):
                a, b = np.concatenate(list(froms)), np.concatenate(list(tos))
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.concatenate([[True], a[1:] > b[:-1]])
                ends = np.flatnonzero(np.append(new[1:], True))
                out.append((key, a[new], b[ends]))
            yield pd.DataFrame(out, columns=["key", "froms", "tos"])

    places = fragments.select("key", "a", "f", "starts").join(found, ["a", "f"])
    placed = places.select("key", "starts", "froms", "tos").mapInPandas(spans, "key long, froms array<int>, tos array<int>")
    by_doc = placed.groupBy("key").agg(F.collect_list("froms").alias("froms"), F.collect_list("tos").alias("tos"))
    spanned = written(by_doc.mapInPandas(union, "key long, froms array<int>, tos array<int>"))
    dropped(fragments, kinds, cuts)
    return spanned


def _kept(data: bytes, froms, tos) -> bytes:
    out, at = [], 0
    for a, b in zip(froms, tos, strict=True):
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def repeats_removed(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text has no bytes; texts under LENGTH bytes keep all. Rows that agree
    in id and text are two documents and repeat each other. Other columns are
    left aside.
    """
    keyed = docs.select("doc_id", "text").withColumn("key", row_key())
    spans = removed_spans(docs)
    size = F.octet_length(body()).cast("long").alias("n_bytes")
    base = keyed.select("doc_id", "key", size, F.sha2(body().cast("binary"), 256).alias("_sha"))
    sizes = base.select("key", "n_bytes").dropDuplicates(["key"])
    cleared = F.col("froms")[0].eqNullSafe(F.lit(0)) & (F.col("tos")[0] == F.col("n_bytes"))
    known = written(spans.join(sizes, "key").withColumn("_all", cleared))
    partial = known.where("not _all")

    @freed
    def digest(frames):
        for frame in frames:
            rows = [
                (key, hashlib.sha256(_kept(raw(text), froms, tos)).hexdigest())
                for key, text, froms, tos in zip(*(frame[c] for c in ("key", "text", "froms", "tos")), strict=True)
            ]
            yield pd.DataFrame(rows, columns=["key", "sha"])

    texts = maybe_in(keyed.select("key", "text"), partial.select("key"), "key").dropDuplicates(["key"])
    rest = texts.join(partial, "key").select("key", "text", "froms", "tos").mapInPandas(digest, "key long, sha string")
    total = F.aggregate(F.zip_with("froms", "tos", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    empty = hashlib.sha256(b"").hexdigest()
    changed = known.join(rest, "key", "left").select(
        "key", total.alias("n_removed"), F.size("froms").cast("long").alias("n_spans"), F.when(F.col("_all"), empty).otherwise(F.col("sha")).alias("sha")
    )
    return base.join(changed, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("sha", "_sha").alias("kept_sha256"),
    )


def _by_bytes(data: bytes, froms, tos, word_froms, word_tos) -> tuple[list[int], list[int]]:
    """Runs of bytes and runs of words as joint runs of bytes."""
    runs = [(int(a), int(b)) for a, b in zip(froms, tos, strict=True)] if froms is not None else []
    if word_froms is not None:
        starts, ends = word_spans(np.frombuffer(data, dtype=np.uint8))
        runs += [(int(starts[a]), int(ends[b - 1])) for a, b in zip(word_froms, word_tos, strict=True)]
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [a for a, _ in out], [b for _, b in out]


def without_repeats(docs: DataFrame, words: int = 0) -> DataFrame:
    """``docs`` with the repeated strings cut out of the texts and n_chars to match; rows with nothing left go.

    Besides strings of LENGTH bytes these are passages of ``words`` words, if any.
    A character of which a byte is removed goes as a whole. Rows whose text was
    empty or null already stay as they are.
    """
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("_doc"), "text", row_key().alias("key"))
    spans = removed_spans(docs)
    if words:
        more = removed_words(docs, words).withColumnsRenamed({"froms": "word_froms", "tos": "word_tos"})
        spans = spans.join(more, "key", "full")
    else:
        spans = spans.selectExpr("*", "cast(null as array<int>) word_froms", "cast(null as array<int>) word_tos")
    spans = written(spans)
    runs = ["froms", "tos", "word_froms", "word_tos"]

    @freed
    def cut(frames):
        for frame in frames:
            frame["text"] = [
                _kept(data, *_by_bytes(data, *own)).decode("utf-8", "ignore")
                for data, *own in zip(map(raw, frame["text"]), *(frame[c] for c in runs), strict=True)
            ]
            yield frame[["key", "text"]]

    near, apart = (side(packed, spans, "key") for side in (maybe_in, surely_not_in))  # whole rows travel of the first only
    texts = near.select("key", "text").dropDuplicates(["key"])
    new = texts.join(spans, "key").select("key", "text", *runs).mapInPandas(cut, "key long, text string")
    joined = near.drop("text").join(new.withColumnRenamed("text", "_new"), "key", "left")
    joined = joined.unionByName(apart.drop("text").withColumn("_new", F.lit(None).cast("string")))
    text = F.coalesce("_new", "_doc.text")
    fields = {c: F.col(f"_doc.`{c}`") for c in names} | {"text": text}
    if "n_chars" in fields:
        fields["n_chars"] = F.when(F.col("_new").isNull(), fields["n_chars"]).otherwise(F.length("_new").cast(docs.schema["n_chars"].dataType))
    kept = joined.where(F.col("_new").isNull() | (F.col("_new") != ""))
    return kept.select(*(c.alias(name) for name, c in fields.items()))
