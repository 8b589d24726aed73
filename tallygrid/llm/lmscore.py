"""Language-model scores of whole texts, beside an add-one unigram score of their words.

Word counts come from all training texts, and so do the weights of the attention
model: common words and the beginnings of others are its subwords. Training
texts are cut into ids once and dealt by hash; in each round every deal learns
from its share of all training windows, and the moves of the weights are summed
by windows as whole numbers, in any order. The rests of words have their share
of the counts. Each text is cut into overlapping windows that score every
subword once.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.attention import BEGINNINGS, COMMON, END, IDS, Attention, Trainer, Vocabulary, beginnings
from tallygrid.llm.common import commonest, remainder, written
from tallygrid.llm.textnum import SpanHasher, keep_memory, lowered, raw, word_spans

#: Fixed by the task.
HELD_OUT, FOLDS = 2, 7
#: Words whose counts are sent to all tasks, COMMON at least; the others are joined.
HEAD = 1 << 17
#: Rounds that together use every training window once, windows of a step, first rate.
ROUNDS, BATCH, RATE = 2, 128, 0.02
#: Ids dealt to one task of a round, ids of a row, steps of a weight's move that are counted.
DEAL, ROW_IDS, FINE = 1 << 22, 1 << 13, float(1 << 40)
WORDS, TRIPLES, BYTES, TEXTS = 0, 1, 2, 3
LONG = 4


def _classes() -> np.ndarray:
    """Of each byte: 0 white space, letters, second bytes of characters by five bits, and four of others."""
    out = np.full(256, 63, dtype=np.int32)
    out[[32, *range(9, 14)]] = 0
    out[97:123] = np.arange(1, 27)
    out[128:192] = 28 + (np.arange(64) & 31)
    out[192:], out[0xC3], out[48:58] = 60, 27, 61
    out[33:48] = 62
    return out


CLASSES, _CLASSES = 64, _classes()


def _chunks(texts: list[bytes], size: int):
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size or i + 1 == len(texts):
            yield at, i + 1
            at, held = i + 1, 0


class Words:
    """The lower-cased words of some texts: hashes, beginnings, and where each text's begin (one more entry than texts)."""

    def __init__(self, texts: list[bytes], hasher: SpanHasher) -> None:
        self.data = np.concatenate([lowered(b"\n".join(texts)), np.full(3, 10, dtype=np.uint8)])
        self.starts, self.ends = word_spans(self.data)
        self.cuts = np.searchsorted(self.starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
        self.cuts[-1] = len(self.starts)
        self.hashes = (hasher(self.data, self.starts, self.ends) >> np.uint64(1)).astype(np.int64)
        self.begins = beginnings(self.data, self.starts, self.ends)

    def triples(self) -> tuple[np.ndarray, np.ndarray]:
        """Per byte the classes of the two before it and its own as one number, and the byte itself; white space is 0."""
        now = _CLASSES[self.data]
        none = np.zeros(2, dtype=now.dtype)  # a plain 0 would make 64-bit numbers of all
        one, two = np.concatenate([none[:1], now[:-1]]), np.concatenate([none, now[:-2]])
        one_back = np.where(one == 0, 0, two)  # what lies before a word's first letter doesn't count
        return (one_back * CLASSES + one) * CLASSES + now, np.where(now == 0, 0, self.data)

    def spelled(self, of: np.ndarray) -> np.ndarray:
        """Places of the bytes of some words, each word with the white space behind it."""
        sizes = self.ends[of] - self.starts[of] + 1
        return np.repeat(self.starts[of] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())

    def with_ends(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids with END behind each text, where each text begins, and the places of the words."""
        begins = self.cuts + np.arange(len(self.cuts))
        out = np.full(len(ids) + len(self.cuts) - 1, END, dtype=np.int64)
        places = np.arange(len(ids)) + np.repeat(np.arange(len(self.cuts) - 1), np.diff(self.cuts))
        out[places] = ids
        return out, begins, places


#: Bytes of texts that are counted at once: a count takes some hundred times as many. So many counts are summed before they are passed on.
COUNTED, SUMMED = 1 << 20, 4


def _summed(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """Counted words of some pieces as rows, each word once."""
    keys, begins, n = (np.concatenate(x) for x in zip(*found, strict=True))
    keys, at, of = np.unique(keys, return_index=True, return_inverse=True)
    return pd.DataFrame({"kind": WORDS, "key": keys, "begins": begins[at], "n": np.bincount(of, n, len(keys)).astype(np.int64)})


def corpus_counts(training: DataFrame) -> DataFrame:
    """(kind, key, begins, n): occurrences of each word (by hash, with its beginning), the number of texts, and occurrences
    of byte classes in threes and of bytes in words of LONG bytes or more, as words that are not known are seldom short."""

    def run(frames):
        keep_memory()
        hasher = SpanHasher()
        for frame in frames:
            texts = [raw(t) for t in frame["text"]]
            threes, ones, found = np.zeros(CLASSES**3, dtype=np.int64), np.zeros(256, dtype=np.int64), []
            for a, b in _chunks(texts, COUNTED):
                words = Words(texts[a:b], hasher)
                keys, at, n = np.unique(words.hashes, return_index=True, return_counts=True)
                triples, own = words.triples()
                places = words.spelled(np.flatnonzero(words.ends - words.starts >= LONG))
                threes += np.bincount(triples[places], minlength=CLASSES**3)
                ones += np.bincount(own[places], minlength=256)
                found.append((keys, words.begins[at], n))
                if len(found) == SUMMED:
                    yield _summed(found)
                    found = []
            if found:
                yield _summed(found)
            for kind, counted in ((TRIPLES, threes), (BYTES, ones)):
                used = np.flatnonzero(counted)
                yield pd.DataFrame({"kind": kind, "key": used, "begins": 0, "n": counted[used]})
            if texts:
                yield pd.DataFrame({"kind": [TEXTS], "key": [0], "begins": [0], "n": [len(texts)]})

    found = training.select("text").mapInPandas(run, "kind int, key long, begins long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.min("begins").alias("begins"))


def vocabulary_of(counts: DataFrame, texts: int) -> Vocabulary:
    words = counts.where(F.col("kind") == WORDS)
    common = commonest(words, COMMON)
    held = counts.sparkSession.createDataFrame([(k,) for k, _ in common], "key long")  # at most COMMON rows
    others = words.join(F.broadcast(held), "key", "left_anti")
    by_begin = written(others.groupBy(F.col("begins").alias("key")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")))
    chosen = {k: n for k, n in commonest(by_begin, BEGINNINGS)}
    rows = by_begin.where(F.col("key").isin(list(chosen))).collect() if chosen else []  # at most BEGINNINGS rows
    begins = sorted(((r["key"], r["n"], r["kinds"]) for r in rows), key=lambda r: (-r[1], r[0]))
    whole = by_begin.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds")).first()
    rest = whole["n"] - sum(n for _, n, _ in begins), whole["kinds"] - sum(k for *_, k in begins)
    once, twice = others.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    discount = min(0.95, once / (once + 2 * twice)) if once else 0.5
    threes, ones = np.zeros(CLASSES**3), np.zeros(256)
    for r in counts.where(F.col("kind").isin(TRIPLES, BYTES)).select("kind", "key", "n").collect():  # at most CLASSES ** 3 + 256 rows
        (threes if r["kind"] == TRIPLES else ones)[r["key"]] = r["n"]
    return Vocabulary.of(common, begins, rest, texts, discount, spelling_of(threes, ones))


def spelling_of(threes: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log chances of classes behind two others, drawn towards those behind one, and of bytes within their class."""
    threes = threes.reshape(CLASSES, CLASSES, CLASSES)
    twos = threes.sum(axis=0) + 1 / CLASSES
    behind_one = twos / twos.sum(axis=1, keepdims=True)
    behind_two = (threes + 4 * behind_one) / (threes.sum(axis=2, keepdims=True) + 4)
    ones = ones + 1
    return np.log(behind_two).ravel(), np.log(ones / np.bincount(_CLASSES, ones, CLASSES)[_CLASSES])


def fit(training: DataFrame, counts: DataFrame, totals: dict[int, tuple[int, int]]) -> tuple[Vocabulary, Attention]:
    texts = totals.get(TEXTS, (0, 0))[0]
    vocabulary = vocabulary_of(counts, texts)
    model = Attention.fresh(vocabulary.counts)
    return vocabulary, trained(training, vocabulary, model, totals.get(WORDS, (0, 0))[0] + texts) if texts else model


def encoded(training: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, at, ids): the ids of all training texts as 16-bit numbers, long texts in several rows."""
    held = training.sparkSession.sparkContext.broadcast(cloudpickle.dumps(vocabulary))

    def run(frames):
        keep_memory()
        vocabulary, hasher = cloudpickle.loads(held.value), SpanHasher()
        for frame in frames:
            texts = [raw(t) for t in frame["text"]]
            for a, b in _chunks(texts, 1 << 20):
                words = Words(texts[a:b], hasher)
                ids, begins, _ = words.with_ends(vocabulary.encode(words.hashes, words.begins)[0])
                small, rows = ids.astype(np.uint16), []
                for name, x, y in zip(frame["doc_id"].iloc[a:b].astype("Int64"), begins, begins[1:], strict=False):
                    rows += [(name, at, small[x + at : min(x + at + ROW_IDS, y)].tobytes()) for at in range(0, y - x, ROW_IDS)]
                out = pd.DataFrame(rows, columns=["doc_id", "at", "ids"])
                yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return training.select("doc_id", "text").mapInPandas(run, "doc_id long, at int, ids binary")


def _pieces(frames, size: int):
    """(deal, ids of rows) of frames that are sorted by deal: pieces of one deal, of ``size`` ids or more but for its last."""
    now, parts, n = None, [], 0
    for frame in frames:
        for deal, ids in zip(frame["deal"], frame["ids"], strict=True):
            if parts and (deal != now or n >= size):
                yield now, parts
                parts, n = [], 0
            now = deal
            parts.append(np.frombuffer(ids, dtype=np.uint16))
            n += len(parts[-1])
    if parts:
        yield now, parts


def trained(training: DataFrame, vocabulary: Vocabulary, model: Attention, tokens: int) -> Attention:
    """The model after ROUNDS rounds that together use every training window once; there are ``tokens`` ids.

    Rows are dealt by hash and sorted within a deal, so neither the files they
    come from nor the number of partitions matter. Each deal starts a round from
    the same weights and passes on how far it moved them, times its windows; only
    the weights are broadcast, and only their summed moves come back.
    """
    context, deals = training.sparkSession.sparkContext, -(-tokens // DEAL)
    rows, order = written(encoded(training, vocabulary)), ("doc_id", "at", "ids")
    numbered = rows.withColumn("deal", F.pmod(F.hash(F.xxhash64(*order)), F.lit(deals)))
    # With more ranges than deals no two deals share one; what else is asked for stays empty.
    dealt = numbered.repartitionByRange(2 * deals, "deal").sortWithinPartitions("deal", *order).select("deal", "ids")
    for number in range(ROUNDS):
        held = context.broadcast(cloudpickle.dumps(model))  # bounded by IDS; by value, as executors lack the package

        def learn(frames, held=held, number=number):
            keep_memory()
            start = cloudpickle.loads(held.value)
            for _, pieces in itertools.groupby(_pieces(frames, 1 << 18), lambda piece: piece[0]):
                trainer = Trainer(start, RATE * (1 - 0.7 * number / ROUNDS))
                for _, parts in pieces:
                    begins = np.cumsum([0] + [len(x) for x in parts])
                    trainer.learn(np.concatenate(parts).astype(np.int64), begins, number, ROUNDS, BATCH)
                if trainer.windows:
                    moves = np.rint((trainer.model.flat() - start.flat()).astype(np.float64) * FINE / (1 << 20)).astype(np.int64) * trainer.windows
                    yield pd.DataFrame({"weight": range(len(moves)), "windows": trainer.windows, "move": moves})

        moves = dealt.mapInPandas(learn, "weight int, windows long, move long").groupBy("weight")
        summed = moves.agg(F.sum("windows").alias("windows"), F.sum(F.col("move").cast("decimal(28,0)")).alias("move"))
        found = summed.select("weight", (F.col("move").cast("double") / F.col("windows")).alias("by")).toPandas()  # one row a weight
        if len(found):
            model = model.moved(found.sort_values("weight")["by"].to_numpy() * (1 << 20) / FINE)
        held.destroy()
    return model


def scores(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty: its end is its only token. Rows that share an id are
    scored one by one. With no training text at all the base score is that of a
    vocabulary without words and the model that of its start. Other columns are
    left aside.
    """
    rows = docs.select("doc_id", (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    training = rows.where("not held_out").select("doc_id", "text")
    counts = written(corpus_counts(training))
    totals = {r["kind"]: (r["n"], r["keys"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("keys")).collect()}
    texts = totals.get(TEXTS, (0, 0))[0]
    all_tokens = totals.get(WORDS, (0, 0))[0] + texts
    distinct = totals.get(WORDS, (0, 0))[1] + (texts > 0)
    head = np.array(commonest(counts.where(F.col("kind") == WORDS), HEAD), dtype=np.int64).reshape(-1, 2)
    head = head[np.argsort(head[:, 0])]
    vocabulary, model = fit(training, counts, totals)
    state = cloudpickle.dumps((head[:, 0], head[:, 1], vocabulary, model))
    shared = docs.sparkSession.sparkContext.broadcast(state)  # bounded by HEAD and IDS
    end_log = float(np.log10(texts + 1.0))

    def run(frames):
        keep_memory()
        head, head_counts, vocabulary, model = cloudpickle.loads(shared.value)
        hasher, part, at = SpanHasher(), TaskContext.get().partitionId(), 0
        head_logs = np.concatenate([np.log10(head_counts + 1.0), [0.0]])  # the last is for words that aren't in it
        own_logs = np.concatenate([np.log(head_counts - vocabulary.discount), [0.0]])
        total_logs, unseen_logs = np.log(vocabulary.totals), np.log(vocabulary.unseen)
        for frame in frames:
            texts = [raw(t) for t in frame["text"]]
            for a, b in _chunks(texts, 1 << 20):
                words = Words(texts[a:b], hasher)
                cuts = words.cuts
                place = np.searchsorted(head, words.hashes)
                hit = np.concatenate([head, [-1]])[place] == words.hashes
                place[~hit] = len(head)
                logs = np.concatenate([[0.0], np.cumsum(head_logs[place])])
                known = np.concatenate([[0], np.cumsum(hit)])
                ids, others = vocabulary.encode(words.hashes, words.begins)
                within = np.zeros(len(ids))
                within[others] = own_logs[place[others]] - total_logs[ids[others]]
                rest = np.flatnonzero(~hit)
                triples, own = words.triples()
                spelled = np.concatenate([[0.0], np.cumsum(vocabulary.spelling[0][triples] + vocabulary.spelling[1][own])])
                lack = unseen_logs[ids[rest]] + spelled[words.ends[rest] + 1] - spelled[words.starts[rest]]  # as if it never occurred
                within[rest] += lack
                tokens, begins, places = words.with_ends(ids)
                chances = model.score(tokens, begins)
                chances[places] += within
                chance = np.concatenate([[0.0], np.cumsum(chances)])
                rest_cuts = np.searchsorted(rest, cuts)
                tails = [np.unique(words.hashes[rest[x:y]], return_index=True, return_counts=True) for x, y in zip(rest_cuts, rest_cuts[1:], strict=False)]
                yield pd.DataFrame(
                    {
                        "row": (part << 40) + at + np.arange(b - a),
                        "doc_id": frame["doc_id"].iloc[a:b].astype("Int64").to_numpy(),
                        "held_out": frame["held_out"].iloc[a:b].to_numpy(),
                        "n_tokens": np.diff(cuts) + 1,
                        "known": np.diff(known[cuts]),
                        "logs": np.diff(logs[cuts]),
                        "score": np.diff(chance[begins]) / np.log(10),
                        "keys": [k for k, _, _ in tails],
                        "lacks": [lack[x + i] for x, (_, i, _) in zip(rest_cuts, tails, strict=False)],
                        "counts": [n for _, _, n in tails],
                    }
                )
                at += b - a

    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double,"
        " keys array<long>, lacks array<double>, counts array<int>"
    )
    scored = written(rows.mapInPandas(run, schema))

    each = scored.select("row", F.explode(F.arrays_zip("keys", "lacks", "counts")).alias("t"))
    tails = each.select("row", F.col("t.keys").alias("key"), F.col("t.lacks").alias("lack"), F.col("t.counts").alias("times"))
    found = tails.join(counts.where(F.col("kind") == WORDS).select("key", "n"), "key")
    added = found.groupBy("row").agg(
        F.sum("times").alias("_known"),
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("_logs"),
        F.sum(F.col("times") * (F.log(F.col("n") - vocabulary.discount) - F.col("lack"))).alias("_gained"),  # it was scored as if it never occurred
    )
    whole = scored.join(added, "row", "left")
    base = F.col("logs") + F.coalesce("_logs", F.lit(0.0)) + F.lit(end_log) - F.col("n_tokens") * F.lit(float(np.log10(all_tokens + distinct + 1.0)))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0)) + F.lit(int(texts > 0))).cast("long").alias("n_known"),
        F.lit(int(all_tokens)).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("score") + F.coalesce("_gained", F.lit(0.0)) / F.lit(float(np.log(10)))).alias("score"),
    )
