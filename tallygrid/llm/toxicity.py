"""Toxicity by a learned lexicon, matched with misspellings and weighed by context.

Terms and stems that labelled toxic documents share form a trie. It is
intersected with Levenshtein automata into one deterministic automaton, which
all words of a batch walk in step. A hit counts by its term's log odds, by its
distance, and by its context window: hits between quotation marks apart from
the others, hits close together more. A logistic model of these few sums gives
the score.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.bpe import batches
from tallygrid.llm.common import remainder, written

#: Fixed by the task.
HELD_OUT, FOLDS, THRESHOLD = 2, 4, 0.3
#: Labelled rows that the lexicon and the weights are fitted on, those with the least hashes of doc_id.
FIT_ROWS = 20_000
#: A term occurs in at least so many toxic documents, and at most 1 in 10 of its documents is clean.
SUPPORT, PRECISION = 5, 0.9
#: Terms considered and taken at most; letters of stems; words to both sides of a hit that are its context.
CANDIDATES, TERMS, STEMS, CONTEXT = 20_000, 256, (4, 5, 6, 7), 10

_CORE = re.compile(r"[^\W_](?:[^\s]*[^\W_])?")
_LIMIT = 0x3000  # code points beyond it are one symbol
OPEN_QUOTES, CLOSE_QUOTES = "\"'“„«‘‚‹", "\"'”“»’›"


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool
    toxic: int
    clean: int


def edits(term: Term) -> int:
    """Misspellings that a term allows; short stems allow none, as too many words come near them."""
    n = len(term.text)
    return 0 if n < (7 if term.stem else 4) else 1 if n < 9 else 2


class Automaton:
    """The trie of the terms times the Levenshtein automata of their lengths, made deterministic.

    ``table[state, symbol]`` leads on; state 0 is dead. ``ends`` and ``stems``
    hold, per state, the best (distance, term) of a word that ends there and of
    a stem that has been read in full, as distance * TERMS + term, or -1.
    """

    def __init__(self, terms: list[Term]) -> None:
        self.terms = terms
        letters = sorted({c for t in terms for c in t.text})
        self.symbols = {c: i + 1 for i, c in enumerate(letters)}  # 0: any other
        children: list[dict[int, int]] = [{}]
        ends: dict[int, list[int]] = defaultdict(list)
        allowed = [0]
        for number, term in enumerate(terms):
            node = 0
            for c in term.text:
                allowed[node] = max(allowed[node], edits(term))
                node = children[node].setdefault(self.symbols[c], len(children))
                if node == len(children):
                    children.append({})
                    allowed.append(0)
            allowed[node] = max(allowed[node], edits(term))
            ends[node].append(number)

        def closed(places: dict[int, int]) -> frozenset:
            walk = list(places.items())
            while walk:  # a letter of the term is missing
                node, e = walk.pop()
                for child in children[node].values():
                    if e + 1 <= allowed[child] and places.get(child, 9) > e + 1:
                        places[child] = e + 1
                        walk.append((child, e + 1))
            return frozenset(places.items())

        def step(state: frozenset, symbol: int) -> frozenset:
            out: dict[int, int] = {}
            for node, e in state:
                if e + 1 <= allowed[node] and out.get(node, 9) > e + 1:  # a letter too many
                    out[node] = e + 1
                for c, child in children[node].items():
                    f = e + (c != symbol)
                    if f <= allowed[child] and out.get(child, 9) > f:
                        out[child] = f
            return closed(out)

        def best(state: frozenset, stem: bool) -> int:
            found = [e * TERMS + t for node, e in state for t in ends.get(node, ()) if terms[t].stem == stem and e <= edits(terms[t])]
            return min(found, default=-1)

        first = closed({0: 0})
        numbers, queue, rows = {frozenset(): 0, first: 1}, [frozenset(), first], []
        for state in queue:
            row = []
            for symbol in range(len(letters) + 1):
                target = step(state, symbol)
                if target not in numbers:
                    numbers[target] = len(queue)
                    queue.append(target)
                row.append(numbers[target])
            rows.append(row)
        self.table = np.array(rows, dtype=np.int32)
        self.ends = np.array([best(s, False) for s in queue], dtype=np.int32)
        self.stems = np.array([best(s, True) for s in queue], dtype=np.int32)

    def symbol_table(self) -> np.ndarray:
        out = np.zeros(_LIMIT + 1, dtype=np.int32)
        for c, i in self.symbols.items():
            for form in {c, c.upper()}:
                if len(form) == 1 and ord(form) < _LIMIT:
                    out[ord(form)] = i
        return out


class Matcher:
    def __init__(self, automaton: Automaton) -> None:
        self.auto, self.symbol = automaton, automaton.symbol_table()
        points = [chr(i) for i in range(_LIMIT + 1)]
        self.space = np.array([c in " \t\n\x0b\x0c\r" for c in points])
        self.letter = np.array([c.isalnum() for c in points])
        self.letter[_LIMIT] = True
        self.opens, self.closes = (np.array([c in marks for c in points]) for marks in (OPEN_QUOTES, CLOSE_QUOTES))

    def hits(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Per hit: text, term, distance, whether it is quoted, other hits in its context."""
        joined = "\n".join(texts)
        points = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), _LIMIT)
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        inside = np.zeros(len(points) + 2, dtype=np.int8)
        inside[1:-1] = ~self.space[points]
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        letters = np.flatnonzero(self.letter[points])
        if not len(letters) or not len(starts):
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
        low, high = np.searchsorted(letters, starts), np.searchsorted(letters, ends)
        core = high > low
        token = np.flatnonzero(core)
        at, stop = letters[low[core]], letters[high[core] - 1] + 1
        symbols = self.symbol[points]
        found = np.full(len(token), 1 << 30, dtype=np.int64)
        live, state = np.arange(len(token)), np.ones(len(token), dtype=np.int32)
        while len(live):
            state = self.auto.table[state, symbols[at[live]]]
            on = state > 0
            live, state = live[on], state[on]
            at[live] += 1
            stem = self.auto.stems[state]
            hit = stem >= 0
            found[live[hit]] = np.minimum(found[live[hit]], stem[hit])
            over = at[live] >= stop[live]
            word = self.auto.ends[state[over]]
            done = live[over]
            hit = word >= 0
            found[done[hit]] = np.minimum(found[done[hit]], word[hit])
            live, state = live[~over], state[~over]
        hit = np.flatnonzero(found < 1 << 30)
        token, best = token[hit], found[hit]
        text = np.searchsorted(offsets, starts[token], "right") - 1
        marks = [np.flatnonzero(m[points]) for m in (self.opens, self.closes)]
        before, after = starts[np.maximum(token - CONTEXT, 0)], ends[np.minimum(token + CONTEXT, len(ends) - 1)]
        before, after = np.maximum(before, offsets[text]), np.minimum(after, offsets[text + 1])
        opened = np.searchsorted(marks[0], starts[token] + 1) > np.searchsorted(marks[0], before)
        closed = np.searchsorted(marks[1], after) > np.searchsorted(marks[1], ends[token] - 1)
        near = np.searchsorted(starts[token], after) - np.searchsorted(starts[token], before) - 1
        return text, best % TERMS, best // TERMS, (opened & closed).astype(np.int64), near


def term_counts(rows: pd.DataFrame) -> pd.DataFrame:
    """(term, stem, toxic, clean): documents of either label with each word, and with each beginning of a longer word."""
    counts = (Counter(), Counter())
    for text, toxic in zip(rows["text"], rows["toxic"], strict=True):
        words = {m.lower() for m in _CORE.findall(text)}
        beginnings = {(w[:n], True) for w in words for n in STEMS if len(w) > n}
        counts[int(toxic)].update([(w, False) for w in words if 3 <= len(w) <= 24])
        counts[int(toxic)].update(beginnings)
    keys = list(set(counts[0]) | set(counts[1]))
    return pd.DataFrame(
        {"term": [k[0] for k in keys], "stem": [k[1] for k in keys], "toxic": [counts[1][k] for k in keys], "clean": [counts[0][k] for k in keys]}
    )


def lexicon(counted: list[Term]) -> list[Term]:
    """The terms to match: a stem where many different words share it, else the words; none within a chosen stem."""
    by_stem: dict[str, int] = defaultdict(int)
    for t in counted:
        if not t.stem:
            for n in STEMS:
                if len(t.text) >= n:
                    by_stem[t.text[:n]] = max(by_stem[t.text[:n]], t.toxic)
    chosen: list[Term] = []
    stems: set[str] = set()
    inside = lambda text: any(text[:n] in stems for n in STEMS)
    for t in sorted((t for t in counted if t.stem), key=lambda t: (len(t.text), -t.toxic, t.text)):
        if t.toxic >= 2 * max(by_stem[t.text], SUPPORT) and not inside(t.text):
            chosen.append(t)
            stems.add(t.text)
    chosen += [t for t in counted if not t.stem and not inside(t.text)]
    return sorted(chosen, key=lambda t: (-t.toxic, t.text, t.stem))[:TERMS]


def weights(terms: list[Term], near: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log odds of each term by distance (0, 1, 2). ``near``: clean documents with a misspelling of it.

    A misspelling that no clean document holds is trusted nearly as the term itself.
    """
    out = np.zeros((len(terms), 3))
    for i, t in enumerate(terms):
        own = np.log((t.toxic + 0.5) / (n_toxic + 1)) - np.log((t.clean + 0.5) / (n_clean + 1))
        out[i, 0] = max(own, 0.0)
        for e in (1, 2):
            toxic, clean = near[i, e]
            odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
            out[i, e] = 0.8 * out[i, 0] if not clean else max(min(odds, out[i, 0]), 0.0)
    return out


def features(matcher: Matcher, weight: np.ndarray, texts: list[str]) -> np.ndarray:
    """Per text: best and summed context scores of free hits, and of quoted ones."""
    out = np.zeros((len(texts), 4))
    for a, b in batches(texts):
        text, term, distance, quoted, near = matcher.hits(texts[a:b])
        score = weight[term, distance] * (1 + 0.25 * np.log1p(near))
        part = out[a:b]
        for column, side in ((0, quoted == 0), (2, quoted == 1)):
            np.maximum.at(part[:, column], text[side], score[side])
            np.add.at(part[:, column + 1], text[side], score[side])
        part[:, 1::2] = np.log1p(part[:, 1::2])
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients, the intercept last, by Newton steps; the ridge leaves the intercept alone."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    c = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ c)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ c)
        c -= step
        if np.abs(step).max() < 1e-8:
            break
    return c


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    automaton: Automaton | None
    weight: np.ndarray
    coefficients: np.ndarray

    def scorer(self):
        matcher = Matcher(self.automaton) if self.automaton else None

        def score(texts: list[str]) -> np.ndarray:
            x = features(matcher, self.weight, texts) if matcher else np.zeros((len(texts), 4))
            return sigmoid(x @ self.coefficients[:-1] + self.coefficients[-1])

        return score


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic): FIT_ROWS labelled documents at most, outside the held-out fold. Several labels of one id: toxic if any is."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", FOLDS) != HELD_OUT))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(FIT_ROWS)
    )
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return own.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "toxic")  # FIT_ROWS rows at most


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = written(training_rows(docs, labels))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    prior = np.log((n_toxic + 0.5) / (n_clean + 0.5)) if n else -3.0
    nothing = Model(None, np.zeros((1, 3)), np.array([0, 0, 0, 0, prior]))
    if not n_toxic or not n_clean:
        return nothing
    counts = rows.mapInPandas(lambda frames: (term_counts(f) for f in frames), "term string, stem boolean, toxic int, clean int")
    summed = counts.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    telling = summed.where((F.col("toxic") >= SUPPORT) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean"))))
    top = telling.orderBy(F.desc("toxic"), "term", "stem").limit(CANDIDATES).collect()
    terms = lexicon([Term(r["term"], r["stem"], r["toxic"], r["clean"]) for r in top])
    if not terms:
        return nothing
    automaton = Automaton(terms)

    def misspelt(frames):
        matcher = Matcher(automaton)
        for frame in frames:
            texts, toxic = frame["text"].tolist(), frame["toxic"].to_numpy()
            for a, b in batches(texts):
                text, term, distance, _, _ = matcher.hits(texts[a:b])
                seen = np.unique(np.column_stack([text, term, distance])[distance > 0], axis=0)
                yield pd.DataFrame({"term": seen[:, 1], "distance": seen[:, 2], "toxic": toxic[a:b][seen[:, 0]]})

    near = np.zeros((len(terms), 3, 2), dtype=np.int64)
    found = rows.mapInPandas(misspelt, "term int, distance int, toxic int").groupBy("term", "distance", "toxic").count()
    for r in found.collect():  # at most 4 * TERMS rows
        near[r["term"], r["distance"], 1 - min(r["toxic"], 1)] = r["count"]
    weight = weights(terms, near, n_toxic, n_clean)

    def measured(frames):
        matcher = Matcher(automaton)
        for frame in frames:
            x = features(matcher, weight, frame["text"].tolist())
            yield pd.DataFrame(x, columns=list("abcd")).assign(toxic=frame["toxic"].to_numpy())

    table = rows.mapInPandas(measured, "a double, b double, c double, d double, toxic int").toPandas()  # FIT_ROWS rows at most
    table = table.sort_values(list(table.columns))
    return Model(automaton, weight, logistic(table[list("abcd")].to_numpy(), table["toxic"].to_numpy(dtype=float)))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1) and predicted.

    Only texts are scored; a null text is empty. Without labels of both kinds
    every score is the labels' prior. Other columns are left aside.
    """
    model = fit(docs, labels)

    def run(frames):
        score = model.scorer()
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "held_out": frame["held_out"], "score": score(frame["text"].tolist())})

    rows = docs.select("doc_id", (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    scored = rows.mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
