"""Quality rules under weak supervision, with DataFrame functions only.

Each rule votes for a document, against it, or abstains. Expectation
maximisation over the counts of vote patterns estimates how often each rule is
right; the posterior probability of quality under these accuracies decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import WORD, body, written

#: Fixed by the task.
SYMBOLS, WINDOW = "#*$%&|<>", 8
FEW_WORDS, REPEATED_PERCENT = 20, 30
_SPACE = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))

#: A document is kept at this posterior probability or more.
KEEP_AT = 0.5
#: Rounds of estimation; the rates move less than a millionth in the last ones.
ROUNDS = 60


def _shifted(values: Column, step: int) -> Column:
    """Hashes of runs twice as long, from those of runs of ``step`` words."""
    n = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and, per row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_words_marked."""
    text = body()
    base = docs.select(*keep, text.alias("_text")).withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    counted = base.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.translate("_text", _SPACE, "")).cast("long"),
            "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
            "n_upper": (F.length("_text") - F.length(F.regexp_replace("_text", r"\p{Lu}", ""))).cast("long"),
            "n_letters": (F.length("_text") - F.length(F.regexp_replace("_text", r"\p{L}", ""))).cast("long"),
            "_lines": lines,
            "_one": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    )
    runs = counted.withColumn("_two", _shifted(F.col("_one"), 1)).withColumn("_four", _shifted(F.col("_two"), 2))
    runs = runs.withColumn("_eight", _shifted(F.col("_four"), 4))
    # Few documents repeat a window; only these are sorted. A window covers its words up to the start of the next one.
    places = F.array_sort(F.transform("_eight", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.filter(
        F.transform(
            F.col("_sorted"),
            lambda x, k: F.when(
                (F.get(F.col("_sorted"), k - 1)["h"] == x["h"]) | (F.get(F.col("_sorted"), k + 1)["h"] == x["h"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    repeats = F.size(F.array_distinct("_eight")) < F.size("_eight")
    found = runs.withColumn("_sorted", F.when(repeats, places)).withColumn("_at", F.array_sort(twice))
    covered = F.aggregate(
        F.col("_at"),
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    return found.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_upper",
        "n_letters",
        F.size("_lines").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < FEW_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """A vote (1 for the document, 0 against it, null: abstains) and what is believed of it before any data:
    how often it votes against good and against bad documents."""

    vote: Column
    against_good: float
    against_bad: float


def rules() -> dict[str, Rule]:
    per_word = F.col("n_symbols") / F.greatest(F.col("n_words"), F.lit(1))
    upper = F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1))
    length = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    repeated = F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1))
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols": Rule(F.when(per_word > 0.1, 0).when(per_word <= 0.02, 1), 0.01, 0.4),
        "upper": Rule(F.when(upper > 0.4, 0).when(upper <= 0.2, 1), 0.01, 0.4),
        "repeats": Rule(F.when(repeated > 0.3, 0).when(repeated <= 0.1, 1), 0.04, 0.4),
        "lines": Rule(F.when(lines > 0.4, 0).when(lines <= 0.1, 1), 0.04, 0.3),
        "word_length": Rule(F.when((length < 2) | (length > 20), 0).when((length >= 3) & (length <= 12), 1), 0.04, 0.3),
        "length": Rule(F.when(F.col("n_words") < FEW_WORDS, 0).when(F.col("n_words") >= 40, 1), 0.04, 0.3),
    }


def estimate(patterns: list[tuple[tuple[int | None, ...], int]], beliefs: list[tuple[float, float]]) -> dict[tuple, float]:
    """Posterior probability of quality for each pattern of votes, from the patterns' counts.

    Both classes are taken as equally likely beforehand. ``beliefs`` (votes
    against good, against bad) weigh as much as all data together, which keeps
    the classes from trading places and from splitting along one kind of junk.
    There are at most 3 to the number of rules patterns, however many documents;
    without any there are no posteriors.
    """
    if not patterns:
        return {}
    total = sum(count for _, count in patterns)
    rates = [list(b) for b in beliefs]
    posterior: dict[tuple, float] = {}
    for _ in range(ROUNDS):
        for votes, _count in patterns:
            odds = 0.0
            for (good, bad), vote in zip(rates, votes, strict=True):
                if vote is not None:
                    odds += math.log((1 - good) / (1 - bad)) if vote else math.log(good / bad)
            posterior[votes] = 1 / (1 + math.exp(-odds))
        for j, believed in enumerate(beliefs):
            for side, belief in enumerate(believed):
                share = lambda v: posterior[v] if side == 0 else 1 - posterior[v]
                voted = sum(share(v) * n for v, n in patterns if v[j] is not None)
                against = sum(share(v) * n for v, n in patterns if v[j] == 0)
                rates[j][side] = (against + total * belief) / (voted + total)
    return posterior


def judged(measured: DataFrame) -> DataFrame:
    """Adds base_failed, quality and kept to measured rows, which are read twice: for the counts and for the result."""
    named = rules()
    pattern = F.concat_ws(",", *(F.coalesce(rule.vote.cast("string"), F.lit("-")) for rule in named.values()))
    voted = measured.withColumns({"base_failed": base_failed(), "_votes": pattern})
    counted = sorted(voted.groupBy("_votes").count().collect())  # at most 3 ** len(named) rows
    read = lambda text: tuple(None if v == "-" else int(v) for v in text.split(","))
    beliefs = [(rule.against_good, rule.against_bad) for rule in named.values()]
    posterior = estimate([(read(r["_votes"]), r["count"]) for r in counted], beliefs)
    quality = F.lit(None).cast("double")
    if counted:
        quality = F.try_element_at(F.create_map(*(F.lit(x) for r in counted for x in (r["_votes"], posterior[read(r["_votes"])]))), F.col("_votes"))
    scored = voted.withColumn("quality", quality)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_AT)).drop("_votes")


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with its counts, the base rules' verdict, the posterior quality and whether it is kept.

    A null text counts as empty: no words, so the base rules reject it. Rows
    that share an id are judged one by one; other columns are left aside.
    """
    return judged(written(features(docs, ["doc_id"]))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are.

    The rows are written with their counts, once: the votes use each count
    several times, and a plan without that cut would work it out each time.
    """
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), "text")
    return judged(written(features(packed, ["_doc"]))).where("kept").select("_doc.*")
