import math
import os
import random
import resource
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrid.llm import attention, common, forest, huffman, lmscore, mixing, ngramjoin, quality, repeats, sharding, spm, textnum, tokenstore, toxicity
from tallygrid.llm.bpe import Encoder
from tallygrid.llm.components import components
from tallygrid.llm.suffix import Shard
import llm_brute as brute


def near_copies(n, seed=3):
    """Families of edited copies, exact copies, shared passages, and texts of their own."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(70)]
    families = [[word() for _ in range(rng.randint(30, 160))] for _ in range(8)]
    rows = []
    for i in range(n):
        own = list(rng.choice(families)) if rng.random() < 0.6 else [word() for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = word()
        if rng.random() < 0.3:
            at = rng.randrange(len(own))
            own[at:at] = passage
        rows.append((i, " ".join(own)))
    return rows


# quality rules


def test_quality_counts(docs_of, awkward):
    got = quality.quality_rules(docs_of(awkward)).collect()
    want = sorted((r[0] is None, r[0], *brute.quality_counts(r[1])) for r in awkward if r[0] is not None)
    cells = sorted((r.doc_id is None, r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got if r.doc_id is not None)
    assert cells == want and len(got) == len(awkward)
    assert not any(r.kept for r in got if r.base_failed)


def test_quality_verdicts(docs_of):
    rng = random.Random(1)
    prose = lambda: ". ".join(" ".join(rng.choice(["river", "stone", "walks", "under", "green", "sky", "slowly"]) + str(rng.randrange(99)) for _ in range(12)) for _ in range(5))
    rows = [(i, prose()) for i in range(80)]
    rows += [(100 + i, prose().replace(" ", "*** ")) for i in range(6)] + [(200 + i, prose().upper()) for i in range(6)]
    kept = {r.doc_id for r in quality.quality_rules(docs_of(rows)).where("kept").collect()}
    assert kept == set(range(80))
    assert {r.doc_id for r in quality.keep_good(docs_of(rows)).collect()} == kept


def test_estimation_follows_agreement():
    beliefs = [(0.04, 0.3)] * 3
    counts = [((1, 1, 1), 900), ((0, 0, 1), 60), ((1, 1, 0), 40)]
    posterior = quality.estimate(counts, beliefs)
    assert posterior[(0, 0, 1)] < 0.1 < 0.5 < posterior[(1, 1, 1)]


def test_plan_is_native(spark, small):
    plan = quality.features(spark.read.parquet(f"{small}/documents.parquet"), ["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


# mixing


def test_mix_against_water_filling(docs_of, awkward):
    rng = random.Random(2)
    rows = awkward + [(100 + i, "w " * rng.randint(1, 40), rng.choice(["a", "b", "hot", "hot", None])) for i in range(300)]
    got = mixing.mix_counts(docs_of(rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2] if len(r) > 2 else "s"] += len(brute.words(r[1]))
    want = brute.targets(sizes)
    assert {(r.source_size, round(r.target, 6)) for r in got} == {(sizes[s], round(want[s], 6)) for s in sizes}
    by_source = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_source[(r.source_size, r.target)] += r.taken
    assert sum(by_source.values()) == pytest.approx(1.5 * sum(sizes.values()), abs=len(sizes))
    assert Counter(got) == Counter(mixing.mix_counts(docs_of(rows[::-1])).collect())


def test_mix_is_in_order_and_agrees(docs_of):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 3 == 0]) for i in range(60)]
    items = mixing.mix(docs_of(rows)).collect()
    assert [r.finish for r in items] == sorted(r.finish for r in items)
    taken = Counter()
    for r in items:
        taken[r.doc_id] += r.words
    assert dict(taken) == {r.doc_id: r.taken for r in mixing.mix_counts(docs_of(rows)).collect() if r.taken}


def test_mix_counts_come_from_the_served_queue(docs_of, monkeypatch):
    """Counts are those of the stored queue: a queue that serves first copies only takes no document twice."""
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(60)] + [(3, "w", "a"), (3, "w", "a"), (4, None, "a"), (4, "", "a")]
    whole = {(r.doc_id, r.size): r.taken for r in mixing.mix_counts(docs_of(rows)).collect()}
    assert any(taken > size for (_, size), taken in whole.items())
    serve = mixing.serve
    monkeypatch.setattr(mixing, "serve", lambda queue: serve(queue).where("copy = 0"))
    once = mixing.mix_counts(docs_of(rows)).collect()
    assert len(once) == len(rows) and any(r.taken for r in once) and all(r.taken <= r.size for r in once)


# sharding


def test_shards(docs_of, awkward):
    rows = awkward + [(1000 + i, f"text {i}") for i in range(2000)]
    got = sharding.shard_documents(docs_of(rows), 24).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 20 < sum(r.grown_shard == 24 for r in got) < 160
    texts = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == texts


def test_weights_move_rows_only_into_their_subtree(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    before = sharding.even_tree(24)
    after = tuple(sharding.Shard(s.number, s.region, s.rack, 3.0 if s.number == 5 else 1.0) for s in before)
    rows = sharding.place(sharding.place(ids, "doc_id", before, "a"), "doc_id", after, "b").collect()
    assert {r.b for r in rows if r.a != r.b} == {5}
    assert 3 * 4000 / 26 * 0.8 < sum(r.b == 5 for r in rows) < 3 * 4000 / 26 * 1.2


# n-gram join


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_join_against_all_pairs(docs_of, k, percent):
    rows = near_copies(140)
    got = ngramjoin.similarity_components(docs_of(rows), k, percent).collect()
    want = brute.components(rows, k, percent)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(brute.shingle_set(t, k)) for i, t in rows}
    kept = {r.doc_id for r in ngramjoin.keep_one(docs_of(rows), k, percent).collect()}
    assert kept == set(want.values())


@pytest.mark.parametrize("paired", [1, 3, 16])
def test_join_of_large_groups_in_small_blocks(docs_of, monkeypatch, paired):
    monkeypatch.setattr(ngramjoin, "BLOCK", 4)
    monkeypatch.setattr(ngramjoin, "PAIRED", paired)
    rows = near_copies(120, seed=9)
    got = {r.doc_id: r.component_id for r in ngramjoin.similarity_components(docs_of(rows), 4, 85).collect()}
    assert got == brute.components(rows, 4, 85)


@pytest.mark.parametrize("order", ["reversed", "shuffled"])
def test_join_of_rows_in_any_order(docs_of, order):
    rows = near_copies(140)
    want = brute.components(rows, 5, 80)
    rows = rows[::-1] if order == "reversed" else random.Random(8).sample(rows, len(rows))
    docs = docs_of(rows).coalesce(1)
    got = {r.doc_id: r.component_id for r in ngramjoin.similarity_components(docs, 5, 80).collect()}
    assert got == want
    assert {r.doc_id for r in ngramjoin.keep_one(docs, 5, 80).collect()} == set(want.values())


def test_join_of_awkward_rows(docs_of, awkward):
    got = ngramjoin.similarity_components(docs_of(awkward), 4, 85).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in awkward)
    assert all(r.component_id == r.doc_id for r in got)
    kept = ngramjoin.keep_one(docs_of(awkward), 4, 85)
    want = {(r[0], r[1]) for r in awkward if r[0] is not None}
    assert Counter((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == Counter(want)
    assert kept.where("doc_id is null").count() == 2 and kept.columns == docs_of(awkward).columns


def test_what_an_operator_staged_for_itself_goes(docs_of, awkward, spark, monkeypatch):
    paths = []
    shared = common.shared_folder
    monkeypatch.setattr(common, "shared_folder", lambda s: paths.append(shared(s)) or paths[-1])
    standing = lambda: [p for p in paths if os.path.exists(p.removeprefix("file:"))]
    docs = docs_of(near_copies(60))
    kept = ngramjoin.keep_one(docs, 5, 80)
    assert len(paths) > 12 and len(standing()) <= 4  # sizes, classes, components and marks
    assert kept.count() == len(set(brute.components(near_copies(60), 5, 80).values()))
    paths.clear()
    left = repeats.without_repeats(docs_of(awkward), 51)
    assert len(paths) > 7 and len(standing()) <= 3  # spans of bytes, of words, and of both
    assert left.count() > 0


def test_the_sides_of_a_filter_are_all_rows(docs_of, awkward):
    docs = docs_of(awkward)
    keys = docs.where("doc_id in (6, 10)").select("doc_id")
    near, apart = (side(docs, keys, "doc_id") for side in (common.maybe_in, common.surely_not_in))
    whole = lambda frame: Counter((r.doc_id, r.text) for r in frame.collect())
    assert whole(near) + whole(apart) == whole(docs) and near.columns == apart.columns == docs.columns
    assert near.where("doc_id in (6, 10)").count() == 4 and apart.where("doc_id in (6, 10)").count() == 0
    assert whole(common.surely_not_in(docs, keys.where("doc_id < 0"), "doc_id")) == whole(docs)


def test_prefix_tree_against_scan():
    rng = np.random.default_rng(4)
    base = np.arange(60)
    sets = [np.unique(np.concatenate([rng.choice(base, 40, replace=False), rng.integers(60, 90, 4)])) for _ in range(40)]
    tree = ngramjoin.PrefixTree(sets)
    for probe in sets:
        mask = np.zeros(100, dtype=bool)
        mask[probe] = True
        inter = [len(np.intersect1d(probe, s)) for s in sets]
        want = {i for i, s in enumerate(sets) if 100 * inter[i] >= 60 * (len(probe) + len(s) - inter[i])}
        assert set(tree.similar(probe, mask, 60)) == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (5, 5)], "u long, v long")
    assert {(r.u, r.v) for r in components(edges).collect()} == {(i, 0) for i in range(1, 41)} | {(100, 90)}
    assert components(edges.where("u < 0")).count() == 0


# repeated strings


def test_suffix_array_against_counts():
    rng = random.Random(3)
    for _ in range(40):
        base = bytes(rng.choice(b"ab") for _ in range(60))
        strings = [base[rng.randint(0, 20) : rng.randint(30, 60)] for _ in range(rng.randint(1, 10))]
        shard = Shard(strings, 9)
        found, times = shard.repeated(), Counter(s[i : i + 9] for s in strings for i in range(len(s) - 8))
        for s, at in zip(strings, shard.starts, strict=True):
            assert [bool(found[at + i]) for i in range(len(s))] == [times[s[i : i + 9]] > 1 and i + 9 <= len(s) for i in range(len(s))]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 3000])
def test_repeats_against_counts(docs_of, awkward, monkeypatch, shard_bytes):
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard_bytes)
    rows = [r for r in awkward if r[0] != 7] + near_copies(70, seed=5)
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    rows.append((0, rows[0][1]))
    got = Counter(tuple(r) for r in repeats.repeats_removed(docs_of(rows)).collect())
    flags = brute.covered([r[1] for r in rows], 400)
    assert got == Counter((r[0], *brute.without(r[1], f)) for r, f in zip(rows, flags, strict=True))


def test_texts_without_repeats(docs_of):
    rows = near_copies(40, seed=6) + [(900, "é" * 500), (901, "x" + "é" * 450), (902, None), (903, "")]
    flags = brute.covered([t for _, t in rows], 400)
    want = {}
    for (i, t), f in zip(rows, flags, strict=True):
        left = bytes(b for b, x in zip((t or "").encode(), f, strict=True) if not x).decode("utf-8", "ignore")
        if left or not any(f):
            want[i] = (left if any(f) else t)
    got = {r.doc_id: (r.text, r.n_chars) for r in repeats.without_repeats(docs_of(rows)).collect()}
    assert got == {i: (t, None if t is None else len(t)) for i, t in want.items()}


def test_passages_of_51_words_go(spark, docs_of):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    own = lambda n: [word() for _ in range(n)]
    passage, short = own(51), own(50)  # 305 and 299 bytes
    parts = [(own(30), own(20)) for _ in range(4)]
    rows = [(i, " ".join([*a, *(passage if i < 2 else short), *b])) for i, (a, b) in enumerate(parts)]
    got = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs_of(rows), "").collect()}
    assert got == {i: " ".join(a) + "  " + " ".join(b) if i < 2 else rows[i][1] for i, (a, b) in enumerate(parts)}


# token files


def test_huffman_blocks():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.2, 30_000), 40_000).astype(np.int64)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=1 << 16))
    used = lengths[lengths > 0].astype(float)
    assert used.max() <= huffman.LIMIT and (2.0**-used).sum() <= 1
    bits, checkpoints = huffman.encode_block(ids, lengths, huffman.codes(lengths))
    table = huffman.decode_table(lengths)
    assert (huffman.decode_block(bits, len(ids), checkpoints, *table) == ids).all()
    some = checkpoints[3:5] - 8 * (checkpoints[3] // 8)
    assert (huffman.decode_block(bits[checkpoints[3] // 8 :], 2 * huffman.STRIDE, some, *table) == ids[3 * huffman.STRIDE : 5 * huffman.STRIDE]).all()
    shares = np.bincount(ids)[np.unique(ids)] / len(ids)
    assert len(bits) * 8 / len(ids) < -(shares * np.log2(shares)).sum() + 0.2


def test_huffman_of_few_symbols():
    for counts in ([0, 5, 0], [1, 1], [1, 2, 4, 8, 16, 32]):
        lengths = huffman.code_lengths(np.array(counts))
        ids = np.repeat(np.arange(len(counts)), counts)
        bits, at = huffman.encode_block(ids, lengths, huffman.codes(lengths))
        assert (huffman.decode_block(bits, len(ids), at, *huffman.decode_table(lengths)) == ids).all()


def test_encoder_agrees_with_the_library(vocabularies):
    own = Encoder(vocabularies["byte_bpe_50k.json"])
    rng = random.Random(5)
    parts = ["a", "the", "é", "漢", "1", "'s", "!", "  ", " ", "\n", "\n\n", "\t", "\x85", "<|endoftext|>", "😀", ".", ",", "Ab", "don't", "\r\n", "_", " \n", "²"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert np.frombuffer(own([text])[0], "<u2").tolist() == own.known.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_before_marks_are_encoded_as_words(vocabularies, monkeypatch):
    own, wholes = Encoder(vocabularies["byte_bpe_50k.json"]), []
    whole = own.known.whole
    monkeypatch.setattr(own.known, "whole", lambda text: wholes.append(text) or whole(text))
    text = "Gar nicht&&& lang!! \u00e9t\u00e9??? don't l'eau' ''a .b c1; d--"
    assert own([text])[0] == whole(text)
    assert set(wholes) == {"&&&", "!!", "???", " don't", " l'eau'", " ''a", " .b", " c1;", "--"}


def test_token_files(docs_of, awkward, vocabularies):
    path = vocabularies["byte_bpe_50k.json"]
    got = tokenstore.stored_tokens(docs_of(awkward), path).collect()
    tokenizer = Encoder(path).known.tokenizer
    want = [(r[0], np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")) for r in awkward]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in want)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r[0] for r in awkward), key=lambda i: (i is not None, i))
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]


# SentencePiece


def test_viterbi_and_round_trip(vocabularies):
    codec = spm.Codec(spm.Pieces.load(vocabularies["piece_bpe_32k.model"]))
    pieces, rng = codec.pieces, random.Random(1)
    score = {pieces.texts[i]: pieces.scores[i] for i in pieces.normal}
    parts = ["a", "b", "the", "é", "▁", "漢", "😀", "  ", " ", "\n", " hello", "ing", "\x00", "er", "<s>", "<0x41>"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        ids = codec.encode(text).tolist()
        assert codec.decode(ids) == text
        chars = ["\uffff" if c == "▁" else "▁" if c == " " else c for c in (" " + text if text else "")]
        best = [0.0] + [-math.inf] * len(chars)
        for i in range(len(chars)):
            for j in range(i + 1, min(len(chars), i + 20) + 1):
                own = score.get("".join(chars[i:j]), codec.unknown if j == i + 1 else -math.inf)
                best[j] = max(best[j], best[i] + own)
        plain = [i for i in ids if i not in set(pieces.byte_ids)]
        spelled = bytes(pieces.byte_ids.index(i) for i in ids if i in set(pieces.byte_ids)).decode()
        assert sum(pieces.scores[i] for i in plain) + codec.unknown * len(spelled) == pytest.approx(best[-1])


def test_coded_documents(docs_of, awkward, vocabularies):
    path = vocabularies["piece_bpe_32k.model"]
    got = spm.round_trips(docs_of(awkward), path).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in awkward) and all(r.exact for r in got)
    back = spm.decode(spm.encode(docs_of(awkward), path), path).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r[0], r[1] or "") for r in awkward)


# nearest neighbours


def test_nearest_against_scan(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(700, 12)).astype(np.float32)
    vectors[300:340] = vectors[5]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(800, None), (900, []), (1000, [0.0] * 12), (1100, [float("nan")] * 12), (1200, [None] * 12), (1300, [float("inf")] * 12), (None, [1.0] * 12), (0, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS q", "'x' AS ids", "2 AS cls")
    got = defaultdict(list)
    for r in sorted(forest.nearest(frame).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    exact = vectors.astype(np.float64)
    assert set(got) == set(range(0, 700, 100))
    for q, found in got.items():
        d = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(700), d)) if i != q][:10]
        assert [v for v, _ in found] == order and np.allclose([s for _, s in found], d[order], rtol=0, atol=1e-12)


def test_nearest_of_few(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0, 2.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in forest.nearest(frame).collect()] == [(0, 1, 3)]
    assert forest.nearest(frame.where("vec_id < 0")).count() == 0


def test_forest_recall():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(30_000, 64)).astype(np.float32)
    own = forest.Forest(vectors)
    hits = 0
    for q, (near, _) in zip(range(20), own.nearest(vectors[:20], np.arange(30_000), 11), strict=True):
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        hits += len(set(near) & set(np.argsort(d)[:11]))
    assert hits >= 0.9 * 220


# toxicity


def test_automaton_against_distances():
    terms = [toxicity.Term(t, s, 9, 0) for t, s in (("idiot", False), ("worthless", False), ("bad", False), ("verstoss", True))]
    matcher = toxicity.Matcher(toxicity.Automaton(terms))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(0)
    for _ in range(600):
        word = list(rng.choice(terms).text + rng.choice(["", "", "en", "x"]))
        for _ in range(rng.randint(0, 3)):
            word[rng.randrange(len(word))] = rng.choice(["", "q", "i", "ss", "e"])
        word = "".join(word) or "q"
        hits = {(int(d), int(t)) for _, t, d, _, _ in zip(*matcher.hits([word]), strict=True)}
        want = []
        for i, t in enumerate(terms):
            near = min(distance(word[:n], t.text) for n in range(len(word) + 1)) if t.stem else distance(word, t.text)
            if near <= toxicity.edits(t):
                want.append((near, i))
        assert hits == ({min(want)} if want else set()), word


def test_context_tells_quotes(docs_of):
    matcher = toxicity.Matcher(toxicity.Automaton([toxicity.Term("idiot", False, 9, 0)]))
    text, _, distance, quoted, near = matcher.hits(['She said "you idiot" and left', "you Idiot, you IDIOT!", "nothing", "", "an id1ot"])
    assert text.tolist() == [0, 1, 1, 4] and distance.tolist() == [0, 0, 0, 1]
    assert quoted.tolist() == [1, 0, 0, 0] and near.tolist() == [0, 1, 1, 0]


def test_toxicity_learns(docs_of, spark, awkward):
    rng = random.Random(1)
    plain = lambda: [rng.choice(["river", "stone", "walks", "under", "green", "slowly", "morning"]) for _ in range(30)]
    rows, labels = [], []
    for i in range(400):
        text, bad = plain(), i % 5 == 0
        if bad:
            text[rng.randrange(30)] = rng.choice(["grobian", "schuft"])
        rows.append((100 + i, " ".join(text)))
        labels.append((100 + i, 1, int(bad)))
    rows += [(900, "under the grobiam stone"), *awkward]
    given = spark.createDataFrame(labels + [(None, 1, 1), (100, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs_of(rows), given).collect()}
    assert all((got[i].predicted == 1) == bool(t) for i, _, t in labels)
    assert got[900].predicted == 1 and got[2].predicted == 0
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items() if i is not None)
    none = toxicity.toxicity(docs_of(rows), given.where("toxic is null")).collect()
    assert len(none) == len(rows) and len({r.score for r in none}) == 1


# language model


def test_every_subword_is_scored_once():
    words = lmscore.Words([b"Hello  wOrld ab\n", b"", b"  ", b"x " * 700], lmscore.SpanHasher())
    found, begins, places = words.with_ends(np.full(703, attention.FIRST))
    assert begins.tolist() == [0, 4, 5, 6, 707] and (found == attention.END).sum() == 4 and (found[places] == attention.FIRST).all()
    assert [int(x).to_bytes(3, "big") for x in words.begins[:3]] == [b"hel", b"wor", b"ab\0"]
    firsts, sizes, context = attention.windows(begins)
    seen = np.zeros(len(found), dtype=int)
    np.add.at(seen, np.repeat(firsts, sizes) + attention._counter(sizes), 1)
    assert (seen == 1).all() and (sizes + context <= attention.WINDOW).all()


def test_spelling_is_a_distribution():
    rng = np.random.default_rng(3)
    classes, members = lmscore.spelling_of(rng.integers(0, 3, lmscore.CLASSES**3).astype(float), rng.integers(0, 9, 256).astype(float))
    assert np.allclose(np.exp(classes).reshape(-1, lmscore.CLASSES).sum(axis=1), 1)
    assert np.allclose(np.bincount(lmscore._CLASSES, np.exp(members), lmscore.CLASSES)[np.unique(lmscore._CLASSES)], 1)


def test_chances_of_words_sum_to_one(spark):
    """Of one id: the rests of words that occur, and the part left to words that don't."""
    text = " ".join(f"ab{chr(97 + i)}" for i in range(26) for _ in range(i + 1))
    counts = lmscore.corpus_counts(spark.createDataFrame([(1, text), (2, "abz abc")], "doc_id long, text string"))
    no_common = [(1, 2)]
    vocabulary = attention.Vocabulary.of(no_common, [], (353, 26), 2, 0.5, lmscore.spelling_of(np.zeros(lmscore.CLASSES**3), np.zeros(256)))
    n = np.array([r["n"] for r in counts.where(F.col("kind") == lmscore.WORDS).collect()])
    assert n.sum() == 353 and len(n) == 26
    assert ((n - 0.5).sum() + vocabulary.unseen[attention.RARE]) / vocabulary.totals[attention.RARE] == pytest.approx(1)


def test_words_are_counted_in_small_pieces(spark, monkeypatch):
    texts = [(i, f"alpha beta{i % 5} Gamma alpha \u00e9t\u00e9 {i}") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    want = sorted(map(tuple, lmscore.corpus_counts(docs).collect()))
    monkeypatch.setattr(lmscore, "COUNTED", 500)
    monkeypatch.setattr(lmscore, "SUMMED", 3)
    assert sorted(map(tuple, lmscore.corpus_counts(docs).collect())) == want
    assert sum(n for kind, _, n, _ in want if kind == lmscore.WORDS) == 300 * 6
    triples, own = lmscore.Words([b"abc d"], lmscore.SpanHasher()).triples()
    assert triples.dtype.itemsize <= 4 and own.dtype.itemsize == 1


def test_attention_is_causal_and_proper():
    rng = np.random.default_rng(0)
    model = attention.Attention.fresh(rng.integers(0, 50, attention.IDS).astype(float))
    ids = rng.integers(0, attention.IDS, (2, 20))
    states = model.states(ids)
    assert np.allclose(states, model.hidden(ids)[0].reshape(-1, attention.WIDTH), atol=1e-4)
    changed = ids.copy()
    changed[:, 12:] = 7
    assert np.allclose(states.reshape(2, 20, -1)[:, :12], model.states(changed).reshape(2, 20, -1)[:, :12], atol=1e-5)
    chances = model.log_chances(np.repeat(states[:1], attention.IDS, axis=0), np.arange(attention.IDS))
    assert np.exp(chances).sum() == pytest.approx(1, abs=1e-3)


def test_gradients():
    rng = np.random.default_rng(1)
    model = attention.Attention.fresh(np.ones(attention.IDS))
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, y, used = rng.integers(0, attention.IDS, (2, 9)), rng.integers(0, attention.IDS, (2, 9)), np.ones((2, 9), dtype=bool)
    _, gradient = model.step(x, y, used)
    for name, w in model.weights.items():
        at = np.unravel_index(np.argmax(np.abs(gradient[name])), w.shape)
        w[at] += 1e-4
        up = model.step(x, y, used)[0]
        w[at] -= 2e-4
        down = model.step(x, y, used)[0]
        w[at] += 1e-4
        assert gradient[name][at] == pytest.approx((up - down) / 2e-4, rel=1e-3)


def test_a_step_needs_no_small_values():
    """Large scores and logits neither overflow nor vanish, and the chances still sum to one."""
    rng = np.random.default_rng(2)
    model = attention.Attention.fresh(np.ones(attention.IDS))
    for name in ("qkv", "group"):
        model.weights[name] *= 200
    ids, used = rng.integers(0, attention.IDS, (3, 20)), np.ones((3, 20), dtype=bool)
    _, parts = model.hidden(ids)
    assert parts["parts"][3].max() <= 1 and np.isfinite(parts["seen"]).all()
    loss, gradient = model.step(ids, ids[:, ::-1], used)
    assert np.isfinite(loss) and all(np.isfinite(x).all() for x in gradient.values())
    assert gradient["group_bias"].sum() == pytest.approx(0, abs=1e-4)


def test_a_step_faults_in_no_memory():
    """Arrays of a step take what the last step gave back, instead of new pages of the system."""
    rng = np.random.default_rng(6)
    textnum.keep_memory()
    trainer = attention.Trainer(attention.Attention.fresh(np.ones(attention.IDS)), 0.01)
    x, y, used = rng.integers(0, attention.IDS, (128, 48)), rng.integers(0, attention.IDS, (128, 48)), np.ones((128, 48), dtype=bool)
    for _ in range(3):
        trainer._step(x, y, used)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    for _ in range(10):
        trainer._step(x, y, used)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before < 2000


def test_moves_are_passed_on_by_deals_not_by_partitions(spark, docs_of, monkeypatch):
    """However many partitions rows are dealt into, each deal passes its moves on once, and the model is the same."""
    rows = [r for r in near_copies(40) if r[1]]
    monkeypatch.setattr(lmscore, "DEAL", 2000)

    def learned(least):
        moved, frame = [], type(spark.range(0))
        mapped = frame.mapInPandas

        def seen(self, run, schema, *a):
            out = mapped(self, run, schema, *a)
            if "move" not in out.columns:
                return out
            moved.append(lmscore.written(out))
            return moved[-1]

        with monkeypatch.context() as patch:
            for name in ("repartition", "repartitionByRange"):
                plain = getattr(frame, name)
                patch.setattr(frame, name, lambda self, n, *cols, plain=plain: plain(self, max(n, least) if cols and isinstance(n, int) else n, *cols))
            patch.setattr(frame, "mapInPandas", seen)
            docs = docs_of(rows)
            counts = lmscore.corpus_counts(docs)
            totals = {r["kind"]: (r["n"], r["keys"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("keys")).collect()}
            weights = lmscore.fit(docs, counts, totals)[1].flat()
        times = moved[0].groupBy("weight").count().agg(F.max("count")).first()[0]
        return weights, times, -(-(totals[lmscore.WORDS][0] + totals[lmscore.TEXTS][0]) // 2000)

    few, times, deals = learned(1)
    many, more, _ = learned(60)
    assert times <= deals and more <= deals and deals > 1
    assert np.array_equal(few, many)


def test_scores(docs_of, awkward, monkeypatch):
    monkeypatch.setattr(lmscore, "COMMON", 4)
    monkeypatch.setattr(lmscore, "HEAD", 5)
    rows = awkward + near_copies(30)
    got = lmscore.scores(docs_of(rows)).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    train = [r[1] for r in rows if not held(r[0])]
    want = Counter((r[0], held(r[0]), *brute.unigram(train, r[1])[:3], round(brute.unigram(train, r[1])[3], 4)) for r in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)


@pytest.mark.parametrize("parts", [1, 5])
def test_scores_need_no_cap_and_no_layout(docs_of, monkeypatch, parts):
    """Words beyond HEAD are joined, and rows learn the same however they are dealt to files."""
    rows = near_copies(40) + [(7000 + i, " ".join(f"w{i * j % 97}x{j}" for j in range(50))) for i in range(20)]
    score = lambda docs: {r.doc_id: r.score for r in lmscore.scores(docs).collect()}
    monkeypatch.setattr(lmscore, "DEAL", 2000)
    monkeypatch.setattr(lmscore, "COMMON", 4)
    whole = score(docs_of(rows).coalesce(1))
    monkeypatch.setattr(lmscore, "HEAD", 5)
    assert score(docs_of(rows[::-1]).repartition(parts)) == pytest.approx(whole, rel=1e-5)


def test_language_model_learns_from_every_window(spark, monkeypatch):
    rng = random.Random(4)
    names = [f"{a}{b}{c}" for a in "abcdef" for b in "aeiou" for c in "lmn"]
    cycle = " ".join(rng.sample(names, 60))
    long = " ".join([cycle] * 400)  # beyond 65,536 bytes
    docs = spark.createDataFrame([(0, long)], "doc_id long, text string")
    counts = lmscore.corpus_counts(docs)
    totals = {r["kind"]: (r["n"], r["keys"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("keys")).collect()}
    monkeypatch.setattr(lmscore, "BATCH", 4)
    vocabulary, model = lmscore.fit(docs, counts, totals)

    def coded(*texts):
        words = lmscore.Words(list(texts), lmscore.SpanHasher())
        return words.with_ends(vocabulary.encode(words.hashes, words.begins)[0])[:2]

    ids, begins = coded(cycle.encode())
    assert model.score(ids, begins).mean() > attention.Attention.fresh(vocabulary.counts).score(ids, begins).mean() + 1

    trainer, (ids, begins) = attention.Trainer(model, 0.01), coded(long.encode(), b"", b"a short one")
    firsts = attention.windows(begins)[0]
    for share in range(lmscore.ROUNDS):
        trainer.learn(ids, begins, share, lmscore.ROUNDS, 64)
    assert trainer.windows == len(firsts)
