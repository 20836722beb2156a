"""Rows that share ids, null ids, conflicting labels and clashing columns; searches beside all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfstream import session
from shelfstream.llm import (
    containment, mixing, repeats, rule_forest, suffix_repeats, text as shared_text, token_blocks, toxicity, weighted_minhash,
    word_ids,
)
from shelfstream.llm.plain import plain_words
from shelfstream.llm.word_ids import text_slabs

SF_DIR = "/root/testdata/sf0.001"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(2, 7))) for _ in range(n))


def changed(text: str, rng: random.Random, n: int) -> str:
    words = text.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = "other" + str(i)
    return " ".join(words)


def shingles(text):
    words = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_containment_against_all_pairs(spark):
    rng = random.Random(4)
    items = [(i if i != 3 else None, prose(rng, rng.randrange(4, 120))) for i in range(30)] + [(7, prose(rng, 30)), (50, None), (51, "")]
    rows = []
    for d in range(60):
        held = [items[rng.randrange(31)][1] for _ in range(rng.randrange(3))]
        held = [changed(t, rng, max(0, int(len(t.split()) * rng.choice((0, 0, 0.02, 0.05, 0.2))))) for t in held]
        rows.append((d if d % 9 else None, f" {prose(rng, 20)} ".join(["", *held, ""]), 1, 2, 3))
    rows += [(61, None, 1, 2, 3), rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _bad_key int, _plain int, item int")
    table = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for d, text, *_ in rows:
        have = shingles(text)
        for i, item in items:
            need = shingles(item)
            if need and len(need & have) >= np.ceil(0.8 * len(need) - 1e-9):
                want[d, i, len(need), len(need & have)] += 1
    got = Counter((r.doc_id, r.item_id, r.n_shingles, r.n_held) for r in containment.find(docs, table).collect())
    assert got == want and any(k[1] is None for k in want) and any(k[0] is None for k in want)
    kept = containment.decontaminate(docs, table)
    held = Counter((r.doc_id, r.text) for r in kept.collect())
    assert kept.columns == docs.columns
    assert held == Counter((d, t) for d, t, *_ in rows if not any(
        shingles(i) and len(shingles(i) & shingles(t)) >= np.ceil(0.8 * len(shingles(i)) - 1e-9) for _, i in items))


def near(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in weighted_minhash.deduplicate(docs).collect())
    return {(r.doc_id, r.class_id) for r in weighted_minhash.classes(docs).collect()}, kept


def test_rows_that_share_an_id_are_told_apart(spark):
    rng = random.Random(1)
    q, r = prose(rng, 80), prose(rng, 80)
    classes, kept = near(spark, [(1, q), (5, q), (5, r), (7, r)])
    assert classes == {(1, 1), (5, 1), (5, 5), (7, 5)} and kept == Counter([(1, q), (5, r)])
    q2, r2 = changed(q, rng, 1), changed(r, rng, 1)
    classes, kept = near(spark, [(5, q), (5, r), (7, q2), (8, r2), (None, q), (5, q)])
    assert classes == {(5, 5), (7, 5), (8, 5), (None, None)}
    assert kept == Counter([(5, q), (5, q), (5, r), (None, q)])  # the row (5, q) stands twice
    upper = q.upper()  # the same words, another text
    _, kept = near(spark, [(5, q), (5, upper)])
    assert sum(kept.values()) == 1


def test_recall_of_near_copies_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    idf, most = weighted_minhash.word_weights(docs)
    of = weighted_minhash.Words(idf, most)
    vectors = {i: weighted_minhash.weighted(plain_words(t), of) for i, t in texts.items()}
    links = [
        (a, b) for a, b in combinations(sorted(vectors), 2)
        if min(len(vectors[a][0]), len(vectors[b][0])) and weighted_minhash.similarity(vectors[a], vectors[b]) >= 0.8
    ]
    found = {r.doc_id: r.class_id for r in weighted_minhash.classes(docs).collect()}
    linked = [found[a] == found[b] for a, b in links]
    assert len(links) >= 10 and np.mean(linked) >= 0.9
    # no class holds texts that no chain of links joins
    leader = {i: i for i in texts}
    for a, b in links:
        a, b = (next(x for x in _up(leader, y)) for y in (a, b))
        leader[max(a, b)] = min(a, b)
    whole = {i: next(_up(leader, i)) for i in texts}
    empty = min((i for i in texts if not plain_words(texts[i])), default=None)
    assert all(found[i] == whole[i] or not plain_words(texts[i]) and found[i] == empty for i in texts)


def _up(leader, i):
    while leader[i] != i:
        i = leader[i]
    yield i


def test_samples_agree_as_often_as_texts_are_similar(monkeypatch):
    monkeypatch.setattr(weighted_minhash, "BANDS", 400)
    monkeypatch.setattr(weighted_minhash, "ROWS", 1)
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    weight = rng.random(400) + 0.1
    other = weight * np.where(rng.random(400) < 0.3, rng.random(400) + 0.3, 1)
    drawn = weighted_minhash.samples([(keys, weight), (keys, other)])
    exact = weighted_minhash.similarity((keys, weight), (keys, other))
    assert abs((drawn[0] == drawn[1]).mean() - exact) < 4 * (exact * (1 - exact) / 400) ** 0.5


def test_an_id_labelled_both_ways_is_toxic(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 40) + (" vile nasty rotten" * 3 if i % 5 == 0 else "")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, int(i % 5 == 0)) for i in range(200)] + [(5 * i, 0) for i in range(40)]
    first = spark.createDataFrame(marks, "doc_id long, toxic int").repartition(3)
    second = spark.createDataFrame(marks[::-1], "doc_id long, toxic int").coalesce(1)
    scores = [sorted(map(tuple, toxicity.scores(docs, x).select("doc_id", "score").collect())) for x in (first, second)]
    assert scores[0] == scores[1]


def test_columns_that_clash(spark):
    rng = random.Random(2)
    names = "_mix_id int, _mix_source int, _mix_copies int, _mix_copy int, _copy_key int, _own_key int, _copy_id int, key int, same int, node int"
    rows = [(i, prose(rng, 30), "s") + (1,) * 10 for i in range(12)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, {names}")
    for result in (mixing.mix(docs), weighted_minhash.deduplicate(docs)):
        assert result.columns == docs.columns and result.count() > 0


def test_every_labelled_row_counts_in_the_forest(spark):
    """Also of more than 20,000 rows: in the trees' counts and in the threshold."""
    n = 24_000
    stats = spark.range(n, numPartitions=5).select(
        F.col("id").alias("doc_id"), F.lit(100).cast("long").alias("n_words"), (500 + F.col("id") % 7).alias("word_chars"),
        F.when(F.col("id") % 4 == 0, 60 + F.col("id") % 31).otherwise(F.col("id") % 41).alias("n_symbols"),
        *[(F.col("id") % k).alias(c) for c, k in (("n_dup_lines", 3), ("n_repeat_words", 5), ("n_upper", 11), ("n_marks", 13))],
        F.lit(10).cast("long").alias("n_lines"), (50 + F.col("id") % 17).alias("n_distinct"),
    )
    labels = stats.select("doc_id", (F.col("doc_id") % 4 > 0).cast("int").alias("quality"))
    forest = rule_forest.fit(stats, labels)
    half = {r.doc_id for r in stats.filter(F.xxhash64("doc_id", F.lit(0)) % 2 == 0).select("doc_id").collect()}
    assert set(forest["held"][forest["roots"]]) == {sum(i % 4 > 0 for i in half)}
    judged = rule_forest.judge(stats, forest).select("doc_id", "score").toPandas()
    rest = judged[~judged["doc_id"].isin(half)].sort_values("score", kind="stable")
    bad = (rest["doc_id"] % 4 == 0).to_numpy()
    worth = (bad.sum() - np.r_[0, np.cumsum(bad)]) / bad.sum() + np.r_[0, np.cumsum(~bad)] / (~bad).sum()
    s = rest["score"].to_numpy()
    ends = np.r_[True, s[1:] > s[:-1], True]  # equal scores fall on one side
    passed = s <= forest["threshold"]
    assert abs((~passed & bad).sum() / bad.sum() + (passed & ~bad).sum() / (~bad).sum() - worth[ends].max()) < 1e-9


def test_vectors_are_dealt_again_only_for_repeated_rows(spark, monkeypatch):
    """A row that comes twice has one vector; without such rows no vector is sent to find them."""
    rng = random.Random(4)
    base = [prose(rng, 60) for _ in range(30)]
    texts = [t for b in base for t in (b, changed(b, rng, 1), b)]
    rows = list(enumerate(texts)) + [(0, texts[0]), (1, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sizes, write = [], weighted_minhash.materialise

    def counted(df, label):
        out = write(df, label)
        if label.startswith("vectors"):
            sizes.append((label, out.count(), out.select("node").distinct().count()))
        return out

    monkeypatch.setattr(weighted_minhash, "materialise", counted)
    got = {r.doc_id: r.class_id for r in weighted_minhash.classes(docs).collect()}
    assert all(got[i] == i - i % 3 for i in got if i % 3 == 2)
    assert [s[0] for s in sizes] == ["vectors", "vectors-once"] and sizes[0][1] > sizes[0][2] == sizes[1][1] == sizes[1][2]
    sizes.clear()
    weighted_minhash.classes(docs.distinct()).collect()
    assert "vectors-once" not in [s[0] for s in sizes]


def test_texts_without_near_copies_are_not_sent(spark, monkeypatch):
    """Only texts that share a bucket, and vectors of pairs asked for, are given to the joins."""
    rng = random.Random(6)
    base = [prose(rng, 60) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(base + [changed(base[0], rng, 1)])), "doc_id long, text string")
    sent, narrow = {}, weighted_minhash.possible

    def counted(rows, wanted, key):
        out = narrow(rows, wanted, key)
        sent.setdefault(key, []).append((rows.count(), out.count(), wanted.select(key).distinct().count()))
        return out

    monkeypatch.setattr(weighted_minhash, "possible", counted)
    got = {r.doc_id: r.class_id for r in weighted_minhash.classes(docs).collect()}
    assert got[600] == 0 and all(got[i] == i for i in range(600))
    assert sent["doc_id"][0][0] == 601 and all(w <= some <= 2 * w + n // 20 for x in sent.values() for n, some, w in x)


def test_possible_rows_hold_all_wanted(spark, monkeypatch):
    rows = spark.createDataFrame([(i if i % 10 else None, i) for i in range(-2000, 2000)], "k long, _place int")
    for marks, keys in ((1 << 18, [-7, 5, 5, None, 1999, 9999]), (2, [k for k in range(1, 900) if k % 10]), (2, [])):
        monkeypatch.setattr(shared_text, "MARKS", marks)
        wanted = spark.createDataFrame([(k,) for k in keys], "k long")
        out = shared_text.possible(rows, wanted, "k")
        found = {r.k for r in out.collect()}
        assert out.columns == rows.columns and found >= {k for k in keys if k != 9999} and (keys or not found)
        assert len(keys) > 6 or len(found) < 400


def test_vectors_of_many_texts_are_those_of_each():
    rng = random.Random(7)
    texts = [plain_words(t) for t in ("", "a", "a a b", "a a a a a a a a", *(prose(rng, n) for n in (4, 5, 6, 300)), "")]
    texts.append(texts[-2] + texts[-2])
    of = weighted_minhash.Words({weighted_minhash.word_hash(b"a"): 0.5}, 4.6, limit=3)
    for words, (shingle, weight) in zip(texts, weighted_minhash.weighted_all(texts, of)):
        k = min(5, len(words))
        want = Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else Counter()
        assert len(shingle) == len(want) and (shingle[1:] > shingle[:-1]).all()
        assert np.allclose(sorted(weight), sorted(n * sum(0.5 if w == b"a" else 4.6 for w in s) for s, n in want.items()))
        alone = weighted_minhash.weighted(words, of)
        assert np.array_equal(alone[0], shingle) and np.array_equal(alone[1], weight)


def test_similarity_of_sorted_shingles():
    def vector(*pairs):
        return np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.float64)

    a, b = vector((1, 2.0), (5, 1.0), (9, 4.0)), vector((5, 3.0), (9, 1.0), (12, 1.0))
    assert weighted_minhash.similarity(a, b) == weighted_minhash.similarity(b, a) == 2.0 / 10.0
    assert weighted_minhash.similarity(a, vector()) == weighted_minhash.similarity(vector(), a) == 0.0
    assert weighted_minhash.similarity(a, a) == weighted_minhash.similarity(vector(), vector()) == 1.0


def test_stretches_of_one_width_and_small_slabs():
    rng = random.Random(8)
    texts = pa.array([prose(rng, rng.randrange(120)) for _ in range(80)] + ["", prose(rng, 900)])
    units, _ = suffix_repeats.byte_units(texts)
    for n in (0, 79, 80, len(units)):
        sums = repeats.prefix(units[:n])
        starts = np.arange(max(0, n - 79))
        assert np.array_equal(repeats.stretches(sums, 80), repeats.stretch(sums, starts, starts + 80))
    whole = repeats.find(suffix_repeats.BYTES, texts)
    assert suffix_repeats.BYTES.slab_bytes * 8 <= 2 << 20
    at, places = 0, []
    for slab in text_slabs(texts, 2000):
        found = repeats.find(suffix_repeats.BYTES, slab)
        if found is not None:
            places += zip((found.text + at).tolist(), found.first.tolist(), found.last.tolist(), found.place.tolist(), found.symbol.tolist())
        at += len(slab)
    assert places == list(zip(*(getattr(whole, c).tolist() for c in ("text", "first", "last", "place", "symbol"))))


def test_passes_over_texts_hold_few_of_them_at_once(spark, monkeypatch):
    """Near copies, toxicity and token files cut the texts of a batch into slabs of bounded size."""
    for module in (weighted_minhash, toxicity, token_blocks):
        assert module.SLAB_BYTES <= 2 << 20
    held = []

    def counted(texts, most=word_ids.SLAB_BYTES):
        for slab in text_slabs(texts, most):
            held.append((slab.nbytes, most))
            yield slab

    monkeypatch.setattr(weighted_minhash, "text_slabs", counted)
    monkeypatch.setattr(weighted_minhash, "SLAB_BYTES", 500)
    rng = random.Random(9)
    batch = pa.RecordBatch.from_pydict({"text": [prose(rng, 20) for _ in range(50)] + [None, ""]})
    runs = []
    frame = type("Frame", (), {"select": lambda self, *_: self, "mapInArrow": lambda self, run, _: runs.append(run) or self,
                               "groupBy": lambda self, _: self, "agg": lambda self, _: self})()
    monkeypatch.setattr(weighted_minhash, "materialise", lambda df, _: (_ for _ in ()).throw(StopAsyncIteration))
    try:
        weighted_minhash.word_weights(frame)
    except StopAsyncIteration:
        pass
    out = list(runs[0](iter([batch])))
    assert len(held) > 10 and {m for _, m in held} == {500}
    assert sum(n for b in out for w, n in zip(b["word"].to_pylist(), b["n"].to_pylist()) if w is None) == 52


def test_near_copies_take_texts_in_small_batches(spark, monkeypatch):
    setting, seen = session.BATCH_SETTING, []
    written = weighted_minhash.materialise
    monkeypatch.setattr(
        weighted_minhash, "materialise", lambda df, label: seen.append(int(spark.conf.get(setting))) or written(df, label)
    )
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    before = spark.conf.get(setting)
    assert weighted_minhash.classes(docs).count() == 2
    assert seen and set(seen) == {session.BATCH_ROWS} and spark.conf.get(setting) == before
    spark.conf.set(setting, 10)
    try:
        with session.small_batches(spark):
            assert spark.conf.get(setting) == "10"
        assert spark.conf.get(setting) == "10"
    finally:
        spark.conf.set(setting, before)


def test_toxic_words_outweigh_language_and_subject():
    """Toxic texts of many subjects, told from clean ones by a single word, have toxic neighbours."""
    rng = random.Random(21)
    subjects = [prose(rng, 60).split() for _ in range(12)]

    def text(i: int, toxic: bool) -> str:
        return " ".join(rng.choices(subjects[i % 12], k=40) + ["vile"] * toxic)

    texts, labels = [text(i, i // 12 % 2 == 1) for i in range(240)], np.arange(240) // 12 % 2
    terms = {w: i for i, w in enumerate(sorted({w for t in texts for w in toxicity.features(t)}))}
    index = toxicity.Index(texts, labels, terms, np.ones(len(terms)))
    votes = [(index.vote(text(i, False))[0], index.vote(text(i, True))[0]) for i in range(60)]
    assert all(clean < 0.5 < toxic for clean, toxic in votes)


def test_pairs_are_sent_as_texts(spark):
    """What near copies send for a pair are texts, not shingles and weights, and it is measured as before."""
    rng = random.Random(22)
    first = prose(rng, 80)
    texts = [first, changed(first, rng, 3), prose(rng, 50), "one two", ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "node long, text string")
    same = {i: weighted_minhash.text_digest(plain_words(t)) for i, t in enumerate(texts)}
    rows = spark.createDataFrame([(i, same[i], None, t) for i, t in enumerate(texts)], "node long, same binary, pivots array<long>, text string")
    idf, most = weighted_minhash.word_weights(docs)
    known = weighted_minhash.cells_of(rows, idf, most)
    assert known.columns == ["node", "pivots", "text", "cells"]
    pairs = spark.createDataFrame([(a, b) for a, b in combinations(range(5), 2)], "a long, b long")
    of = weighted_minhash.Words(idf, most)
    vector = [weighted_minhash.weighted(plain_words(t), of) for t in texts]
    got = {(r.a, r.b): r.similarity for r in weighted_minhash.verified(pairs, known, idf, most).collect()}
    assert len(got) == 10
    assert all(abs(s - weighted_minhash.similarity(vector[a], vector[b])) < 1e-6 for (a, b), s in got.items())
