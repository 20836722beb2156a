"""Each operator on small texts with nulls, empty and long texts, ties, repeated rows and clashing
columns, beside a brute-force version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfstream.llm import (
    containment, licenses, mixing, recompression, repeats, rule_forest, rule_stats, suffix_repeats, token_blocks, toxicity,
    warc, weighted_minhash,
)
from shelfstream.llm.plain import plain_words
from shelfstream.llm.text import first_by_hash
from shelfstream.llm.suffix_sorting import common_prefixes, suffix_array
from shelfstream.session import fresh_path

DOCS = "doc_id long, text string, source string, key string, size long, node string"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts() -> list[tuple]:
    rng = random.Random(3)
    shared = prose(rng, 60)
    long = prose(rng, 3000)
    near = prose(rng, 200)
    changed = near.replace(near.split()[100], "other", 1)
    rows = [
        (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, prose(rng, 80) + " " + shared + " " + prose(rng, 50)),
        (6, shared), (7, prose(rng, 30) + " " + shared), (8, long), (9, near), (10, changed), (11, near), (12, "er " * 300),
        (13, "A line.\nA line.\nReleased under the MIT License.\n" + prose(rng, 40)), (14, prose(rng, 40)),
        (14, None), (None, prose(rng, 40)), (None, None),
    ]
    rows.append(rows[5])  # a repeated row
    return [(i, t, ("a", "b", None)[n % 3], "k", 7, "n") for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def repeated(sequences, window):
    seen = Counter(s[i : i + window] for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        edge = np.zeros(len(s) + 1, int)
        for i in range(len(s) - window + 1):
            if seen[s[i : i + window]] > 1:
                edge[i] += 1
                edge[i + window] -= 1
        out.append(np.cumsum(edge)[:-1] > 0)
    return out


def test_token_blocks(spark, docs, none, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    known = Tokenizer.from_file(path)
    got = token_blocks.tokenize(docs, path).collect()
    want = Counter()
    for i, t, *_ in texts:
        ids = np.array([*known.encode(t or "", add_special_tokens=False).ids, token_blocks.END_ID], "<u4")
        want[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:k]) for k in range(len(ordered))]
    keys = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert keys == sorted(keys)
    assert token_blocks.tokenize(none, path).collect() == []


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(40, 60, n).astype(np.uint32)
    ids[rng.random(n) < 0.03] = 2**32 - 1  # kept as exceptions
    data, starts = token_blocks.pack(ids)
    assert (token_blocks.unpack(data, starts, n) == ids).all()
    assert len(data) < 4 * n + 5000


def test_files_of_many_documents_are_cut(spark, docs):
    import public_tokenizers

    folder = fresh_path(spark, "cut")
    written = token_blocks.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), folder, file_ids=1)
    read = token_blocks.read_tokens(spark, folder, written).orderBy("start").collect()
    assert len(read) == docs.count() and written.count() >= 1


def test_containment(spark, docs, none, texts):
    shared = next(t for i, t, *_ in texts if i == 6)
    items = spark.createDataFrame(
        [(1, shared), (2, "one two three"), (3, None), (4, prose(random.Random(9), 30))], "item_id long, text string"
    )
    found = containment.find(docs, items)
    assert Counter((r.doc_id, r.item_id) for r in found.collect()) == Counter({(5, 1): 2, (6, 1): 1, (7, 1): 1})
    kept = containment.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4
    assert containment.find(none, items).count() == 0
    assert containment.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_warc(spark):
    page = "<p>" + "x" * 200
    rows = [(5, "u\r\nv", page), (2, None, page), (9, "w", page), (7, "a", "short"), (8, "a", "short"), (3, "n", None), (None, "z", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.archive(pages).collect()}
    assert len(got) == 7
    for i, _, html in rows:
        raw = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert {i: r.refers_to for i, r in got.items()} == {5: 2, 9: 2, 2: None, 7: None, 8: None, 3: None, None: None}
    assert got[5].record_type == "revisit" and got[5].url == "u%0D%0Av"
    assert warc.archive(pages.limit(0)).collect() == []


def test_ranges_are_coalesced():
    assert warc.coalesce([(0, 10), (12, 5), (500, 5)], gap=10, most=100) == [(0, 17, 2), (500, 5, 1)]
    assert warc.coalesce([(0, 90), (90, 20)], gap=10, most=100) == [(0, 90, 1), (90, 20, 1)]
    assert warc.coalesce([]) == []


def test_suffix_arrays():
    rng = random.Random(5)
    for _ in range(500):
        s = [rng.randrange(rng.choice((1, 2, 4))) for _ in range(rng.randrange(40))]
        order = suffix_array(s)
        assert order == sorted(range(len(s)), key=lambda i: s[i:])
        for k, h in enumerate(common_prefixes(s, order)):
            if k:
                a, b = s[order[k - 1] :], s[order[k] :]
                assert a[:h] == b[:h] and a[h : h + 1] != b[h : h + 1] or h == min(len(a), len(b))


@pytest.mark.parametrize("bucket", [1, 32768])  # 1: every symbol is dealt out
def test_repeated_bytes(spark, docs, none, texts, monkeypatch, bucket):
    monkeypatch.setattr(suffix_repeats, "BYTES", replace(suffix_repeats.BYTES, bucket=bucket, slab_bytes=1000))
    got = Counter(tuple(r) for r in suffix_repeats.remove_repeats(docs).drop("kept").collect())
    raw = [(t or "").encode() for _, t, *_ in texts]
    want = Counter()
    for (i, *_), b, gone in zip(texts, raw, repeated(raw, 200)):
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        want[(i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert got == want and sum(r[2] for r in want) > 0
    assert suffix_repeats.remove_repeats(none).count() == 0


@pytest.mark.parametrize("bucket", [1, 32768])
def test_repeated_words(spark, docs, texts, monkeypatch, bucket):
    monkeypatch.setattr(recompression, "WORDS", replace(recompression.WORDS, bucket=bucket, slab_bytes=1000))
    got = Counter(tuple(r) for r in recompression.remove_repeats(docs).drop("kept").collect())
    split = [tuple(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in texts]
    want = Counter()
    for (i, *_), w, gone in zip(texts, split, repeated(split, 35)):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[(i, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert got == want and sum(r[2] for r in want) > 0
    assert recompression.remove_repeats(docs.limit(0)).count() == 0


def test_mixing(spark, docs, none, texts):
    got = mixing.plan(docs).collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in texts]
    total = sum(words)
    assert sum(r["size"] for r in got) == total
    targets = {r.source: r.target for r in got}
    sizes = {r.source: r.source_size for r in got}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6
    assert all(targets[s] <= 2 * sizes[s] + 1e-9 for s in sizes) and all(r.taken <= 2 * r["size"] for r in got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.plan(docs).collect()), key=repr)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert mixing.plan(none).count() == 0 and mixing.mix(none).count() == 0


def test_shares_that_overflow_are_dealt_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    rest = 1.5 * 2010 - 20
    assert got["a"] == 20 and got[None] == 0 and abs(got["b"] - rest / 3) < 1e-6 and abs(got["c"] - min(2000, rest * 2 / 3)) < 1e-6


def test_nearest_examples_are_exact():
    rng = random.Random(2)
    texts = [prose(rng, 30) for _ in range(200)]
    terms = {w: i for i, w in enumerate(sorted({w for t in texts for w in toxicity.features(t)}))}
    idf = np.random.default_rng(0).random(len(terms)) + 0.1
    index = toxicity.Index(texts, np.arange(200) % 2, terms, idf)
    dense = np.zeros((200, len(terms)))
    for i, t in enumerate(texts):
        k, w = index.vector(*toxicity.counts(t, terms))
        dense[i, k] = w
    for i in range(0, 200, 7):
        found, cosine = index.nearest(texts[i], 5)
        assert np.allclose(cosine, np.sort(dense @ dense[i])[::-1][:5], atol=1e-5) and found[0] == i
    assert len(index.nearest("")[0]) == 0 and len(index.nearest(None)[0]) == 0


def test_toxicity(spark, none):
    rng = random.Random(4)
    rows = [(i, prose(rng, 40) + (" vile nasty rotten" * 3 if i % 5 == 0 else "")) for i in range(300)] + [(300, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    assert len(got) == 302 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r.held_out} - {None, 300} == set(held)
    assert np.mean([got[i].predicted == (i % 5 == 0) for i in held]) > 0.9
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns and 230 <= kept.count() <= 255
    assert toxicity.scores(docs, labels.limit(0)).filter("score = 0").count() == 302
    assert toxicity.scores(none, labels).count() == 0


def test_near_copies(spark, docs, none):
    got = {(r.doc_id, r.class_id) for r in weighted_minhash.classes(docs).collect()}
    assert {(3, 3), (4, 3), (9, 9), (10, 9), (11, 9), (0, 0), (1, 0), (2, 0), (None, None), (8, 8)} <= got
    kept = weighted_minhash.deduplicate(docs.filter("doc_id != 14"))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {0, 3, 5, 6, 7, 8, 9, 12, 13}
    assert weighted_minhash.classes(none).count() == 0


def test_samples_estimate_similarity():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 300).astype(np.uint64)
    weight = rng.random(300) + 0.2
    other = np.r_[keys[:250], rng.integers(0, 2**63, 50).astype(np.uint64)]
    a, b = (keys, weight), (other, weight)
    order = np.argsort(other)
    exact = weighted_minhash.similarity(tuple(x[np.argsort(keys)] for x in a), (other[order], weight[order]))
    assert abs(exact - weight[:250].sum() / (weight.sum() + weight[250:].sum())) < 1e-9
    same = weighted_minhash.samples([a, a, b])
    assert (same[0] == same[1]).all()


def test_licenses(spark, docs, none, texts):
    got = Counter((r.doc_id, r.n_words, r.n_base, r.base_labels, r.labels) for r in licenses.scan(docs).collect())
    want = Counter()
    for i, t, *_ in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        want[(i, len(words), int(i == 13), "mit" if i == 13 else "", "mit" if i == 13 else "")] += 1
    assert got == want
    assert licenses.scan(none).count() == 0
    lines = spark.createDataFrame([
        (1, "x\nLicensed UNDER CC by-nc, 4.0"), (2, "licensed under cc"), (3, "Apache license MIT License"),
    ], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(lines).collect()}
    assert (found[1].labels, found[1].score, found[2].labels) == ("cc-by-nc", 1.0, "")
    assert (found[3].base_labels, found[3].first_word, found[3].last_word, found[3].n_base) == ("apache,mit", 0, 2, 2)


def test_licenses_in_blocks_across_lines(spark):
    rng = random.Random(12)
    rows = [
        (1, "# You may not use this file except in\n# compliance with the License."),
        (2, prose(rng, 500) + "\nYou may not use this\nfile except in\ncompliance with\nthe License.\n" + prose(rng, 90)),
        # the same words too far apart
        (3, "\n".join(f"{w} {prose(rng, 3)}" for w in "you may not use this file except in compliance with the license".split())),
    ]
    labelled = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert labelled == {1: "apache", 2: "apache", 3: ""}

    for i in range(60):  # templates at any place, with words changed, left out and put between
        words = prose(rng, rng.randrange(0, 120)).split()
        for _ in range(rng.randrange(0, 3)):
            at, (_, text) = rng.randrange(0, len(words) + 1), rng.choice(licenses.TEMPLATES)
            part = [w for w in text.split() if rng.random() > rng.choice([0, 0.1, 0.25])]
            for _ in range(rng.randrange(0, 5)):
                part.insert(rng.randrange(0, len(part) + 1), "zz")
            words[at:at] = part
        rows.append((10 + i, " ".join(w + rng.choice(["", "\n", ","]) for w in words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("low", F.lower("text"))
    got = {(r.key, r.label): r.containment for r in licenses.similar(docs.select(F.col("doc_id").alias("key"), "low")).collect()}
    want = {}
    for i, text in rows:
        words = re.findall(r"[a-z0-9é]+", text.lower())
        for label, template in licenses.TEMPLATES:
            members, most = set(template.split()), math.ceil(len(template.split()) / 0.8 - 1e-9)
            held = max((len(members & set(words[k : k + most])) for k in range(len(words))), default=0)
            if held >= math.ceil(0.8 * len(members) - 1e-9):
                want[i, label] = max(want.get((i, label), 0), held / len(members))
    assert got == want and len(want) > 20


def test_first_by_hash_is_the_plain_order(spark):
    rows = spark.range(5000).select((F.col("id") % 4000).alias("id"), F.col("id").alias("row"))
    for most in (0, 1, 30, 3999, 6000):
        plain = rows.orderBy(F.xxhash64("id"), "row").limit(most).collect()
        assert first_by_hash(rows, F.xxhash64("id"), most, "row").collect() == plain
    same = rows.withColumn("id", F.lit(7))  # one hash for all
    assert [r.row for r in first_by_hash(same, F.xxhash64("id"), 5, "row").collect()] == [0, 1, 2, 3, 4]
    assert first_by_hash(rows.limit(0), F.xxhash64("id"), 5, "row").count() == 0


def test_rule_statistics():
    rng = random.Random(6)
    for _ in range(60):
        text = " ".join(rng.choice(["a", "b", "cc", "é#", "x\n", "x\n"]) for _ in range(rng.randrange(0, 80)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        places: dict[tuple, list[int]] = {}
        for i in range(len(words) - 7):
            places.setdefault(tuple(words[i : i + 8]), []).append(i)
        again = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert rule_stats.statistics(text)[:5] == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)
        )
    assert rule_stats.statistics(None)[:5] == (0, 0, 0, 0, 0)


def test_rule_forest(spark, docs, none):
    rng = random.Random(7)
    rows = [(i, prose(rng, 60) if i % 6 else "### %%% " * 8 + prose(rng, 30).upper()) for i in range(240)] + [(240, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 6 > 0)) for i in range(240)], "doc_id long, quality int")
    got = {r.doc_id: r for r in rule_forest.filter_quality(table, labels).collect()}
    assert got[240].base_failed and not got[240].kept
    assert np.mean([got[i].kept == bool(i % 6) for i in range(240)]) > 0.95
    assert rule_forest.filter_quality(docs, labels.limit(0)).filter("kept = base_failed").count() == 0
    assert rule_forest.filter_quality(none, labels).count() == 0


def test_plain_words():
    assert plain_words("A-b, É?\n") == ["a".encode(), b"b", "é".encode()] and plain_words(None) == []


def alternating(n: int, a: str, b: str) -> str:
    """A block of n letters after the rule a -> ab, b -> ba."""
    out = a
    while len(out) < n:
        out += "".join(b if c == a else a for c in out)
    return out[:n]


def equal_hashes() -> list[tuple[str, str]]:
    """Texts of 200 letters whose polynomial hashes agree in many bits: halves of alternating blocks exchanged."""
    rng, out = random.Random(1), []
    for _ in range(40):
        sides = [rng.choice(("ab", "cd", "xy")) for _ in range(3)]
        blocks = [(alternating(64, *s), alternating(64, *s[::-1])) for s in sides]
        tail = "".join(rng.choice("pq") for _ in range(8))
        out.append(("".join(b[0] for b in blocks) + tail, "".join(b[1] for b in blocks) + tail))
    return out


def test_texts_of_like_hashes_are_compared(spark):
    texts = [t for pair in equal_hashes() for t in pair]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    raw = [t.encode() for t in texts]
    want = Counter((i, int(gone.sum())) for i, gone in enumerate(repeated(raw, 200)))
    got = Counter((r.doc_id, r.n_removed) for r in suffix_repeats.remove_repeats(docs).collect())
    assert got == want


@pytest.mark.parametrize("blind", [False, True])
def test_repeats_are_decided_by_units(monkeypatch, blind):
    """Also where every window has the same hash."""
    if blind:
        monkeypatch.setattr(repeats, "stretch", lambda sums, first, last: np.zeros(len(first), np.uint64))
    rng = random.Random(9)
    for _ in range(150):
        parts = [np.array([rng.randrange(3) for _ in range(rng.randrange(4, 12))], np.uint64) for _ in range(rng.randrange(2, 6))]
        offsets = [rng.randrange(3) for _ in parts]
        seen = Counter((s - o, tuple(p[s : s + 4])) for p, o in zip(parts, offsets) for s in range(len(p) - 3))
        want = {}
        for i, (p, o) in enumerate(zip(parts, offsets)):
            starts = [s for s in range(len(p) - 3) if seen[(s - o, tuple(p[s : s + 4]))] > 1]
            if starts:
                want[i] = (starts[0], starts[-1])
        assert repeats.repeated(parts, offsets, 4) == want
