"""Hard negatives beside all pairs in plain Python, with ties, odd vectors and repeated rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfstream.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, score long, group_no string"
EVERY = "vec_id % 10 = 0"


def brute(rows, scale=256.0, k=5, low=80, high=100):
    points = [
        (i, l, [math.floor(scale * x) for x in v]) for i, l, v, *_ in rows
        if None not in (i, l, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, l, v in points:
        if i % 10 == 0 and (i not in anchors or (l, v) < anchors[i]):
            anchors[i] = (l, v)
    out = Counter()
    for a, (label, vector) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), i, l) for i, l, v in points if i != a)
        for score, positive, _ in [s for s in scored if s[2] == label][:k]:
            fits = [(s, i) for s, i, l in scored if l != label and low * -score <= 100 * -s <= high * -score][:k]
            out.update((a, positive, n + 1, i, -score, -s) for n, (s, i) in enumerate(fits))
    return out


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = hard_negatives.mine(table, F.expr(EVERY), **options)
    return Counter(map(tuple, got.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


@pytest.fixture
def rows():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(4, 6))
    out = []
    for i in range(400):
        label = int(rng.integers(4))
        near = rng.integers(4) if i % 3 else label
        out.append((i, label, (centres[near] + 0.4 * rng.normal(size=6)).astype(np.float32).tolist(), 1, "g"))
    same = out[20][2]
    out += [(i, i % 4, same, 1, "g") for i in range(500, 620)]  # a very common vector
    nan, inf = float("nan"), float("inf")
    out += [
        (700, 1, None, 1, "g"), (710, None, same, 1, "g"), (None, 1, same, 1, "g"), (720, 1, [nan] * 6, 1, "g"),
        (730, 2, [inf] + [0.0] * 5, 1, "g"), (740, 2, [None] + [0.0] * 5, 1, "g"), (750, 2, [0.0] * 6, 1, "g"),
        (760, 3, [], 1, "g"), (770, 3, same[:3], 1, "g"), (-10, 3, same, 1, "g"), (780, 9, same, 1, "g"),
        (20, 0, same, 1, "g"), out[31], out[31],
    ]
    return out


def test_against_all_pairs(spark, rows, monkeypatch):
    want = brute(rows)
    assert sum(want.values()) > 300
    assert mined(spark, rows) == want
    # small blocks, slices, groups, clusters and steps: many tasks and early ends of the walks
    for name, value in (("BLOCK_ROWS", 40), ("SLICE_ROWS", 100), ("GROUP_ANCHORS", 7), ("CLUSTER_ANCHORS", 3), ("STEP", 8)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(spark, rows) == want


def test_other_parameters(spark, rows):
    assert mined(spark, rows, positives=2, negatives=2, low=50, high=90) == brute(rows, k=2, low=50, high=90)


def test_walks_end_early():
    rng = np.random.default_rng(3)
    vectors = np.floor(256 * rng.normal(size=(4000, 8)))
    block = {"ids": np.arange(4000).tobytes(), "labels": np.zeros(4000, np.int64).tobytes(), "dims": 8, "vectors": vectors.tobytes()}
    part = hard_negatives.Slice([block], 8)
    anchors = vectors[:1] + np.floor(rng.normal(size=(6, 8)) * 20)
    need, held = np.full(6, -np.inf), [None] * 6

    def take(m, places, scores):
        held[m] = hard_negatives._best(held[m], part.ids[places], scores, 5)
        need[m] = held[m][1][-1] if len(held[m][1]) == 5 else need[m]

    seen = part.walk(anchors, np.arange(4000), need, take)
    assert seen < 0.6 * 6 * 4000
    for m in range(6):
        scores = (vectors @ anchors[m]).astype(int)
        assert held[m][0].tolist() == np.lexsort((np.arange(4000), -scores))[:5].tolist()


def test_numbers_beyond_doubles(spark):
    rng = random.Random(1)
    rows = [(i, i % 2, [float(np.float32(rng.uniform(0.5, 1) * 2**18)) for _ in range(3)], 1, "g") for i in range(30)]
    assert mined(spark, rows) == brute(rows) and sum(brute(rows).values())


def test_empty(spark):
    assert mined(spark, [(1, 1, [1.0], 1, "g")]) == Counter()
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty, F.expr(EVERY)).count() == 0
