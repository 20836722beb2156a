"""Near copies by weighted MinHash.

A text is a weighted set of five-word shingles: ``tf * idf``, the idf of a shingle being the sum of
its words' ``ln(1 / f)``, f being the share of documents with the word, but ``RARE`` at least. Only words
in more than ``RARE`` of all documents need a number of their own; as documents have a bounded mean
number of distinct words, these are a bounded list. Improved consistent weighted sampling draws
``BANDS * ROWS`` (shingle, level) pairs per text; texts that agree in a band meet. Texts that are
word for word the same are one node.

Of a bucket, the first member is verified against all others, by exact weighted Jaccard similarity, and
components of the verified links are formed. In further rounds leaders, ``GROWTH`` times as many in each,
are verified against the members not in their component, until every pair of a bucket was verified, is in
one component or is ruled out. Two bounds rule pairs out without loss, inside the join, so that the
pairs are never emitted: one minus the similarity is a distance, so two texts whose distances from the
first member differ too much are not similar; and with shingles dealt to ``CELLS`` cells, two texts share
at most the lesser weight of each cell. So copies aren't expanded into pairs, and no link between
different components is left out. A bucket of many texts that are neither similar nor ruled out by the
first bound is still compared cell by cell, leaders by members.

Defined cases: null text is empty; texts without words are copies of each other; shorter texts than
five words are one shingle; rows without an id have no class, and ``deduplicate`` keeps them; rows that
share an id are told apart by their texts; rows that share both are kept or removed together; ids are
whole numbers; other columns, whatever their names, are kept; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
from array import array
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfstream.llm.components import components
from shelfstream.llm.plain import plain_words
from shelfstream.llm.text import possible, row_key, unused
from shelfstream.llm.word_ids import text_slabs
from shelfstream.session import materialise, small_batches

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 9, 2
RARE = 0.01
GROWTH = 32  # leaders of a bucket in a round, times those of the round before
SLACK = 1e-5  # for rounding
CELLS = 128
SLAB_BYTES = 1 << 17  # of texts that are cut into words at once
REMEMBERED = 200_000  # words that a task remembers

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


class Words(dict):
    """Places of words, remembered by a task, and their hashes and idf."""

    def __init__(self, idf: dict[int, float], most: float, limit: int = REMEMBERED):
        self.idf, self.most, self.limit = idf, most, limit
        self.hashes, self.weights = array("Q"), array("d")

    def __missing__(self, word: bytes) -> int:
        h = word_hash(word)
        place = self[word] = len(self)
        self.hashes.append(h)
        self.weights.append(self.idf.get(h, self.most))
        return place

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.limit:
            self.clear()
            self.hashes, self.weights = array("Q"), array("d")
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(self.hashes, np.uint64)[places], np.frombuffer(self.weights, np.float64)[places]


def weighted(words: list[bytes], of: Words) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes and weights of a text."""
    return weighted_all([words], of)[0]


def weighted_all(texts: list[list[bytes]], of: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same of many texts; those with SHINGLE words or more are hashed at once."""
    out = [(np.zeros(0, np.uint64), np.zeros(0))] * len(texts)
    for k in range(1, SHINGLE + 1):
        chosen = [i for i, t in enumerate(texts) if min(len(t), SHINGLE) == k]
        if not chosen:
            continue
        hashes, idf = of(list(chain.from_iterable(texts[i] for i in chosen)))
        n = len(hashes) - k + 1
        shingle, weight = np.zeros(n, np.uint64), np.zeros(n)
        for i in range(k):  # over the ends of texts as well; those are not taken
            shingle = mix(shingle + hashes[i : i + n] + np.uint64(i + 1))
            weight += idf[i : i + n]
        at = 0
        for i in chosen:
            end = at + len(texts[i]) - k + 1
            order = np.argsort(shingle[at:end])
            own = shingle[at:end][order]
            opens = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            times = np.diff(opens, append=len(own))
            out[i] = own[opens], weight[at:end][order[opens]] * times
            at = end + k - 1
    return out


def samples(texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One row per text and one number per band, equal for texts whose samples of the band are equal.
    Every text has a shingle; many texts are drawn for at once, as most are short."""
    lengths = np.array([len(s) for s, _ in texts])
    shingle, weight = (np.concatenate(x) for x in zip(*texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    starts = np.cumsum(lengths) - lengths
    out = np.zeros((len(texts), BANDS), np.uint64)
    log_weight = np.log(weight)
    unit, low, half = 1.0 / 2**32, np.uint64(0xFFFFFFFF), np.uint64(32)
    bits, part = np.empty(len(shingle), np.uint64), np.empty(len(shingle))  # used again, as new arrays cost more than sums

    def minus_log(x: np.ndarray) -> np.ndarray:
        out = np.add(np.bitwise_and(x, low, out=bits), 0.5)
        out *= np.add(np.right_shift(x, half, out=bits), 0.5, out=part)
        out *= unit**2
        return np.negative(np.log(out, out=out), out=out)

    for k in range(BANDS * ROWS):
        a = mix(shingle + np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64))
        b = mix(a + _M1)
        r, drawn = minus_log(a), minus_log(b)
        a ^= _M1
        a *= _M2
        shift = np.multiply(np.right_shift(a, half, out=a), unit)
        level = log_weight / r
        level += shift
        np.floor(level, out=level)
        shift = np.subtract(level, shift, out=shift)
        shift += 1
        shift *= r
        np.log(drawn, out=drawn)
        drawn -= shift
        least = np.flatnonzero(drawn == np.repeat(np.minimum.reduceat(drawn, starts), lengths))
        at = least[np.unique(owner[least], return_index=True)[1]]
        out[:, k // ROWS] = mix(out[:, k // ROWS] + shingle[at] + mix(level[at].astype(np.int64).view(np.uint64)))
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of sorted shingles."""
    at = np.minimum(np.searchsorted(a[0], b[0]), max(len(a[0]) - 1, 0))
    both = np.flatnonzero(a[0][at] == b[0]) if len(a[0]) else np.zeros(0, np.int64)
    least = np.minimum(a[1][at[both]], b[1][both]).sum()
    most = a[1].sum() + b[1].sum() - least
    return float(least / most) if most > 0 else 1.0


def word_weights(docs: DataFrame, rare: float = RARE) -> tuple[dict[int, float], float]:
    """idf by word hash of the words in more than ``rare`` of all documents, and the idf of all others.
    Tasks count before the shuffle; the list is bounded by the mean number of distinct words / rare."""

    def run(batches):
        held: Counter[bytes] = Counter()
        rows = 0

        def out():
            hashes = np.fromiter(map(word_hash, held), np.uint64, len(held)).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([*hashes.tolist(), None], pa.int64()), pa.array([*held.values(), rows], pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for slab in text_slabs(batch.column("text"), SLAB_BYTES):
                for t in slab.to_pylist():
                    held.update(set(plain_words(t)))
                rows += len(slab)
                if len(held) > REMEMBERED:
                    yield out()
                    held, rows = Counter(), 0
        yield out()

    counted = materialise(
        docs.select(F.col("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "word-counts",
    )
    total = counted.filter("word IS NULL").agg(F.sum("n")).first()[0] or 1
    often = counted.filter(F.col("word").isNotNull() & (F.col("n") > rare * total)).toPandas()
    # a word in every document still weighs a little
    idf = np.log(total / often["n"].to_numpy(np.float64)) + 0.01
    return dict(zip((int(w) % 2**64 for w in often["word"]), idf)), float(np.log(1 / rare) + 0.01)


def nodes(docs: DataFrame, idf: dict[int, float], most: float) -> DataFrame:
    """(doc_id, key, same, total, bands): ``same`` tells texts apart, word for word; total is the weight of all
    shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches):
        of = Words(shared.value, most)
        for batch in batches:
            same, total, bands = [], [], []
            for slab in text_slabs(batch.column("text"), SLAB_BYTES):
                split = [plain_words(t) for t in slab.to_pylist()]
                found = weighted_all(split, of)
                drawn = iter(samples([x for x in found if len(x[0])]).view(np.int64).tolist() if any(split) else [])
                same += map(text_digest, split)
                total += [float(x[1].sum()) for x in found]
                bands += [next(drawn) if len(x[0]) else [] for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(same, pa.binary()), pa.array(total, pa.float64()),
                 pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "key", "same", "total", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, key long, same binary, total double, bands array<long>")


def text_digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def cells_of(docs: DataFrame, idf: dict[int, float], most: float) -> DataFrame:
    """(node, pivots, text, cells) of rows (node, same, pivots, text) whose text is the node's, one row for each;
    ``cells`` sums the weights of each cell."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches):
        of = Words(shared.value, most)
        for batch in batches:
            done = 0
            for slab in text_slabs(batch.column("text"), SLAB_BYTES):
                rows, done = batch.slice(done, len(slab)), done + len(slab)
                split = [plain_words(t) for t in slab.to_pylist()]
                own = [text_digest(w) == same for w, same in zip(split, rows.column("same").to_pylist())]
                found = weighted_all([w for w, use in zip(split, own) if use], of)
                rows = rows.filter(pa.array(own, pa.bool_()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("node"), rows.column("pivots"), rows.column("text"),
                     pa.array([
                         np.bincount((s % np.uint64(CELLS)).astype(np.int64), w, CELLS).astype(np.float32) for s, w in found
                     ], pa.list_(pa.float32()))],
                    ["node", "pivots", "text", "cells"],
                )

    return docs.mapInArrow(run, "node long, pivots array<long>, text string, cells array<float>")


def verified(pairs: DataFrame, known: DataFrame, idf: dict[int, float], most: float) -> DataFrame:
    """(a, b, similarity) of written pairs (a, b): their weighted Jaccard similarity. Other texts are left where
    they are."""
    right = possible(known.select(F.col("node").alias("b"), F.col("text").alias("tb")), pairs, "b")
    return compared(pairs.join(right, "b"), known, pairs, idf, most)


def compared(sent: DataFrame, known: DataFrame, pairs: DataFrame, idf: dict[int, float], most: float) -> DataFrame:
    """(a, b, similarity) of rows (a, b, tb), which hold the text of b; ``pairs`` are written and name all a. Texts
    move, not the longer lists of shingles and weights; each is cut once per slab."""
    left = possible(known.select(F.col("node").alias("a"), F.col("text").alias("ta")), pairs, "a")
    joined = sent.join(left, "a").select("a", "b", "ta", "tb")
    shared = sent.sparkSession.sparkContext.broadcast(idf)

    def run(batches):
        of = Words(shared.value, most)
        for batch in batches:
            found, done = [], 0
            for slab in text_slabs(batch.column("tb"), SLAB_BYTES):
                left, right = batch.column("ta").slice(done, len(slab)).to_pylist(), slab.to_pylist()
                done += len(slab)
                texts = list(dict.fromkeys(t or "" for t in left + right))
                vectors = [(s, w.astype(np.float32).astype(np.float64)) for s, w in weighted_all(list(map(plain_words, texts)), of)]
                at = dict(zip(texts, vectors))
                found += [similarity(at[a or ""], at[b or ""]) for a, b in zip(left, right)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], ["a", "b", "similarity"]
            )

    return joined.mapInArrow(run, "a long, b long, similarity double")


def ratio(a: str, b: str) -> Column:
    """The lesser of two total weights over the greater, which no similarity can exceed."""
    return F.least(a, b) / F.greatest(a, b)


def shareable(a: str, b: str) -> Column:
    """The sum of the lesser weight of each cell, which no two texts share more than."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0.0), lambda all_, x: all_ + x)


def beside_pivots(members: DataFrame) -> DataFrame:
    """(bucket, node, total, pivot, most) of all members of a bucket but its first, the pivot; no similarity with
    it exceeds ``most``."""
    firsts = members.groupBy("bucket").agg(F.min("node").alias("pivot"), F.min_by("total", "node").alias("weight"))
    return materialise(
        members.join(firsts, "bucket").filter("node != pivot")
        .select("bucket", "node", "total", "pivot", ratio("total", "weight").alias("most")), "pivots",
    )


def pivoted(near: DataFrame, asked: DataFrame, known: DataFrame, idf: dict[int, float],
            most: float) -> tuple[DataFrame, DataFrame]:
    """Similarities (a, b, similarity) of pivots and the members asked for, and all members beside pivots with
    ``low`` and ``high``, between which their distance from it lies. A text goes to its pivots straight away."""
    sent = known.select(F.explode("pivots").alias("a"), F.col("node").alias("b"), F.col("text").alias("tb"))
    measured = materialise(compared(sent, known, asked, idf, most), "measured")
    far = near.join(
        measured.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "similarity"), ["pivot", "node"], "left"
    )
    return measured, materialise(far.select(
        "bucket", "node", "total", (1 - F.coalesce("similarity", "most")).alias("low"),
        F.coalesce(1 - F.col("similarity"), F.lit(1.0)).alias("high"),
    ), "distances")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of every row: the smallest id of its group of near copies."""
    return grouped(docs, doc_id, text, threshold).select("doc_id", "class_id")


def keyed(doc_id: str, text: str) -> Column:
    """The key of a row's id and text."""
    return row_key(doc_id, text)


def grouped(docs: DataFrame, doc_id: str, text: str, threshold: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, key, leads) of every row; of each group the rows of one id and text lead. Whole texts and
    pairs of texts go to Python, in small batches."""
    with small_batches(docs.sparkSession):
        return _grouped(docs, doc_id, text, threshold)


def _grouped(docs: DataFrame, doc_id: str, text: str, threshold: float) -> DataFrame:
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), keyed(doc_id, text).alias("key")
    )
    idf, most = word_weights(rows)
    signed = materialise(nodes(rows, idf, most), "signatures")
    texts = materialise(
        signed.filter(F.col("doc_id").isNotNull()).groupBy("same")
        .agg(F.min("doc_id").alias("first_id"), F.first("total").alias("total"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "texts",
    )
    buckets = F.array_distinct(F.transform("bands", lambda key, band: F.xxhash64(band, key)))
    banded = texts.select("node", "total", F.explode(buckets).alias("bucket"))
    full = materialise(
        banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket"), "full-buckets"
    )
    members = materialise(possible(banded, full, "bucket").join(full, "bucket"), "buckets")
    near = beside_pivots(members)
    asked = materialise(
        near.filter(F.col("most") >= threshold - SLACK).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(),
        "asked-of-pivots",
    )
    pivots = asked.groupBy(F.col("b").alias("node")).agg(F.collect_list("a").alias("pivots"))
    meant = materialise(
        texts.select(F.col("first_id").alias("doc_id"), "node", "same")
        .join(members.select("node").distinct(), "node", "left_semi").join(pivots, "node", "left"), "members",
    )
    # texts that are in no bucket with another stay where they are
    sent = possible(rows, meant, "doc_id").join(meant, "doc_id")
    known = materialise(cells_of(sent.select("node", "same", "pivots", "text"), idf, most), "vectors")
    if known.count() > meant.count():  # rows that share id and text; these are sent again only if there are such
        known = materialise(known.dropDuplicates(["node"]), "vectors-once")
    measured, open_members = pivoted(near, asked, known, idf, most)
    links = materialise(measured.filter(F.col("similarity") >= threshold).select("a", "b"), "verified")
    labels = None if links.isEmpty() else components(links)
    leaders_each = GROWTH
    while True:
        placed = open_members.join(labels, "node", "left") if labels is not None else open_members.withColumn("label", F.lit(None).cast("long"))
        placed = materialise(
            placed.select("bucket", "node", "total", "low", "high", F.coalesce("label", "node").alias("label")), "placed"
        )
        # buckets whose open members are in one component have no pair left to verify
        mixed = placed.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most"))
        placed = materialise(placed.join(mixed.filter("least != most").select("bucket"), "bucket"), "mixed")
        if placed.isEmpty():
            break
        sizes = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
        ranked = placed.join(sizes, ["bucket", "label"])
        rank = Window.partitionBy("bucket").orderBy("n", "label", "node")
        # members of the smaller components lead, so a large group of copies is not walked through
        leaders = materialise(
            ranked.withColumn("place", F.row_number().over(rank))
            .filter(F.col("place") <= leaders_each).select(
                "bucket", F.col("node").alias("leader"), F.col("label").alias("of"), F.col("n").alias("of_n"),
                F.col("total").alias("weight"), F.col("low").alias("of_low"), F.col("high").alias("of_high"),
            ), "leaders",
        )
        cells = known.select("node", "cells")
        led = leaders.join(cells.select(F.col("node").alias("leader"), F.col("cells").alias("of_cells")), "leader")
        pairs = ranked.join(cells, "node").join(led, "bucket").filter("label != of")
        # two leaders meet once
        pairs = pairs.filter(F.struct("of_n", "of", "leader") < F.struct("n", "label", "node"))
        pairs = pairs.filter(ratio("weight", "total") >= threshold - SLACK)
        # by the triangle inequality, as 1 - similarity is a distance
        apart = F.greatest(F.col("low") - F.col("of_high"), F.col("of_low") - F.col("high"))
        enough = threshold / (1 + threshold) * (F.col("total") + F.col("weight")) * (1 - SLACK)
        pairs = materialise(
            pairs.filter(apart <= 1 - threshold + SLACK).filter(shareable("cells", "of_cells") >= enough).select(
                F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")
            ).distinct(), "pairs",
        )
        found = materialise(
            verified(pairs, known, idf, most).filter(F.col("similarity") >= threshold).select("a", "b"), "verified"
        )
        if not found.isEmpty():
            links = links.union(found)
            labels = components(links)
        done = leaders.select("bucket", F.col("leader").alias("node"))
        open_members = placed.drop("label").join(done, ["bucket", "node"], "left_anti")
        leaders_each *= GROWTH
    texts = texts.select("same", "node")
    if labels is not None:
        texts = texts.join(labels, "node", "left").select("same", F.coalesce("label", "node").alias("group"))
    else:
        texts = texts.select("same", F.col("node").alias("group"))
    named = materialise(
        signed.filter(F.col("doc_id").isNotNull()).select("doc_id", "key", "same").join(texts, "same")
        .select("doc_id", "key", "group"), "groups",
    )
    # plain tables, so that AQE can split the rows of a large group
    leaders = materialise(named.groupBy("group").agg(F.min(F.struct("doc_id", "key")).alias("first")), "first-of-groups")
    placed = named.join(leaders, "group").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "key", (F.col("key") == F.col("first.key")).alias("leads")
    )
    return placed.unionByName(signed.filter(F.col("doc_id").isNull()).select(
        "doc_id", F.lit(None).cast("long").alias("class_id"), "key", F.lit(True).alias("leads")
    ))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each group, with all its columns; rows without an id stay."""
    own, copy = unused(docs, "_own_key", "_copy_key")
    copies = materialise(
        grouped(docs, doc_id, text).filter("NOT leads").select(F.col("key").alias(copy)).distinct(), "copies"
    )
    return docs.withColumn(own, keyed(doc_id, text)).join(copies, F.col(own) == F.col(copy), "left_anti").drop(own)
