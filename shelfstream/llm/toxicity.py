"""Toxicity by the nearest labelled examples.

Examples are a sample of the labelled rows of at most ``TOXIC`` toxic and ``CLEAN`` other rows, those
with the smallest hash of their id; up to ``CALIBRATE`` further labelled rows calibrate. Terms are the
examples' words and beginnings of words; their document frequencies are counted over all documents,
and terms outside ``RARE`` to ``COMMON`` are left out. Texts are vectors of
``(1 + ln tf) * idf * told`` of length 1, ``told`` being how far the shares of toxic and of clean examples
with the term lie apart, in standard errors: the nearest examples are alike in what tells the labels
apart, not in language or subject. The inverted index keeps its postings in blocks of ``BLOCK`` examples
and, per term and block, the largest weight. A query adds up these maxima to bound each block, reads
blocks from the highest bound on, and stops when no block left can reach its k-th best: the cosines of
the ``K`` nearest are exact. Their labels, weighted by the squared cosine, give a vote, and a logistic
curve fitted on the calibration rows turns it into a score.

Defined cases: null text is empty; a text without a known term has vote 0; rows without an id aren't
held out; without labels of both kinds every score is the share of toxic labels (0 without labels)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfstream.llm.plain import plain_words
from shelfstream.llm.text import first_by_hash
from shelfstream.llm.word_ids import text_slabs
from shelfstream.session import materialise

TOXIC, CLEAN, CALIBRATE = 1024, 1024, 3000
# terms are words and the first PREFIX bytes of longer ones, in this share of all documents
PREFIX, RARE, COMMON = 7, 0.002, 0.2
BLOCK, K = 64, 15
CUT = 0.3
SLAB_BYTES = 1 << 20  # of texts that are Python strings at once
POWER = 2.0


def remainder(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 4; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4, F.lit(0))


def features(text: str | None) -> list[bytes]:
    """Words and beginnings of longer words."""
    words = plain_words(text)
    return words + [b"^" + w[:PREFIX] for w in words if len(w) > PREFIX]


def counts(text: str | None, terms: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Known terms of a text, ascending, and how often each stands in it."""
    found = [t for t in map(terms.get, features(text)) if t is not None]
    return np.unique(np.array(found, np.int64), return_counts=True)


def told(found: list[np.ndarray], labels: np.ndarray, terms: int) -> np.ndarray:
    """Of each term, how many standard errors the shares of toxic and of clean examples that have it differ by."""
    shares, errors = [], 0.0
    for value in (0, 1):
        own = [t for t, label in zip(found, labels) if label == value]
        held = np.bincount(np.concatenate([np.zeros(0, np.int64), *own]), minlength=terms)
        share = (held + 0.5) / (len(own) + 1)
        shares.append(share)
        errors = errors + share * (1 - share) / max(len(own), 1)
    return np.abs(shares[1] - shares[0]) / np.sqrt(errors)


class Index:
    """Block-max inverted index over the examples."""

    def __init__(self, texts: list[str], labels: np.ndarray, terms: dict[bytes, int], idf: np.ndarray):
        found = [counts(t, terms) for t in texts]
        idf = idf * told([t for t, _ in found], labels, len(terms))
        self.terms, self.idf, self.labels = terms, idf.astype(np.float32), labels.astype(np.float32)
        n, v = len(texts), len(terms)
        self.blocks = max(1, -(-n // BLOCK))
        term, example, weight = [], [], []
        for i, known in enumerate(found):
            t, w = self.vector(*known)
            term.append(t)
            example.append(np.full(len(t), i))
            weight.append(w)
        term, example, weight = map(np.concatenate, (term, example, weight))
        order = np.lexsort((example, term))
        term, self.example, self.weight = term[order], example[order].astype(np.int32), weight[order]
        cell = term * self.blocks + self.example // BLOCK
        self.starts = np.searchsorted(cell, np.arange(v * self.blocks + 1)).astype(np.int32)
        self.most = np.zeros(v * self.blocks, np.float32)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(v, self.blocks)
        self.curve = (0.0, 0.0)

    def vector(self, terms: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = (1 + np.log(often)) * self.idf[terms]
        length = np.sqrt((weight**2).sum())
        return terms, (weight / length if length > 0 else weight).astype(np.float32)

    def cosines(self, terms: np.ndarray, weight: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Examples of the given blocks and their cosines."""
        cells = (terms[:, None] * self.blocks + blocks[None, :]).ravel()
        first, lengths = self.starts[cells], self.starts[cells + 1] - self.starts[cells]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat(first - ends + lengths, lengths)
        sums = np.bincount(
            self.example[places], self.weight[places] * np.repeat(np.repeat(weight, len(blocks)), lengths),
            len(self.labels),
        )
        members = (blocks[:, None] * BLOCK + np.arange(BLOCK)[None, :]).ravel()
        members = members[members < len(self.labels)]
        return members, sums[members]

    def nearest(self, text: str | None, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above 0, best first; ties by example number."""
        terms, weight = self.vector(*counts(text, self.terms))
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = weight @ self.most[terms]
        order = np.argsort(-bounds, kind="stable")
        found, cosine, step, at = np.zeros(0, np.int64), np.zeros(0), 4, 0
        while at < len(order):
            if len(found) >= k and bounds[order[at]] * (1 + 1e-5) < cosine[k - 1]:
                break
            more, cos = self.cosines(terms, weight, order[at : at + step])
            found, cosine = np.concatenate([found, more]), np.concatenate([cosine, cos])
            best = np.lexsort((found, -cosine))[:k]
            found, cosine, at, step = found[best], cosine[best], at + step, 2 * step
        return found[cosine > 0], cosine[cosine > 0]

    def vote(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        found, cosine = self.nearest(text)
        weight = cosine**POWER
        return (float((weight * self.labels[found]).sum() / weight.sum()) if len(found) else 0.0), found, cosine

    def score(self, vote: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] * vote + self.curve[1])))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and constant of a logistic curve, by Newton steps with a small ridge."""
    a = np.column_stack([x, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[Index | None, list, float]:
    """The index (None without labels of both kinds), the examples' ids, the share of toxic labels."""
    spark = docs.sparkSession
    known = (
        labels.select(F.col("doc_id").alias("_labelled"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & F.col("_labelled").isNotNull() & (remainder("_labelled") != 2))
        .groupBy("_labelled").agg(F.max("toxic").alias("toxic"))  # an id labelled both ways is toxic
    )
    known = materialise(known, "labels")
    part = [
        first_by_hash(known.filter(F.col("toxic") == value), F.xxhash64("_labelled"), most, "_labelled")
        .withColumn("use", F.lit(1))
        for value, most in ((1, TOXIC), (0, CLEAN))
    ]
    natural = first_by_hash(known, F.xxhash64("_labelled", F.lit(1)), CALIBRATE, "_labelled").withColumn("use", F.lit(0))
    chosen = materialise(part[0].unionByName(part[1]).unionByName(natural), "labelled-sample")
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    rows = (
        chosen.join(texts.join(F.broadcast(chosen.select("_labelled").distinct()), F.col("_id") == F.col("_labelled"), "left_semi"),
                    F.col("_id") == F.col("_labelled"))
        .select("_labelled", "toxic", "use", "_text").distinct().toPandas()
        .sort_values(["use", "toxic", "_labelled", "_text"], na_position="first")
    )
    share = float(rows["toxic"].mean()) if len(rows) else 0.0
    examples, rest = rows[rows["use"] == 1], rows[rows["use"] == 0]
    rest = rest[~rest["_labelled"].isin(examples["_labelled"])]
    if examples["toxic"].nunique() < 2:
        return None, [], share
    terms = {w: i for i, w in enumerate(sorted({w for t in examples["_text"] for w in features(t)}))}
    n, frequency = document_frequencies(docs, terms, text)
    usual = (frequency >= RARE * n) & (frequency <= COMMON * n)
    terms = {w: i for i, w in enumerate(w for w, use in zip(terms, usual) if use)}
    frequency = frequency[usual]
    if not terms:
        return None, [], share
    index = Index(list(examples["_text"]), examples["toxic"].to_numpy(), terms, np.log((1 + n) / (1 + frequency)) + 1e-3)
    tuned = rest if rest["toxic"].nunique() == 2 else examples
    votes = np.array([index.vote(t)[0] for t in tuned["_text"]])
    index.curve = logistic(votes, tuned["toxic"].to_numpy(np.float64))
    return index, [int(x) for x in examples["_labelled"]], share


def document_frequencies(docs: DataFrame, terms: dict[bytes, int], text: str = "text") -> tuple[int, np.ndarray]:
    """Number of documents, and of those that have each term. Tasks count before the shuffle; what
    comes to the driver is one number per term of the bounded examples."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        known = shared.value
        held, rows = np.zeros(len(known), np.int64), 0
        for batch in batches:
            for slab in text_slabs(batch.column("text"), SLAB_BYTES):
                for t in slab.to_pylist():
                    held[counts(t, known)[0]] += 1
                rows += len(slab)
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(held[seen], rows))], ["term", "n"]
        )

    found = (
        docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "term long, n long")
        .groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    )
    out = np.zeros(len(terms) + 1, np.int64)
    out[found["term"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return int(out[-1]), out[:-1]


def scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, vote, score, predicted, and its evidence: the nearest examples'
    ids and cosines."""
    index, ids, share = fit(docs, labels, doc_id, text)
    return score_with(docs, index, ids, share, doc_id, text)


def score_with(docs: DataFrame, index: Index | None, ids: list, share: float, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((index, np.array(ids, np.int64)))

    def run(batches):
        made, names = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            votes = [made.vote(t) for t in texts] if made else [(0.0, [], [])] * len(texts)
            v = np.array([x[0] for x in votes])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(v), pa.array(made.score(v) if made else np.full(len(v), share)),
                pa.array([names[x[1]].tolist() if made else [] for x in votes], pa.list_(pa.int64())),
                pa.array([[float(c) for c in x[2]] for x in votes], pa.list_(pa.float64())),
            ], ["doc_id", "vote", "score", "near_ids", "near_cosines"])

    scored = kept.mapInArrow(
        run, f"doc_id {kind}, vote double, score double, near_ids array<long>, near_cosines array<double>"
    )
    return scored.select(
        "doc_id", (remainder("doc_id") == 2).alias("held_out"), "vote", "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"), "near_ids", "near_cosines",
    )


def reject_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents not predicted toxic, with all their columns; no shuffle of texts."""
    index, _, share = fit(docs, labels, doc_id, text)
    if index is None:
        return docs if share < CUT else docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    place, kind = docs.columns.index(text), docs.schema

    def run(batches):
        made = shared.value
        for batch in batches:
            slabs = text_slabs(batch.column(place).cast(pa.string()), SLAB_BYTES)
            v = np.array([made.vote(t)[0] for slab in slabs for t in slab.to_pylist()])
            yield batch.filter(pa.array(made.score(v) < CUT))

    return docs.mapInArrow(run, kind)
