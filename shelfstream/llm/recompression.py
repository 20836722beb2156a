"""Substring dedup by recompression: words that lie in a repeated 35-word window are removed.

In each of three rounds every symbol falls on one of two sides, by a bit of its name, and a left symbol
followed by a right one becomes one symbol. A name is a hash of the names it is made of, so equal
substrings get equal names everywhere without a dictionary; only symbols within seven words of a
substring's ends can differ. The name of a run would depend on where it ends, which a window need not
see, so equal neighbours, always on one side, stay as they are. Of a 35-word window the symbols that begin 7 to 20 words in are the same
wherever it stands; the least of them is its anchor, named with the words around it that all its windows
hold. Anchors that two places share reveal repeats, and windows are then compared word by word (see repeats.py).

Defined cases: null text is empty; texts under 35 words keep all; windows never cross documents; rows
that share id and text have the same result; other columns are not looked at; an empty table gives no row."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from shelfstream.llm import repeats
from shelfstream.llm.text import words
from shelfstream.llm.weighted_minhash import mix

WINDOW, ROUNDS = 35, 3
MARGIN = 2**ROUNDS - 1
LONGEST = 2**ROUNDS
SLAB_BYTES = 2 << 20


def word_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of a slab of texts, and the place of each text's first word and the end. Distinct
    words are hashed once a slab."""
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy().astype(np.int64)
    flat = split.flatten()
    there = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False), dtype=np.int64)])
    coded = flat.filter(there).dictionary_encode()
    names = coded.dictionary.cast(pa.binary())
    edges = np.frombuffer(names.buffers()[1], np.int32, len(names) + 1) if len(names) else np.zeros(1, np.int32)
    data = np.frombuffer(names.buffers()[2] or b"", np.uint8, int(edges[-1])) if len(names) else np.zeros(0, np.uint8)
    hashes = repeats.stretch(repeats.prefix(data), edges[:-1], edges[1:])
    return hashes[coded.indices.to_numpy(zero_copy_only=False)], kept[bounds - bounds[0]]


def recompress(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the symbols after all rounds, and where each begins."""
    name, start = mix(units), np.arange(len(units))
    for k in range(ROUNDS):
        left = mix(name + np.uint64(k + 1)) >> np.uint64(63) == 0
        pair = np.flatnonzero(left[:-1] & ~left[1:])
        name = name.copy()
        name[pair] = mix(name[pair] + mix(name[pair + 1] + np.uint64(k + 1)))
        keep = np.full(len(name), True)
        keep[pair + 1] = False
        name, start = name[keep], start[keep]
    return name, start


def word_order(units: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, int, int]:
    name, start = recompress(units)
    order = np.full(len(units), np.iinfo(np.uint64).max, np.uint64)
    order[start] = name
    # a window's inner words begin MARGIN in; the last symbol that surely ends there begins LONGEST before
    return order, MARGIN, WINDOW - MARGIN - LONGEST


def word_symbol(sums: np.ndarray, place: np.ndarray) -> np.ndarray:
    """All windows that an anchor serves hold the words around it, so these can tell anchors apart."""
    return repeats.stretch(sums, place - MARGIN, place + MARGIN + LONGEST)


def exact_words(contexts: list[bytes]) -> list[np.ndarray]:
    """Contexts as numbers of words, equal for equal words of the same call."""
    numbers: dict[bytes, int] = {}
    return [
        np.array([numbers.setdefault(w, len(numbers)) for w in c.split(b" ")], np.uint64) for c in contexts
    ]


WORDS = repeats.Kind(
    WINDOW, SLAB_BYTES, word_units, word_order, word_symbol, bytes.split,
    lambda split, first, last: b" ".join(split[first:last]), exact_words,
)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, and kept, the words that remain (null where
    nothing was removed)."""
    rows, marked = repeats.covered(docs, WORDS, doc_id, text)
    split = rows.select("key", "doc_id", words(F.col("text")).alias("words"))
    whole = split.select(
        "key", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.sha2(F.concat_ws(" ", "words").cast("binary"), 256).alias("kept_sha256"),
    ).join(marked.select("key").distinct(), "key", "left_anti")
    whole = whole.select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("binary").alias("kept")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for packed, found in zip(*(batch.column(c).to_pylist() for c in ("packed", "found"))):
                split = repeats.unpack(packed).encode("utf-8", "surrogatepass").split()
                gone = repeats.removed(len(split), found)
                kept = b" ".join(w for w, g in zip(split, gone.tolist()) if not g)
                out.append((len(gone), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(zip(*out), _TYPES)]],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return whole.unionByName(marked.select("doc_id", "packed", "found").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept binary"
    ))


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
