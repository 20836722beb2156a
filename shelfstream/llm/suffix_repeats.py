"""Suffix-array dedup: bytes that lie in a repeated 200-byte string are removed.

Candidates are contexts of shared anchors (see repeats.py), the anchor of a 200-byte window being its
80-byte string of least hash. In each bucket the contexts are cut into tokens behind white space and
punctuation, and a suffix array of all of them is built by Lyndon grouping (suffix_sorting.py). A
context stays if a suffix, the token before it and the token behind its longest common prefix can reach
200 bytes; its windows are then compared byte by byte. Cuts depend on bytes alone, so no repeat is lost.

Defined cases: null text is empty; texts under 200 bytes keep all; strings never cross documents;
equal rows repeat each other; rows that share id and text have the same result; other columns are not
looked at; an empty table gives no row."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfstream.llm import repeats
from shelfstream.llm.suffix_sorting import common_prefixes, suffix_array

WINDOW, GRAM = 200, 80
SLAB_BYTES = 1 << 18  # the numbers of a slab, 8 bytes for each of its own, stay in a core's cache


def byte_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a slab of texts, and the place of each text's first byte and the end."""
    edges = np.frombuffer(texts.buffers()[1], np.int32, texts.offset + len(texts) + 1)[texts.offset :].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8, int(edges[-1]))
    return data[edges[0] :], edges - edges[0]


def byte_order(units: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, int, int]:
    return repeats.stretches(sums, GRAM), 0, WINDOW - GRAM


def byte_symbol(sums: np.ndarray, place: np.ndarray) -> np.ndarray:
    return repeats.stretch(sums, place, place + GRAM)


def likely(parts: list[np.ndarray]) -> np.ndarray:
    """Which contexts can share a window with another or with themselves, by their suffix array."""
    names: dict[bytes, int] = {}
    text, length, owner = [], [], []
    for i, part in enumerate(parts):
        raw, cuts = part.tobytes(), np.flatnonzero(part < 48) + 1
        edges = [0, *cuts.tolist(), len(part)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                text.append(names.setdefault(raw[a:b], len(names)))
                length.append(b - a)
                owner.append(i)
        text.append(-1 - i)  # ends differ from all else, so nothing common crosses them
        length.append(0)
        owner.append(i)
    order = suffix_array(text)
    common = common_prefixes(text, order)
    lengths = np.array(length)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    order_, common_ = np.array(order), np.array([*common, 0])
    shared = np.maximum(common_[:-1], common_[1:])
    begin = np.maximum(order_ - 1, 0)  # ends have no length, so a part's first token has nothing before it
    behind = np.minimum(order_ + shared, len(text) - 1)
    reach = np.where(order_ > 0, lengths[begin], 0) + ends[order_ + shared] - ends[order_] + lengths[behind]
    out = np.zeros(len(parts), bool)
    out[np.array(owner)[order_[reach >= WINDOW]]] = True
    return out


BYTES = repeats.Kind(
    WINDOW, SLAB_BYTES, byte_units, byte_order, byte_symbol, lambda text: text, lambda text, first, last: text[first:last],
    lambda contexts: [np.frombuffer(c, np.uint8) for c in contexts], likely,
)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept, the bytes that remain (null
    where nothing was removed)."""
    rows, marked = repeats.covered(docs, BYTES, doc_id, text)
    whole = rows.select(
        "key", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    ).join(marked.select("key").distinct(), "key", "left_anti")
    whole = whole.select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        "kept_sha256", F.lit(None).cast("binary").alias("kept"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for packed, found in zip(*(batch.column(c).to_pylist() for c in ("packed", "found"))):
                raw = np.frombuffer(repeats.unpack(packed).encode("utf-8", "surrogatepass"), np.uint8)
                gone = repeats.removed(len(raw), found)
                kept = raw[~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(gone), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(zip(*out), _TYPES)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return whole.unionByName(marked.select("doc_id", "packed", "found").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    ))


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
