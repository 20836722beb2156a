"""Statistics of quality rules, one pass over the texts.

Words are runs of anything but ASCII white space. A repeated word lies in an 8-word window whose
words occur, in that order, at two or more places of the text; windows are compared by ranks of
word ids, without hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# fixed values
SPACE_BYTES = b" \t\n\x0b\x0c\r"
SYMBOL_BYTES = b"#*$%&|<>"
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_marks", "n_distinct")
_UPPER = bytes(range(65, 91))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def repeated_words(words: list[bytes], window: int = WINDOW) -> tuple[int, int]:
    """Number of words in repeated windows, and number of distinct words."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(words) <= window or len(known) == len(words):
        return 0, len(known)
    ranks, width = ids, 1
    while width < window:
        step = min(width, window - width)
        _, ranks, counts = np.unique(
            ranks[: len(ids) - width - step + 1] * len(ids) + ranks[step : len(ids) - width + 1],
            return_inverse=True, return_counts=True,
        )
        width += step
        if counts.max() == 1:
            return 0, len(known)
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(counts[ranks] > 1)
    edge[starts] += 1
    np.subtract.at(edge, starts + window, 1)
    return int((np.cumsum(edge)[:-1] > 0).sum()), len(known)


def statistics(text: str | None) -> tuple[int, ...]:
    """COUNTS and MORE of one text; null is empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    dense = raw.translate(None, SPACE_BYTES)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated, distinct = repeated_words(words)
    continued = 0 if raw.isascii() else _continuations(dense)
    return (
        len(words), len(dense) - continued, len(raw) - len(raw.translate(None, SYMBOL_BYTES)),
        len(lines) - len(set(lines)), repeated, len(lines),
        len(dense) - len(dense.translate(None, _UPPER)), len(dense) - len(dense.translate(None, _MARKS)),
        distinct,
    )


def _continuations(raw: bytes) -> int:
    """Bytes that don't begin a code point."""
    units = np.frombuffer(raw, np.uint8)
    return int(((units & 0xC0) == 0x80).sum())


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, COUNTS, MORE) of every row."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    names = (*COUNTS, *MORE)

    def run(batches):
        for batch in batches:
            rows = np.array(
                [statistics(t) for t in batch.column("text").to_pylist()], np.int64
            ).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in np.ascontiguousarray(rows.T)]],
                ["doc_id", *names],
            )

    return kept.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names))
