"""Repeated windows of units (bytes or words) over all texts, exactly.

Every window of W units has an anchor inside it that depends on the window alone, so equal windows
have equal anchors at equal distance. A document's anchors are few; one anchor serves a run of
windows, and the units these cover are its context. Anchors are counted by symbol over all texts; one
that stands once has no repeated window. The contexts of the others meet by symbol, with the places they
stand at, and are compared unit by unit: hashes only propose what may be equal.

As an anchor serves fewer than W windows in a row, the first and the last repeated one say what they
cover. A symbol with more than ``BUCKET`` rows is dealt to several buckets, each context by its own bytes;
contexts that stand twice are settled there, and the windows of the others are counted once more across the
buckets, by the SHA-256 of their bytes. Texts move once, compressed, and only those with repeated symbols
are kept."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfstream.llm.text import row_key
from shelfstream.llm.weighted_minhash import mix
from shelfstream.llm.word_ids import text_slabs
from shelfstream.session import materialise

BUCKET = 32768  # rows of a symbol for each bucket
_SLICE = 1 << 22  # bytes of contexts that are compared at once, if symbols allow
_TEXTS = 1000  # texts unpacked at once
_BASE = 0x9E3779B97F4A7C15
# 48 bits name an anchor: of 4e12 anchors, those of 100 TB, about one in a hundred meets another by chance
NAMES = np.uint64((1 << 48) - 1)


@dataclass(frozen=True)
class Kind:
    """What units are, how anchors are found in them and how contexts are told apart."""

    window: int
    slab_bytes: int
    # one number per unit of a slab of texts, equal for equal units, and the place of each text's first and the end
    units: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    # an order of the places, and the first and last place in a window that may be its anchor
    order: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, int, int]]
    # names of anchors, from the sums of the slab and their places
    symbol: Callable[[np.ndarray, np.ndarray], np.ndarray]
    # the units of a text's bytes, to cut from, and the bytes of units first..last-1
    parts: Callable[[bytes], bytes | list[bytes]]
    cut: Callable[[bytes | list[bytes], int, int], bytes]
    # units of contexts, as numbers that are equal if and only if the units are
    exact: Callable[[list[bytes]], list[np.ndarray]]
    # which contexts of a symbol may share a window
    likely: Callable[[list[np.ndarray]], np.ndarray] | None = None
    bucket: int = BUCKET


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_inverse = pow(_BASE, -1, 2**64)
_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n).bit_length())
    held = max(_cache, default=0)
    if held < size:
        _cache.clear()
        _cache[size] = _powers(size, _BASE), _powers(size, _inverse)
    return _cache[max(held, size)]


def prefix(units: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch follows."""
    out = np.zeros(len(units) + 1, np.uint64)
    mixed = _BYTES[units] if units.dtype == np.uint8 else mix(units)
    np.cumsum(mixed * _tables(len(units) + 1)[0][: len(units)], out=out[1:])
    return out


_BYTES = mix(np.arange(256, dtype=np.uint64))


def stretch(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of units first..last-1, which propose equal stretches and decide nothing."""
    return mix((sums[last] - sums[first]) * _tables(len(sums))[1][first] + (last - first).astype(np.uint64))


def stretches(sums: np.ndarray, width: int) -> np.ndarray:
    """The same of all stretches of one width, without looking up places that follow each other."""
    n = max(0, len(sums) - width)
    return mix((sums[width:] - sums[:n]) * _tables(len(sums))[1][:n] + np.uint64(width))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    out, size = values, 1
    while size * 2 <= width:
        out, size = np.minimum(out[:-size], out[size:]), size * 2
    rest = width - size
    return np.minimum(out[: len(values) - width + 1], out[rest : rest + len(values) - width + 1]) if rest else out


@dataclass
class Found:
    """Anchors of a slab: text, first and last window and place of each inside its text, and symbol."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    symbol: np.ndarray


def find(kind: Kind, texts: pa.Array) -> Found | None:
    units, bounds = kind.units(texts)
    n = len(units) - kind.window + 1
    if n <= 0:
        return None
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    sums = prefix(units)
    order, low, high = kind.order(units, sums)
    bits = np.uint64(0xFFFFFFFF)
    ranked = (order[low : high + n] & ~bits) | np.arange(high - low + n, dtype=np.uint64)
    least = sliding_least(ranked, high - low + 1)  # the place of the least order in a window, leftmost of equals
    starts = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (owner[1:n] != owner[: n - 1])])
    text = owner[starts]
    ends = np.minimum(np.r_[starts[1:], n] - 1, bounds[text + 1] - kind.window)
    inside = ends >= starts  # windows over the end of a text are none
    starts, ends, text = starts[inside], ends[inside], text[inside]
    place = (least[starts] & bits).astype(np.int64) + low
    base = bounds[text]
    return Found(text, starts - base, ends - base, place - base, (kind.symbol(sums, place) & NAMES).view(np.int64))


def _anchors(rows: DataFrame, kind: Kind) -> DataFrame:
    """(key, place, symbol) of all anchors."""

    def run(batches):
        for batch in batches:
            done, keys = 0, batch.column("key").to_numpy(zero_copy_only=False)
            for slab in text_slabs(batch.column("text"), kind.slab_bytes):
                if (found := find(kind, slab)) is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[done + found.text]), pa.array(found.place.astype(np.int32)), pa.array(found.symbol)],
                        ["key", "place", "symbol"],
                    )
                done += len(slab)

    return rows.select("key", "text").mapInArrow(run, "key long, place int, symbol long")


def _packed(rows: DataFrame) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            packed = [zlib.compress(t.encode("utf-8", "surrogatepass"), 1) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array(packed, pa.binary())], ["key", "doc_id", "packed"]
            )

    return rows.mapInArrow(run, f"key long, doc_id {kind}, packed binary")


def unpack(packed: bytes) -> str:
    return zlib.decompress(packed).decode("utf-8", "surrogatepass")


# stands: the keys of the texts a context stands in, 8 bytes each, and then its anchor's places there, 4 bytes each
_CONTEXT = "symbol long, bucket int, offset int, units binary, stands binary"
_CONTEXT_ROW = pa.schema([
    ("symbol", pa.int64()), ("bucket", pa.int32()), ("offset", pa.int32()), ("units", pa.binary()), ("stands", pa.binary()),
])


def _contexts(moved: DataFrame, kind: Kind) -> DataFrame:
    """Contexts of repeated symbols with the places they stand at; equal ones of a slab are one row. The
    bucket is -1 unless the symbol is dealt out."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                keys, packed, wanted = (
                    batch.column(c).slice(at, _TEXTS).to_pylist() for c in ("key", "packed", "wanted")
                )
                texts, done = pa.array([unpack(p) for p in packed], pa.string()), 0
                for slab in text_slabs(texts, kind.slab_bytes):
                    if (found := find(kind, slab)) is not None:
                        own = slice(done, done + len(slab))
                        yield _cut(kind, found, slab.cast(pa.binary()).to_pylist(), keys[own], wanted[own])
                    done += len(slab)

    return moved.select("key", "packed", "wanted").mapInArrow(run, _CONTEXT)


def _cut(kind: Kind, found: Found, texts: list[bytes], keys: list[int], wanted: list[list[dict]]) -> pa.RecordBatch:
    often = {(t << 32) | w["place"]: w["n"] for t, ws in enumerate(wanted) for w in ws}
    codes = (found.text.astype(np.int64) << 32) | found.place
    chosen = np.flatnonzero(np.isin(codes, np.fromiter(often, np.int64, len(often))))
    held: dict[tuple, tuple[list, list]] = {}
    at, parts = -1, None
    columns = (found.text, found.first, found.last, found.place, found.symbol, codes)
    for t, first, last, place, symbol, code in zip(*[c[chosen].tolist() for c in columns]):
        if t != at:
            at, parts = t, kind.parts(texts[t])
        units = kind.cut(parts, first, last + kind.window)
        n = often[code]
        bucket = -1 if n <= kind.bucket else zlib.crc32(units) % -(-n // kind.bucket)
        row = held.setdefault((symbol, bucket, place - first, units), ([], []))
        row[0].append(keys[t])
        row[1].append(place)
    stands = [struct.pack(f"<{len(k)}q{len(k)}i", *k, *p) for k, p in held.values()]
    columns = [*zip(*held), stands] if held else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CONTEXT_ROW)], schema=_CONTEXT_ROW)


_SPAN = "key long, place int, a int, b int, hash binary"
_SPAN_ROW = pa.schema([("key", pa.int64()), ("place", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("hash", pa.binary())])


def _spans(contexts: DataFrame, kind: Kind) -> DataFrame:
    """(key, place, a, b, hash): units a..b-1 of a text that repeated windows of an anchor cover, place and hash
    null; of a symbol that is dealt out, every window that its bucket did not settle, with its anchor's place and
    a hash of its bytes. Such a row without a key only bears witness."""

    def run(batches):
        held: list[tuple] = []
        size = 0

        def groups(final: bool):
            nonlocal held, size
            ends = [i for i in range(1, len(held)) if held[i][:2] != held[i - 1][:2]] + [len(held)] * final
            done = ends[-1] if ends else 0
            rows = [x for a, b in zip([0, *ends], ends) if b > a for x in _compare(held[a:b], kind)]
            held = held[done:]
            size = sum(len(x[3]) for x in held)
            cols = list(zip(*rows)) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SPAN_ROW)], schema=_SPAN_ROW)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _CONTEXT_ROW.names)):
                held.append(row)
                size += len(row[3])
                if size > _SLICE:
                    yield groups(False)
        if held:
            yield groups(True)

    return contexts.mapInArrow(run, _SPAN)


def _compare(rows: list[tuple], kind: Kind) -> Iterator[tuple]:
    known: dict[tuple, tuple[list, list]] = {}
    for _, _, offset, units, stands in rows:
        n = len(stands) // 12
        both = struct.unpack(f"<{n}q{n}i", stands)
        place = known.setdefault((offset, units), ([], []))
        place[0].extend(both[:n])
        place[1].extend(both[n:])
    dealt = rows[0][1] >= 0
    if len(known) == 1 and len(next(iter(known.values()))[0]) == 1 and not dealt:
        return
    exact = kind.exact([units for _, units in known]) if len(known) > 1 or dealt else [None]
    stand = list(known.values())
    offsets = [offset for offset, _ in known]
    for (offset, units), (keys, places), part in zip(known, stand, exact):
        if len(keys) > 1:  # the same context, byte for byte, at several places
            length = len(part if part is not None else kind.exact([units])[0])
            yield from ((k, None, p - offset, p - offset + length, None) for k, p in zip(keys, places))
    if dealt:
        for (offset, units), (keys, places), part in zip(known, stand, exact):
            pieces = kind.parts(units)
            for s in range(len(part) - kind.window + 1):
                digest = hashlib.sha256(b"%d " % (s - offset) + kind.cut(pieces, s, s + kind.window)).digest()
                key, place = (keys[0], places[0]) if len(keys) == 1 else (None, None)
                a = None if place is None else place - offset + s
                yield key, place, a, None if a is None else a + kind.window, digest
        return
    if len(known) == 1:
        return
    likely = kind.likely(exact) if kind.likely else np.full(len(exact), True)
    chosen = np.flatnonzero(likely).tolist()
    if len(chosen) < 2:
        return
    for i, (low, high) in repeated([exact[i] for i in chosen], [offsets[i] for i in chosen], kind.window).items():
        keys, places = stand[chosen[i]]
        if len(keys) == 1:
            a = places[0] - offsets[chosen[i]]
            yield keys[0], None, a + low, a + high + kind.window, None


def repeated(parts: list[np.ndarray], offsets: list[int], window: int) -> dict[int, tuple[int, int]]:
    """For each part that shares a window with another, at the same distance from its anchor: the first and
    the last such window. Windows of equal hash are proposed, and compared unit by unit."""
    flat = np.concatenate(parts)
    base = np.cumsum([0, *[len(p) for p in parts]])
    sums = prefix(flat)
    counts = [len(p) - window + 1 for p in parts]
    tag = np.repeat(np.arange(len(parts)), counts)
    start = np.arange(sum(counts)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = base[tag] + start
    hashes = mix(stretch(sums, at, at + window) + (start - np.array(offsets)[tag]).astype(np.uint64))
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    opens = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    size = np.diff(np.r_[opens, len(ranked)])
    # each window's partner: the next one of its hash, of the last one the first
    follow = np.arange(1, len(ranked) + 1)
    follow[opens + size - 1] = opens
    partner = np.empty(len(ranked), np.int64)
    partner[order] = order[follow]
    mine = np.flatnonzero(partner != np.arange(len(partner)))
    if not len(mine):
        return {}
    other = partner[mine]
    same_run = (
        (np.diff(mine) == 1) & (np.diff(other) == 1) & (tag[mine][1:] == tag[mine][:-1]) & (tag[other][1:] == tag[other][:-1])
    )
    first = np.flatnonzero(np.r_[True, ~same_run])
    last = np.r_[first[1:], len(mine)] - 1
    for x, y, length in zip(at[mine[first]].tolist(), at[other[first]].tolist(), (last - first + window).tolist()):
        if not np.array_equal(flat[x : x + length], flat[y : y + length]):
            return _repeated_plainly(parts, offsets, window)
    tags, starts = tag[mine], start[mine]
    edges = np.flatnonzero(np.r_[True, tags[1:] != tags[:-1]])
    ends = np.r_[edges[1:], len(tags)] - 1
    return {int(tags[a]): (int(starts[a]), int(starts[b])) for a, b in zip(edges, ends)}


def _repeated_plainly(parts: list[np.ndarray], offsets: list[int], window: int) -> dict[int, tuple[int, int]]:
    """The same by the windows' own bytes, for when a hash proposed what is not equal."""
    seen: dict[tuple, list] = {}
    for i, (part, offset) in enumerate(zip(parts, offsets)):
        for s in range(len(part) - window + 1):
            seen.setdefault((s - offset, part[s : s + window].tobytes()), []).append((i, s))
    out: dict[int, tuple[int, int]] = {}
    for i, s in sorted(x for group in seen.values() if len(group) > 1 for x in group):
        out[i] = (out.get(i, (s, s))[0], s)
    return out


def covered(docs: DataFrame, kind: Kind, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, marked): rows are (key, doc_id, text); marked, for those with repeated windows,
    (key, doc_id, packed, found): the text compressed, and the stretches of units to remove, which may
    overlap."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    rows = rows.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    anchors = materialise(_anchors(rows, kind), "anchors")
    # a plain table, so that AQE can split the anchors of a hot symbol
    again = materialise(anchors.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated-symbols")
    wanted = anchors.join(again, "symbol").groupBy("key").agg(F.collect_set(F.struct("place", "n")).alias("wanted"))
    moved = materialise(_packed(rows).join(wanted, "key"), "texts-with-repeats")
    contexts = _contexts(moved, kind)
    met = contexts.repartition("symbol", "bucket").sortWithinPartitions("symbol", "bucket")
    spans = materialise(_spans(met, kind), "spans")
    dealt = spans.filter("hash IS NOT NULL")
    twice = materialise(dealt.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "repeated-windows")
    across = dealt.filter("key IS NOT NULL").join(twice, "hash").groupBy("key", "place").agg(
        F.min("a").alias("a"), F.max("b").alias("b")
    )
    found = spans.filter("hash IS NULL").select("key", "a", "b").unionByName(across.select("key", "a", "b"))
    marked = moved.select("key", "doc_id", "packed").join(
        found.groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("found")), "key"
    )
    return rows, marked


def removed(n_units: int, found: list[dict]) -> np.ndarray:
    """Which of a text's units lie in repeated windows."""
    edge = np.zeros(n_units + 1, np.int64)
    np.add.at(edge, [x["a"] for x in found], 1)
    np.add.at(edge, [x["b"] for x in found], -1)
    return np.cumsum(edge)[:-1] > 0
