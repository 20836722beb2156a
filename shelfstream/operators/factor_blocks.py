"""Half steps of alternating least squares over blocks of ids.

Ratings are packed once per side: a chunk holds ratings of one block of the ids to solve for and of one
slice of the given ids. A half step sends every block its chunks and the vectors it needs, one copy per
block, and adds up the normal equations of the block's ids slice by slice. So a task holds the sums of its
own ids and the vectors of one slice. Ratings of an id with more than a share of a block's are dealt over all
blocks by the given id; the blocks' sums of such ids are added up afterwards."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfstream.session import materialise

# what a block may hold, and how few blocks there are
LEAST_BLOCKS, BLOCK_BYTES, BLOCK_RATINGS = 4, 256_000_000, 32_000_000
SLICE_IDS = 250_000
BUFFER = 500_000  # ratings packed at a time
PIECE = 40_000  # ratings added up at a time
# up to here every vector goes to every block; behind it a table tells who needs which
ALL_BLOCKS = 16
HOT_BUCKETS = 1 << 16
PACKED = "_block int, _slice int, _kind int, _data binary"
SUMMED = "id long, features array<float>, sums array<double>, n long"


def mixed(ids: np.ndarray) -> np.ndarray:
    """64 well-mixed bits per id."""
    x = ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Side:
    """The ratings as one direction of half steps reads them."""

    solve_for: str
    given: str
    blocks: int
    slices: int
    hot: tuple[int, ...]  # ids to solve for whose ratings lie in all blocks
    chunks: DataFrame | None = None
    needs: DataFrame | None = None  # (id, _blocks) of the given ids; None: all


def _places(side: Side, solved: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block and slice of ratings."""
    by_given = mixed(given)
    hashed = mixed(solved)
    if side.hot:
        hashed = np.where(np.isin(solved, side.hot), by_given, hashed)
    return (hashed % np.uint64(side.blocks)).astype(np.int64), _slices(side, by_given)


def _slices(side: Side, hashed: np.ndarray) -> np.ndarray:
    return ((hashed >> np.uint64(32)) % np.uint64(side.slices)).astype(np.int64)


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes as the largest needs, byte by byte of all."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def _wide(raw: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    width = raw[at]
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :width] = np.frombuffer(raw, np.uint8, width * n, at + 1).reshape(width, n).T
    return planes.view("<u8")[:, 0].astype(np.int64), at + 1 + width * n


def _rising(ids: np.ndarray) -> bytes:
    """Rising ids: the first, then steps."""
    return np.int64(ids[0]).tobytes() + _narrow(np.diff(ids).view(np.uint64))


def _risen(raw: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    first = np.frombuffer(raw, np.int64, 1, at)
    steps, at = _wide(raw, at + 8, n - 1)
    return np.cumsum(np.concatenate([first, steps])), at


def pack(solved: np.ndarray, given: np.ndarray, rating: np.ndarray) -> bytes:
    """A chunk: its rows by solved id, given ids and ratings by their number in a list of distinct ones."""
    order = np.argsort(solved, kind="stable")
    ids, at = np.unique(given[order], return_inverse=True)
    values, which = np.unique(rating[order].view(np.int64), return_inverse=True)
    head = np.array([len(order), len(ids), len(values)], np.int64).tobytes()
    body = _rising(solved[order]) + _rising(ids) + _narrow(at) + values.tobytes() + _narrow(which)
    return zlib.compress(head + body, 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Solved ids of the rows, distinct given ids, numbers in these, ratings."""
    raw = zlib.decompress(data)
    n, n_ids, n_values = np.frombuffer(raw, np.int64, 3)
    solved, at = _risen(raw, 24, int(n))
    ids, at = _risen(raw, at, int(n_ids))
    place, at = _wide(raw, at, int(n))
    values = np.frombuffer(raw, np.float64, int(n_values), at)
    which, _ = _wide(raw, at + 8 * int(n_values), int(n))
    return solved, ids, place, values[which]


def _groups(*keys: np.ndarray) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """Rows of each combination of keys."""
    if not len(keys[0]):
        return
    order = np.lexsort(keys[::-1])
    ordered = [k[order] for k in keys]
    new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in ordered], axis=0)) + 1
    for part in np.split(np.arange(len(order)), new):
        yield tuple(int(k[part[0]]) for k in ordered), order[part]


def _packed(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), (), ())
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["_block", "_slice", "_kind", "_data"]
    )


def _buffered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _chunks(side: Side):
    def run(batches):
        for rows in _buffered(batches, BUFFER):
            solved, given, rating = (rows.column(c).to_numpy() for c in (side.solve_for, side.given, "rating"))
            block, part = _places(side, solved, given)
            for (b, s), at in _groups(block, part):
                yield _packed([
                    (b, s, 1, pack(solved[k], given[k], rating[k]))
                    for k in np.split(at, range(PIECE, len(at), PIECE))
                ])

    return run


def _pairs(side: Side):
    def run(batches):
        for rows in _buffered(batches, BUFFER):
            given = rows.column(side.given).to_numpy()
            block, _ = _places(side, rows.column(side.solve_for).to_numpy(), given)
            pairs = np.unique(np.stack([given, block]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1].astype(np.int32))], ["id", "_block"])

    return run


def hot_ids(ratings: DataFrame, key: str, most: int) -> tuple[int, ...]:
    """Ids with more than ``most`` rows. Only ids of buckets with as many are counted one by one, so the list is
    no longer than rows / most."""
    bucket = F.pmod(F.xxhash64(key), F.lit(HOT_BUCKETS))
    n = F.count(F.lit(1)).alias("n")
    full = [r[0] for r in ratings.groupBy(bucket.alias("_b")).agg(n).filter(F.col("n") > most).collect()]
    if not full:
        return ()
    counts = ratings.filter(bucket.isin(full)).groupBy(key).agg(n).filter(F.col("n") > most)
    return tuple(sorted(r[0] for r in counts.select(key).collect()))


def lay_out(ratings: DataFrame, solve_for: str, given: str, n_sums: int, hot_share: float = 0.25) -> Side:
    """Pack ratings (two long ids and a double, no nulls) for half steps that solve for one side."""
    about = F.approx_count_distinct  # only sizes blocks and slices
    n, n_solved, n_given = ratings.agg(F.count(F.lit(1)), about(solve_for), about(given)).first()
    blocks = max(LEAST_BLOCKS, math.ceil(n_solved * n_sums * 8 / BLOCK_BYTES), math.ceil(n / BLOCK_RATINGS))
    hot = hot_ids(ratings, solve_for, max(1000, int(hot_share * n / blocks)))
    side = Side(solve_for, given, blocks, max(1, math.ceil(n_given / SLICE_IDS)), hot)
    chunks = materialise(ratings.select(solve_for, given, "rating").mapInArrow(_chunks(side), PACKED), "als-chunks")
    needs = None
    if blocks > ALL_BLOCKS:
        pairs = ratings.select(solve_for, given).mapInArrow(_pairs(side), "id long, _block int")
        needs = materialise(pairs.groupBy("id").agg(F.collect_set("_block").alias("_blocks")), "als-needs")
    return replace(side, chunks=chunks, needs=needs)


def _vectors(side: Side, rank: int, listed: bool):
    def run(batches):
        for rows in _buffered(batches, BUFFER):
            ids = rows.column("id").to_numpy()
            features = rows.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32)
            features = features.reshape(-1, rank)
            part = _slices(side, mixed(ids))
            if not listed:
                sent = [(b, s, at) for (s,), at in _groups(part) for b in range(side.blocks)]
            else:
                lists = rows.column("_blocks").combine_chunks()
                row = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
                sent = [(b, s, row[at]) for (b, s), at in _groups(lists.flatten().to_numpy(), part[row])]
            for b, s, at in sent:
                at = at[np.argsort(ids[at], kind="stable")]
                body = np.int64(len(at)).tobytes() + _rising(ids[at]) + features[at].tobytes()
                yield _packed([(b, s, 0, body)])

    return run


class Sums:
    """Normal equations of ids that turn up one after the other."""

    def __init__(self, width: int):
        self.ids, self.slot = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.rows = np.zeros((1024, width))

    def slots(self, ids: np.ndarray) -> np.ndarray:
        """Rows of distinct rising ids."""
        at = np.searchsorted(self.ids, ids)
        new = np.ones(len(ids), bool)
        inside = at < len(self.ids)
        new[inside] = self.ids[at[inside]] != ids[inside]
        if new.any():
            known = len(self.ids)
            self.ids = np.insert(self.ids, at[new], ids[new])
            self.slot = np.insert(self.slot, at[new], np.arange(known, known + int(new.sum())))
            if len(self.ids) > len(self.rows):
                self.rows.resize((max(len(self.ids), len(self.rows) * 3 // 2), self.rows.shape[1]), refcheck=False)
            at = np.searchsorted(self.ids, ids)
        return self.slot[at]


Vectors = tuple[np.ndarray, np.ndarray]  # rising ids, one row each


def _vectors_of(body: bytes, rank: int) -> Vectors:
    n = int(np.frombuffer(body, np.int64, 1)[0])
    ids, at = _risen(body, 8, n)
    return ids, np.frombuffer(body, np.float32, n * rank, at).reshape(n, rank)


def _together(parts: list[Vectors], rank: int) -> Vectors:
    if not parts:
        return np.zeros(0, np.int64), np.zeros((0, rank))
    ids = np.concatenate([x for x, _ in parts])
    order = np.argsort(ids, kind="stable")
    return ids[order], np.concatenate([v for _, v in parts])[order].astype(np.float64)


def _read(batches: Iterator[pa.RecordBatch], rank: int) -> Iterator[tuple[int, Vectors, Vectors, bytes]]:
    """Chunks of rows sorted by block, slice and kind, with their block, its own vectors (slice -1) and those of
    their slice."""
    block, part = None, None
    own, given, held = _together([], rank), _together([], rank), []
    for batch in batches:
        for b, s, kind, data in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if b != block:
                own = _together([], rank)
            elif s != part and part == -1:
                own = _together(held, rank)
            if (b, s) != (block, part):
                block, part, held, given = b, s, [], _together([], rank)
            if kind == 0:
                held.append(_vectors_of(data, rank))
                continue
            if held:
                given, held = _together(held, rank), []
            yield b, own, given, data


def _found(vectors: Vectors, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ids have a vector, and its place."""
    if not len(vectors[0]):
        return np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
    at = np.minimum(np.searchsorted(vectors[0], ids), len(vectors[0]) - 1)
    return vectors[0][at] == ids, at


def _added(side: Side, rank: int, terms, solve):
    """Adds up the rows of sorted (block, slice, kind) and solves a block's equations at its end."""
    first, second = (np.array(x) for x in zip(*[(i, j) for i in range(rank) for j in range(i, rank)]))
    n_gram = len(first)

    def ended(sums: Sums) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(sums.ids), 10_000):
            ids = sums.ids[start : start + 10_000]
            rows = sums.rows[sums.slot[start : start + 10_000]]
            whole = ~np.isin(ids, side.hot)
            vectors = np.zeros((len(ids), rank), np.float32)
            if whole.any():
                vectors[whole] = solve(rows[whole, :n_gram], rows[whole, n_gram:-2], rows[whole, -2])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids),
                pa.array([v if w else None for v, w in zip(vectors, whole)], pa.list_(pa.float32())),
                pa.array([None if w else r[:-2] for r, w in zip(rows, whole)], pa.list_(pa.float64())),
                pa.array(rows[:, -2].astype(np.int64)),
            ], ["id", "features", "sums", "n"])

    def run(batches):
        block, sums = None, None
        for b, _, given, data in _read(batches, rank):
            if b != block:
                if sums is not None:
                    yield from ended(sums)
                block, sums = b, Sums(n_gram + rank + 2)
            _add(sums, data, *given)
        if sums is not None:
            yield from ended(sums)

    def _add(sums: Sums, data: bytes, ids: np.ndarray, vectors: np.ndarray) -> None:
        solved, given, place, rating = unpack(data)
        known, at = _found((ids, vectors), given)
        known = known[place]
        if not known.all():  # ratings of ids without a vector
            solved, place, rating = solved[known], place[known], rating[known]
            if not len(solved):
                return
        v = vectors[at][place]
        weight, target, counted = terms(rating)
        rows = np.empty((len(v), n_gram + rank + 2))
        np.multiply(v[:, first], v[:, second], out=rows[:, :n_gram])
        if weight is not None:
            rows[:, :n_gram] *= weight[:, None]
        np.multiply(v, target[:, None], out=rows[:, n_gram:-2])
        rows[:, -2], rows[:, -1] = counted, 1
        starts = np.flatnonzero(np.r_[True, solved[1:] != solved[:-1]])
        slots = sums.slots(solved[starts])
        sums.rows[slots] += np.add.reduceat(rows, starts, axis=0)

    return run


def _dealt(side: Side, given: DataFrame, rank: int, own: DataFrame | None = None) -> tuple[Side, DataFrame]:
    """The side without tables, and chunks and vectors dealt to blocks: those of given ids to every block that needs
    them, and those of the block's own ids."""
    sent = given.select(F.col("id").cast("long").alias("id"), "features")
    if side.needs is not None:
        sent = sent.join(side.needs, "id")
    plain = replace(side, chunks=None, needs=None)  # tasks get no tables
    rows = sent.mapInArrow(_vectors(plain, rank, side.needs is not None), PACKED).unionByName(side.chunks)
    if own is not None:
        rows = rows.unionByName(own.select(F.col("id").cast("long").alias("id"), "features").mapInArrow(_own(plain, rank), PACKED))
    return plain, rows.repartitionById(side.blocks, F.col("_block")).sortWithinPartitions("_block", "_slice", "_kind")


def step(side: Side, fixed: DataFrame, rank: int, terms, solve) -> DataFrame:
    """(id, features, sums, n) of the side's ids, the vectors of hot ids null and their sums one row per block.
    ``terms`` gives weights, targets and counts of ratings; ``solve`` solves (products, targets, counts)."""
    plain, dealt = _dealt(side, fixed, rank)
    return dealt.mapInArrow(_added(plain, rank, terms, solve), SUMMED)


def _own(side: Side, rank: int):
    """Vectors of the ids to solve for, sent to their block; those of hot ids to all."""
    def run(batches):
        for rows in _buffered(batches, BUFFER):
            ids = rows.column("id").to_numpy()
            features = rows.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32)
            features = features.reshape(-1, rank)
            hot = np.isin(ids, side.hot)
            block = np.where(hot, -1, (mixed(ids) % np.uint64(side.blocks)).astype(np.int64))
            for (b,), at in _groups(block):
                at = at[np.argsort(ids[at], kind="stable")]
                body = np.int64(len(at)).tobytes() + _rising(ids[at]) + features[at].tobytes()
                yield _packed([(k, -1, 0, body) for k in (range(side.blocks) if b < 0 else (b,))])

    return run


def products(ratings: DataFrame, left: DataFrame, right: DataFrame, left_id: str, right_id: str, rank: int) -> DataFrame:
    """(left_id, right_id, rating, prediction) of the rows whose ids both have vectors. Rows are packed as for half
    steps (two long ids and a double, no nulls) and meet the vectors in blocks of right ids."""
    side = lay_out(ratings, right_id, left_id, rank)
    _, dealt = _dealt(side, left, rank, right)

    def run(batches):
        for _, own, given, data in _read(batches, rank):
            solved, ids, place, rating = unpack(data)
            known, at = _found(given, ids)
            mine, own_at = _found(own, solved)
            keep = known[place] & mine
            if not keep.any():
                continue
            a, b = given[1][at[place[keep]]], own[1][own_at[keep]]
            product = a[:, 0] * b[:, 0]
            for i in range(1, rank):
                product = product + a[:, i] * b[:, i]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[place[keep]]), pa.array(solved[keep]), pa.array(rating[keep]), pa.array(product.astype(np.float32))],
                [left_id, right_id, "rating", "prediction"],
            )

    return dealt.mapInArrow(run, f"{left_id} long, {right_id} long, rating double, prediction float")
