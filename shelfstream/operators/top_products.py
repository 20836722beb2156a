"""The n best partners of every vector by inner product, exact.

The asking vectors are dealt into groups and the others into slices of bounded size, and every group meets
every slice. A block of others is sorted by length: no product with a vector is larger than length times
length, so an asking vector's search ends at the first other whose length cannot reach its n-th best product.
Blocks are asked in the order of their longest vector, so the best come early."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

BLOCK_ROWS = 4096
GROUP_ROWS = 8192
SLICE_ROWS = 65536
STEP = 512

_BLOCK = "part long, number long, ids binary, vectors binary"
_BLOCK_ROW = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])
_FOUND = "asking long, id long, product double"


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """(id, features) packed into rows of at most ``rows`` vectors, longest first."""
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                cut = batch.slice(i, rows)
                ids = cut.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
                matrix = cut.column("features").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                order = np.argsort(-np.linalg.norm(matrix, axis=1), kind="stable")
                yield pa.RecordBatch.from_pylist([{
                    "part": part, "number": number, "ids": ids[order].tobytes(), "vectors": matrix[order].tobytes(),
                }], schema=_BLOCK_ROW)
                number += 1

    double = vectors.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("features"))
    return double.mapInArrow(run, _BLOCK)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["vectors"]).reshape(len(ids), -1)


def best_in(asking: tuple, others: list[tuple], n: int) -> tuple[list, int]:
    """((asking id, id, product) of the n best of each asking vector, number of products computed)."""
    ids, vectors = asking
    length = np.linalg.norm(vectors, axis=1)
    others = sorted(others, key=lambda o: -np.linalg.norm(o[1][0]) if len(o[0]) else 0)
    held_ids = np.full((len(ids), n), np.iinfo(np.int64).max)
    held = np.full((len(ids), n), -np.inf)
    computed = 0
    for other_ids, other in others:
        reach = np.linalg.norm(other, axis=1) * (1 + 1e-9)
        for i in range(0, len(other_ids), STEP):
            alive = np.flatnonzero(length * reach[i] >= held[:, -1])
            if not len(alive):
                break
            products = vectors[alive] @ other[i : i + STEP].T
            computed += products.size
            all_products = np.hstack([held[alive], products])
            all_ids = np.hstack([held_ids[alive], np.broadcast_to(other_ids[i : i + STEP], products.shape)])
            order = np.lexsort((all_ids, -all_products), axis=1)[:, :n]
            held[alive] = np.take_along_axis(all_products, order, 1)
            held_ids[alive] = np.take_along_axis(all_ids, order, 1)
    found = [(a, int(i), float(p)) for a, row, best in zip(ids.tolist(), held_ids, held) for i, p in zip(row, best) if p > -np.inf]
    return found, computed


def top_products(asking: DataFrame, others: DataFrame, n: int) -> DataFrame:
    """(asking, id, product): the n best of ``others`` for every row of ``asking``, both (id, features) with
    vectors of one length and no nulls; ties go to the smaller id."""
    groups, slices = (max(1, -(-t.count() // most)) for t, most in ((asking, GROUP_ROWS), (others, SLICE_ROWS)))
    key, rows = F.xxhash64("part", "number"), ("ids", "vectors")

    def dealt(parts: int):
        return F.pmod(key, F.lit(parts)).cast("int")

    def every(parts: int):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    left = blocks(asking, min(BLOCK_ROWS, GROUP_ROWS)).select(dealt(groups).alias("group"), every(slices).alias("slice"), *rows)
    right = blocks(others, BLOCK_ROWS).select(every(groups).alias("group"), dealt(slices).alias("slice"), *rows)

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        held = [_unpacked(r) for r in theirs.to_pylist()]
        found = [x for row in mine.to_pylist() for x in best_in(_unpacked(row), held, n)[0]] if held else []
        columns = list(zip(*found)) or [(), (), ()]
        types = [pa.int64(), pa.int64(), pa.float64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["asking", "id", "product"])

    both = left.groupBy("group", "slice").cogroup(right.groupBy("group", "slice"))
    best = Window.partitionBy("asking").orderBy(F.desc("product"), "id")
    found = both.applyInArrow(run, _FOUND).withColumn("_place", F.row_number().over(best))
    return found.filter(F.col("_place") <= n).drop("_place")
