"""Hard negatives of anchors: rows of another label that score just below an anchor's own neighbours.

Rows are dealt into slices and anchors into groups of bounded size; every group meets every slice in
a task of its own. Inside a task the anchors of one label and nearby directions form a cluster. For
each cluster the slice is sorted once by an upper bound of any member's score, ``|row| * cos(angle
between row and centre - widest angle of a member)``, times the member's length; every member walks
that list until the bound falls below all it still needs, so that its result is certified. What the
slices return, at most ``k`` rows per anchor or positive, is merged by a window. A first pass finds the
positives, a second the negatives under the positives' scores.

Scores are inner products of the components times ``scale``, rounded down; they are whole numbers and
exact, by Python's integers where doubles could round. They must fit 64 bits.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no
part; shorter vectors are filled with zeros; zero vectors and empty ones score 0; ties go to the
smaller id; a repeated row counts as often as it stands; of anchors that share an id the one with the
smallest label, then the smallest vector, stands for all; rows with the anchor's id are none of its
positives or negatives; an anchor without positives, and a positive below 0, has no negatives; an empty
table or one without anchors gives no row; other columns are not looked at."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfstream.session import materialise

SCALE = 256.0
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100

BLOCK_ROWS = 4096
SLICE_ROWS = 16384
GROUP_ANCHORS = 2048
CLUSTER_ANCHORS = 32
STEP = 512

BLOCK = "part long, slice_key long, ids binary, labels binary, dims int, vectors binary"
GROUP = "group_no int, ids binary, labels binary, dims int, vectors binary, clusters binary"
FOUND = "group_no int, anchor_id long, vec_id long, score long"
MINED = "anchor_id long, place int, positive_id long, positive_score long, vec_id long, score long"


def finite_points(rows: DataFrame, vec_id: str, label: str, vector: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ok).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )


def _matrix(vectors: pa.Array, scale: float) -> np.ndarray:
    """Scaled whole-number components, one row each, filled with zeros to the longest."""
    sizes = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, np.int64)
    out = np.zeros((len(vectors), int(sizes.max(initial=0))))
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _pad(parts: list[np.ndarray], dims: int) -> np.ndarray:
    return np.concatenate([np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in parts])


def _stored(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["vectors"]).reshape(len(ids), row["dims"])


def pack(points: DataFrame, scale: float) -> DataFrame:
    """Rows of blocks; a block is named by its task and its number there."""
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                cut = batch.slice(i, BLOCK_ROWS)
                vectors = _matrix(cut.column("vector"), scale)
                yield pa.RecordBatch.from_pylist([{
                    "part": part, "slice_key": number, "dims": vectors.shape[1], "vectors": vectors.tobytes(),
                    "ids": cut.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                    "labels": cut.column("label").to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                }], schema=BLOCK_ROW)
                number += 1

    return points.mapInArrow(run, BLOCK)


BLOCK_ROW = pa.schema([
    ("part", pa.int64()), ("slice_key", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()),
    ("dims", pa.int32()), ("vectors", pa.binary()),
])
GROUP_ROW = pa.schema([
    ("group_no", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("dims", pa.int32()),
    ("vectors", pa.binary()), ("clusters", pa.binary()),
])


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = np.sqrt((vectors * vectors).sum(1))
    return vectors / np.maximum(length, 1e-300)[:, None], length


def clusters_of(labels: np.ndarray, vectors: np.ndarray, size: int = CLUSTER_ANCHORS) -> np.ndarray:
    """A cluster number per anchor: directions grouped within each label."""
    units, _ = _units(vectors)
    out, used = np.zeros(len(labels), np.int64), 0
    for label in np.unique(labels):
        rows = np.flatnonzero(labels == label)
        parts = -(-len(rows) // size)
        centres = units[rows[np.arange(parts) * len(rows) // parts]]
        for _ in range(4):
            near = (units[rows] @ centres.T).argmax(1)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, units[rows])
            centres = np.where(np.bincount(near, minlength=parts)[:, None] > 0, _units(sums)[0], centres)
        out[rows] = used + near
        used += parts
    return out


def group_anchors(points: DataFrame, anchors: Column, groups: int, scale: float) -> DataFrame:
    """One row per group of anchors with their cluster numbers."""
    chosen = points.filter(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    chosen = chosen.select("vec_id", "row.label", "row.vector", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("group_no"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id").combine_chunks()
        labels, vectors = table.column("label").to_numpy(), _matrix(table.column("vector").combine_chunks(), scale)
        return pa.Table.from_pylist([{
            "group_no": table.column("group_no")[0].as_py(), "ids": table.column("vec_id").to_numpy().tobytes(),
            "labels": labels.tobytes(), "dims": vectors.shape[1], "vectors": vectors.tobytes(),
            "clusters": clusters_of(labels, vectors).tobytes(),
        }], schema=GROUP_ROW)

    return chosen.groupBy("group_no").applyInArrow(run, GROUP)


def _scores(anchors: np.ndarray, rows: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole numbers. Doubles are exact as long as no sum can pass 2^53."""
    if exact:
        return (anchors @ rows.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in part], object).reshape(part.shape) for part in (anchors, rows)]
    products = (whole[0] @ whole[1].T) if anchors.shape[1] else np.zeros((len(anchors), len(rows)))
    return products.astype(np.int64)


class Slice:
    """The rows of one slice, and the walk of a cluster's members over them."""

    def __init__(self, blocks: list[dict], dims: int):
        parts = [_stored(b) for b in blocks]
        self.dims = max([dims, *[p[2].shape[1] for p in parts]])
        self.ids, self.labels = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        self.vectors = _pad([p[2] for p in parts], self.dims)
        self.units, self.length = _units(self.vectors)

    def walk(self, anchors: np.ndarray, rows: np.ndarray, need: np.ndarray, take) -> int:
        """Offers ``take(member, places, scores)`` the rows in order of their bounds, and leaves a member out
        once its bound is below ``need[member]``, which take lowers no more but may raise. Returns how many
        scores were computed."""
        units, length = _units(anchors)
        centre = _units(units.sum(0, keepdims=True))[0][0]
        widest = np.arccos(np.clip(units @ centre, -1, 1)).max()
        angle = np.arccos(np.clip(self.units[rows] @ centre, -1, 1))
        # rounding is far below these margins
        bound = self.length[rows] * np.cos(np.maximum(0, angle - widest - 1e-6)) + 1e-6 * self.length[rows]
        order = np.argsort(-bound, kind="stable")
        rows, bound = rows[order], bound[order]
        most = max(np.abs(anchors).max(initial=0), np.abs(self.vectors).max(initial=0))
        exact = most * most * self.dims < 2.0**53
        seen = 0
        for i in range(0, len(rows), STEP):
            alive = np.flatnonzero(length * bound[i] + 1e-6 >= need)
            if not len(alive):
                break
            part = rows[i : i + STEP]
            scores = _scores(anchors[alive], self.vectors[part], exact)
            seen += scores.size
            for k in np.flatnonzero((scores >= need[alive][:, None]).any(1)):
                hits = np.flatnonzero(scores[k] >= need[alive[k]])
                take(alive[k], part[hits], scores[k, hits])
        return seen


def _best(held, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k first of held and new rows by falling score, then id."""
    if held is not None:
        ids, scores = np.concatenate([held[0], ids]), np.concatenate([held[1], scores])
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


LEAST = np.iinfo(np.int64).min


def positives_in(blocks: list[dict], group: dict, k: int) -> list[tuple]:
    """(anchor, row, score) of the k best rows of each anchor's label in one slice."""
    ids, labels, vectors = _stored(group)
    part = Slice(blocks, group["dims"])
    vectors, clusters, out = _pad([vectors], part.dims), np.frombuffer(group["clusters"], np.int64), []
    for c in np.unique(clusters):
        members = np.flatnonzero(clusters == c)
        rows = np.flatnonzero(part.labels == labels[members[0]])
        need, held = np.full(len(members), LEAST, np.float64), [None] * len(members)

        def take(m, places, scores):
            other = part.ids[places] != ids[members[m]]
            held[m] = _best(held[m], part.ids[places[other]], scores[other], k)
            if len(held[m][1]) == k:
                need[m] = held[m][1][-1]

        part.walk(vectors[members], rows, need, take)
        out += [(int(ids[m]), int(i), int(s)) for m, h in zip(members, held) if h for i, s in zip(*h)]
    return out


def negatives_in(blocks: list[dict], group: dict, wanted: dict[int, list[tuple]], k: int, low: int, high: int) -> list[tuple]:
    """(anchor, place, positive, its score, row, score) of the k best rows of other labels in one slice, for
    each wanted (place, positive, score) of an anchor."""
    ids, labels, vectors = _stored(group)
    part = Slice(blocks, group["dims"])
    vectors, clusters, out = _pad([vectors], part.dims), np.frombuffer(group["clusters"], np.int64), []
    for c in np.unique(clusters):
        members = np.array([m for m in np.flatnonzero(clusters == c) if wanted.get(int(ids[m]))], np.int64)
        if not len(members):
            continue
        rows = np.flatnonzero(part.labels != labels[members[0]])
        asked = [wanted[int(ids[m])] for m in members]
        floors = [[-(-low * score // 100) for _, _, score in a] for a in asked]
        held = [[None] * len(a) for a in asked]
        need = np.array([min(f) for f in floors], np.float64)

        def take(m, places, scores):
            still = []
            for j, (_, _, score) in enumerate(asked[m]):
                fits = (scores >= floors[m][j]) & (100 * scores <= high * score)
                if fits.any():
                    held[m][j] = _best(held[m][j], part.ids[places[fits]], scores[fits], k)
                full = held[m][j] is not None and len(held[m][j][1]) == k
                still.append(int(held[m][j][1][-1]) if full else floors[m][j])
            need[m] = min(still)

        part.walk(vectors[members], rows, need, take)
        for m, a, h in zip(members, asked, held):
            for (place, positive, score), best in zip(a, h):
                if best is not None:
                    out += [(int(ids[m]), place, positive, score, int(i), int(s)) for i, s in zip(*best)]
    return out


def _rows(rows: list[tuple], names: str) -> pa.Table:
    """Rows as an Arrow table of a Spark schema of longs and ints."""
    kinds = [x.split() for x in names.split(", ")]
    columns = list(zip(*rows)) or [()] * len(kinds)
    types = [pa.int64() if kind == "long" else pa.int32() for _, kind in kinds]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[n for n, _ in kinds])


def mine(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, scale: float = SCALE, vec_id: str = "vec_id", label: str = "label",
         vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (a condition on
    vec_id and label) and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of other
    labels with low % of the positive's score <= score <= high % of it."""
    spark = rows.sparkSession
    points = finite_points(rows, vec_id, label, vector)
    n, asked = points.agg(F.count("*"), F.count_if(anchors)).first()
    slices, groups = max(1, -(-n // SLICE_ROWS)), max(1, -(-asked // GROUP_ANCHORS))
    grouped = materialise(group_anchors(points, anchors, groups, scale), "anchor-groups")
    dealt = pack(points, scale).select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group_no"),
        F.pmod(F.xxhash64("part", "slice_key"), F.lit(slices)).cast("int").alias("slice_no"),
        "ids", "labels", "dims", "vectors",
    )

    def meet(groups_table: DataFrame, run, schema: str) -> DataFrame:
        every = groups_table.withColumn("slice_no", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        return dealt.groupBy("group_no", "slice_no").cogroup(every.groupBy("group_no", "slice_no")).applyInArrow(run, schema)

    def first(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _rows([], FOUND)
        group = right.to_pylist()[0]
        return _rows([(group["group_no"], *r) for r in positives_in(left.to_pylist(), group, positives)], FOUND)

    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen = meet(grouped, first, FOUND).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    wanted = materialise(
        chosen.filter("score >= 0").groupBy("group_no")
        .agg(F.collect_list(F.struct("anchor_id", "place", "vec_id", "score")).alias("wanted")), "positives",
    )

    def second(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _rows([], MINED)
        group, by_anchor = right.to_pylist()[0], {}
        for w in group["wanted"]:
            by_anchor.setdefault(w["anchor_id"], []).append((w["place"], w["vec_id"], w["score"]))
        return _rows(negatives_in(left.to_pylist(), group, by_anchor, negatives, low, high), MINED)

    ranked = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return meet(grouped.join(wanted, "group_no"), second, MINED).withColumn("rank", F.row_number().over(ranked)).filter(
        F.col("rank") <= negatives
    ).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
