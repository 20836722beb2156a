"""Token ids in binary files: patched frame-of-reference blocks.

A file holds whole documents in order. Their ids are one run of 32-bit numbers, cut into blocks of
``BLOCK``. Of a block the minimum is subtracted; the rest is packed at the width that ``PERCENTILE``
of its numbers need, and what is wider is cut to that width and kept whole in a list of exceptions.

File format, little-endian: a header (magic, version, block length, blocks, documents, ids), the
blocks (minimum u32, width u8, exceptions u16, packed bits, exception places u16, exception
numbers u32), the start of each block u64, and per document its id i64, a flag for a null id u8,
and its number of ids u64.

Files are cut from a range partitioning by document id; a task holds one file's ids at a time, and
``RUN`` blocks while it packs them. Texts are encoded in slabs of bounded size (``word_ids``).

Defined cases: null text is empty and has only the end id; null ids come first; rows with the same
id are kept, one after the other, in the order of a hash of their texts; ids are whole numbers or
text of whole numbers; other columns are not looked at; an empty table gives no file and no row."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shelfstream.llm import files, word_ids
from shelfstream.session import fresh_path, materialise

# fixed values of the format
MAGIC, VERSION, BLOCK = b"PFORTOKS", 1, 1024
HEADER = struct.Struct("<8sIIQQQ")
BLOCK_HEAD = struct.Struct("<IBH")

PERCENTILE = 0.95
END_ID = 2
FILE_IDS = 1 << 22
RUN = 256
SLAB_BYTES = 2 << 20  # of texts encoded at once; workers that are used again keep what the largest slab took


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks of ids (uint32) as bytes, and the start of each."""
    parts, starts, at = [], [np.zeros(0, np.uint64)], 0
    for i in range(0, len(ids), RUN * BLOCK):
        data, first = _pack_run(ids[i : i + RUN * BLOCK])
        parts.append(data)
        starts.append(first + np.uint64(at))
        at += len(data)
    return b"".join(parts), np.concatenate(starts)


def _pack_run(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.concatenate([ids, np.full(blocks * BLOCK - n, ids[-1], np.uint32)]).reshape(blocks, BLOCK)
    least = padded.min(1)
    rest = padded - least[:, None]
    need = np.where(rest == 0, 0, np.frexp(rest.astype(np.float64))[1])
    width = np.sort(need, 1)[:, int(np.ceil(PERCENTILE * BLOCK)) - 1].astype(np.uint8)
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            bits = np.empty((len(rows), BLOCK, w), np.uint8)
            part = rest[rows]
            for i in range(int(w)):
                bits[:, :, i] = (part >> np.uint32(i)) & np.uint32(1)
            for row, data in zip(rows, np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")):
                packed[row] = data.tobytes()
    out, starts, at = [], np.empty(blocks, np.uint64), 0
    wide = need > width[:, None]
    for i in range(blocks):
        places = np.flatnonzero(wide[i]).astype("<u2")
        parts = (
            BLOCK_HEAD.pack(int(least[i]), int(width[i]), len(places)), packed[i], places.tobytes(),
            rest[i, places].astype("<u4").tobytes(),
        )
        starts[i] = at
        at += sum(map(len, parts))
        out.extend(parts)
    return b"".join(out), starts


def unpack(data: bytes, starts: np.ndarray, n: int) -> np.ndarray:
    """The n ids of blocks that begin at starts."""
    runs = [_unpack_run(data, starts[i : i + RUN]) for i in range(0, len(starts), RUN)]
    return np.concatenate([np.zeros(0, np.uint32), *runs])[:n]


def _unpack_run(data: bytes, starts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(starts), BLOCK), np.uint32)
    heads = [BLOCK_HEAD.unpack_from(data, int(s)) for s in starts]
    width = np.array([h[1] for h in heads], np.int64)
    raw = np.frombuffer(data, np.uint8)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            first = starts[rows].astype(np.int64) + BLOCK_HEAD.size
            packed = raw[first[:, None] + np.arange(BLOCK * w // 8)]
            bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
            part = np.zeros((len(rows), BLOCK), np.uint32)
            for i in range(int(w)):
                part |= bits[:, :, i].astype(np.uint32) << np.uint32(i)
            out[rows] = part
    for i, (least, w, wide) in enumerate(heads):
        if wide:
            at = int(starts[i]) + BLOCK_HEAD.size + BLOCK * w // 8
            out[i, np.frombuffer(data, "<u2", wide, at)] = np.frombuffer(data, "<u4", wide, at + 2 * wide)
        out[i] += np.uint32(least)
    return out.reshape(-1)


def encode_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    data, starts = pack(ids)
    return b"".join([
        HEADER.pack(MAGIC, VERSION, BLOCK, len(starts), len(counts), len(ids)), data,
        starts.astype("<u8").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(), np.array(counts, "<u8").tobytes(),
    ])


def decode_file(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, whether each is null, numbers of ids, all ids) of a file."""
    magic, version, block, blocks, docs, n = HEADER.unpack_from(raw)
    if (magic, version, block) != (MAGIC, VERSION, BLOCK):
        raise ValueError("not a file of token blocks")
    at = len(raw) - 8 * blocks - 17 * docs
    starts = np.frombuffer(raw, "<u8", blocks, at)
    doc_ids = np.frombuffer(raw, "<i8", docs, at + 8 * blocks)
    nulls = np.frombuffer(raw, np.uint8, docs, at + 8 * blocks + 8 * docs).astype(bool)
    counts = np.frombuffer(raw, "<u8", docs, len(raw) - 8 * docs)
    return doc_ids, nulls, counts, unpack(raw[HEADER.size : at], starts, n)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, doc_id: str = "doc_id", text: str = "text",
                 file_ids: int = FILE_IDS) -> DataFrame:
    """Write the files and return one row per file: name, task, number in the task, ids."""
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = ordered.repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), F.xxhash64("text")
    )

    def run(batches):
        encoder, task = word_ids.encoder_of(tokenizer), TaskContext.get().partitionId()
        held_ids, held_docs, held_counts, held, number = [], [], [], 0, 0

        def close():
            name = f"part-{task:06d}-{number:06d}.tok"
            files.write_bytes(f"{folder}/{name}", encode_file(held_docs, held_counts, np.concatenate(held_ids)))
            return pa.RecordBatch.from_pylist(
                [{"name": name, "task": task, "number": number, "n_ids": held}], schema=FILE_ROW
            )

        for batch in batches:
            keys, done = batch.column("doc_id").to_pylist(), 0
            for slab in word_ids.text_slabs(batch.column("text"), SLAB_BYTES):
                ids, counts = encoder.encode(slab)
                held_ids.append(np.insert(ids, np.cumsum(counts), np.uint32(END_ID)))
                held_docs += keys[done : done + len(slab)]
                held_counts += (counts + 1).tolist()
                held += len(held_ids[-1])
                done += len(slab)
                if held >= file_ids:
                    yield close()
                    held_ids, held_docs, held_counts, held, number = [], [], [], 0, number + 1
        if held_docs:
            yield close()

    return materialise(
        ordered.mapInArrow(run, "name string, task int, number int, n_ids long"), "token-files"
    )


FILE_ROW = pa.schema([("name", pa.string()), ("task", pa.int32()), ("number", pa.int32()), ("n_ids", pa.int64())])


def read_tokens(spark, folder: str, written: DataFrame) -> DataFrame:
    """Per document of the written files: doc_id, start, n_tokens, ids_crc32."""
    tasks = written.groupBy("task").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    starts = written.withColumn("inner", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(bases, "task")
    starts = starts.select("name", (F.col("base") + F.col("inner")).alias("base"))
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                doc_ids, nulls, counts, ids = decode_file(content.as_py())
                ends = np.cumsum(counts).astype(np.int64)
                ids, starts = ids.astype("<u4"), ends - counts.astype(np.int64)
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([path.rpartition("/")[2]] * len(counts), pa.string()),
                    pa.array(doc_ids, pa.int64(), mask=nulls), pa.array(starts),
                    pa.array(counts.astype(np.int64)), pa.array(crcs, pa.int64()),
                ], ["name", "doc_id", "inner", "n_tokens", "ids_crc32"])

    rows = raw.select("path", "content").mapInArrow(
        run, "name string, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return rows.join(starts, "name").select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenize(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents as token files in the shared folder and describe what is read back."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "tokens")
    written = write_tokens(docs, tokenizer, folder, doc_id, text)
    if written.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_tokens(spark, folder, written)
