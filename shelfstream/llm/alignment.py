"""Two tokenizers over the same texts: groups of tokens between common cuts, links of overlapping tokens, and
how often a pair of ids is linked in the corpus.

Tokenizer A is a byte-level file of the tokenizers library, B a sentencepiece model that adds a space. Their
spans, characters of A and bytes of B's SentencePieceText, are the coarse cuts. Inside a character that takes
several tokens, and for byte-fallback pieces, the cuts are refined by the tokens' decoded bytes. What is decoded
must give space + text again, or the text has no tokens.

Neither tokenizer joins anything across the place between a character that is no white space and a space, so
texts are cut there into chunks, and each distinct chunk of a slab of texts is aligned once, many to a line.
(Where a tokenizer's file does not show that, whole texts are the chunks.) A slab's chunks, numbered per document, and its links are written to
the shared folder, compressed and cut to parts, so that no row of a table is large. Counts of id pairs are summed per slab before they are
shuffled; the sums go back to the slabs that asked for them, at most once per slab and pair.

Defined cases: null and empty texts, and those that do not decode to themselves, have zeros and an empty
string, and their links count nowhere; every row of repeated ids or texts has its result and counts; null ids
are kept; ids are whole numbers; other columns are not looked at; an empty table gives no row."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfstream.llm.word_ids import gather, slabs
from shelfstream.session import materialise, small_batches

SLAB_BYTES = 6 << 20
PART_BYTES = 1 << 17
GROUP_BYTES = 8 << 20  # of a Parquet row group, which a task that reads it unpacks at once
REMEMBERED = 200_000
LINE_CHUNKS = 500
# fixed value: sentencepiece's mark of a space
SPACE_MARK = "▁"

PER_TEXT = ["n_a", "n_b", "n_groups", "n_links"]
SLAB = "slab long, part int, pair array<long>, n array<long>, data binary"
SLAB_ROW = pa.schema([
    ("doc_id", pa.list_(pa.int64())), *[(c, pa.binary()) for c in PER_TEXT], ("groups_sha256", pa.list_(pa.string())),
    *[(c, pa.binary()) for c in ("bounds", "numbers", "link_bounds", "links")],
])
PART_ROW = pa.schema([
    ("slab", pa.int64()), ("part", pa.int32()), ("pair", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("data", pa.binary()),
])
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Chunks:
    """Alignments of chunks, one after the other: numbers per chunk, links as a << 32 | b, group texts."""

    def __init__(self, numbers: np.ndarray, links: np.ndarray, groups: list[bytes], good: np.ndarray):
        self.numbers, self.links, self.groups, self.good = numbers, links, groups, good

    def __add__(self, other: "Chunks") -> "Chunks":
        return Chunks(
            np.concatenate([self.numbers, other.numbers]), np.concatenate([self.links, other.links]),
            self.groups + other.groups, np.concatenate([self.good, other.good]),
        )

    def take(self, places: np.ndarray) -> "Chunks":
        number = self.numbers[:, 3]
        links = gather(self.links, (np.cumsum(number) - number)[places], number[places])
        return Chunks(self.numbers[places], links, [self.groups[i] for i in places], self.good[places])


def no_chunks() -> Chunks:
    return Chunks(np.zeros((0, 4), np.int64), np.zeros(0, np.int64), [], np.zeros(0, bool))


def byte_symbols() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the others the
    characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        symbols = byte_symbols()
        self.a_bytes: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in symbols for c in token)
            self.a_bytes[i] = bytes(symbols[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        with open(a_path, encoding="utf-8") as file:
            rules = json.load(file)
        first = rules.get("pre_tokenizer") or {}
        self.by_spaces = (
            not rules.get("normalizer") and first.get("type") == "ByteLevel" and first.get("use_regex")
            and not first.get("add_prefix_space") and not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        )
        self.known: dict[str, int] = {}
        self.held = no_chunks()

    def _cuts(self, line: str, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(ids of A, their ends, ids of B, their ends) in bytes of a line that begins with a space; None where
        the decoded tokens are not the line."""
        coded = self.a.encode(line, add_special_tokens=False)
        ids = np.array(coded.ids, np.int64)
        spans = np.array(coded.offsets, np.int64).reshape(-1, 2)
        chars = np.arange(len(raw) + 1)
        if len(raw) != len(line):
            chars = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw))
        whole = np.append(spans[1:, 0] >= spans[:-1, 1], True)  # the next token begins after this one's characters
        a_ends = refine(chars[spans[:, 1]], whole, self.a_sizes[ids])
        pieces = self.b.encode(line[1:], return_type="proto").pieces
        b_ids = np.fromiter((p.id for p in pieces), np.int64, len(pieces))
        b_stops = 1 + np.fromiter((p.end for p in pieces), np.int64, len(pieces))
        whole = np.append(b_stops[1:] > b_stops[:-1], True) & (np.diff(b_stops, prepend=0) == self.b_sizes[b_ids])
        b_ends = refine(b_stops, whole, self.b_sizes[b_ids])
        if b"".join([self.a_bytes[i] for i in ids.tolist()]) != raw or b"".join([self.b_bytes[i] for i in b_ids.tolist()]) != raw:
            return None
        return ids, a_ends, b_ids, b_ends

    def align(self, chunks: list[str]) -> Chunks:
        """Alignments of distinct chunks."""
        # behind white space at the end of a text another chunk would be read otherwise
        alone = [i for i, c in enumerate(chunks) if not self.by_spaces or c[-1].isspace()]
        others = np.setdiff1d(np.arange(len(chunks)), alone)
        lines = [[i] for i in alone] + [others[i : i + LINE_CHUNKS] for i in range(0, len(others), LINE_CHUNKS)]
        out = [no_chunks(), *[x for line in lines for x in self._align_line([chunks[i] for i in line])]]
        order = np.argsort(np.concatenate([np.zeros(0, np.int64), *lines]))
        return Chunks(
            np.concatenate([c.numbers for c in out]), np.concatenate([c.links for c in out]),
            [g for c in out for g in c.groups], np.concatenate([c.good for c in out]),
        ).take(order)

    def _align_line(self, chunks: list[str]) -> list[Chunks]:
        parts = [c.encode() for c in chunks]
        found = self._cuts("".join(chunks), b"".join(parts))
        if found is None:
            if len(chunks) > 1:
                return [x for c in chunks for x in self._align_line([c])]
            return [Chunks(np.zeros((1, 4), np.int64), np.zeros(0, np.int64), [b""], np.zeros(1, bool))]
        a, a_ends, b, b_ends = found
        stops = np.cumsum([len(p) for p in parts])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not np.isin(stops, cuts).all():
            raise ValueError("a token reaches over the start of a run of spaces")
        first = np.searchsorted(b_ends, np.append(0, a_ends[:-1]), "right")
        number = np.searchsorted(b_ends, a_ends, "left") + 1 - first
        links = (np.repeat(a, number) << 32) | gather(b, first, number)
        in_chunk = [np.searchsorted(stops, x, "left") for x in (a_ends, b_ends, cuts)]
        counts = [np.bincount(x, minlength=len(chunks)) for x in in_chunk]
        counts.append(np.bincount(np.repeat(in_chunk[0], number), minlength=len(chunks)))
        names = [list(map(str, x.tolist())) for x in (a, b)]
        ends = [(np.searchsorted(x, cuts, "left") + 1).tolist() for x in (a_ends, b_ends)]
        texts, i, j = [], 0, 0
        for k, m in zip(*ends):
            texts.append(f"{','.join(names[0][i:k])}|{','.join(names[1][j:m])}")
            i, j = k, m
        bounds = np.cumsum(counts[2]).tolist()
        groups = [";".join(texts[x:y]).encode() for x, y in zip([0, *bounds], bounds)]
        return [Chunks(np.stack(counts, 1), links, groups, np.ones(len(chunks), bool))]

    def look_up(self, chunks: list[str], times: np.ndarray) -> tuple[Chunks, np.ndarray]:
        """Alignments and the place of each distinct chunk in them; chunks that stand again are remembered."""
        if len(self.known) > REMEMBERED:
            self.known, self.held = {}, no_chunks()
        place = np.fromiter((self.known.get(c, -1) for c in chunks), np.int64, len(chunks))
        new = np.flatnonzero(place < 0)
        before, fresh = len(self.held.groups), self.align([chunks[i] for i in new])
        place[new] = before + np.arange(len(new))
        every = self.held + fresh
        again = np.flatnonzero(times[new] > 1)
        for i in again:
            self.known[chunks[new[i]]] = len(self.known)
        self.held = self.held + fresh.take(again)
        return every, place


def refine(coarse: np.ndarray, whole: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes: the coarse ones where they are ``whole``, and between two of those the last one
    plus the decoded bytes since."""
    decoded = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(whole, np.arange(len(sizes)), -1))
    known = last >= 0
    return np.where(known, coarse[last], 0) + decoded - np.where(known, decoded[last], 0)


def cut_chunks(texts: pa.Array, by_spaces: bool) -> tuple[pa.Array, np.ndarray]:
    """Space + each text, cut before every space behind a character that is no white space, if not only spaces
    follow; and the place of each text's first chunk, and the end."""
    joined = pc.binary_join_element_wise(pa.scalar(""), texts, pa.scalar(" "))
    data = joined.buffers()[2]
    bounds = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1)
    raw = np.frombuffer(data, np.uint8, int(bounds[-1]))
    starts = np.zeros(len(raw), bool)
    if by_spaces:
        space = raw == 32
        at = 1 + np.flatnonzero(space[1:] & ~space[:-1])
        starts[at[~after_white(raw, at)]] = True
        for i in np.flatnonzero(space[bounds[1:] - 1]):
            text = raw[bounds[i] : bounds[i + 1]]
            kept = np.flatnonzero(text != 32)
            starts[bounds[i] + (kept[-1] + 1 if len(kept) else 0)] = False
    starts[bounds[:-1]] = True
    first = np.flatnonzero(starts).astype(np.int32)
    offsets = pa.py_buffer(np.append(first, np.int32(len(raw))).astype(np.int32))
    chunks = pa.Array.from_buffers(pa.string(), len(first), [None, offsets, data])
    return chunks, np.searchsorted(first, bounds)


def after_white(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space may end before each place of UTF-8 text: control characters, and the blocks of
    two and three bytes that hold white space."""
    last, second, third = (raw[np.maximum(at - k, 0)] for k in (1, 2, 3))
    pair = third.astype(np.int32) << 8 | second
    return (last <= 32) | ((second == 0xC2) & ((last == 0x85) | (last == 0xA0))) | np.isin(
        pair, [0xE19A, 0xE280, 0xE281, 0xE380]
    )


def align_slab(aligner: Aligner, slab: int, doc_ids: pa.Array, texts: pa.Array) -> dict:
    """The stored row of a slab of texts."""
    texts = texts.fill_null("")
    usable = pc.and_(pc.greater(pc.binary_length(texts), 0), pc.invert(pc.match_substring(texts, SPACE_MARK)))
    rows = np.flatnonzero(usable.to_numpy(zero_copy_only=False))
    chunks, bounds = cut_chunks(texts.take(pa.array(rows)), aligner.by_spaces) if len(rows) else (pa.array([], pa.string()), np.zeros(1, np.int64))
    coded = chunks.dictionary_encode()
    numbers, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    store, place = aligner.look_up(names, np.bincount(numbers, minlength=len(names)))
    good = store.good[place]
    if not good.all():
        bad = np.add.reduceat(~good[numbers], bounds[:-1]) > 0
        keep = np.repeat(~bad, np.diff(bounds))
        rows, numbers = rows[~bad], numbers[keep]
        bounds = np.concatenate([[0], np.cumsum(np.diff(bounds)[~bad])])
    out = {"slab": slab, "doc_id": doc_ids, "numbers": numbers.astype(np.int32).tobytes()}
    per_text = np.zeros((len(texts), 4), np.int64)
    for k in range(4):
        per_text[rows, k] = sums(store.numbers[place, k][numbers], bounds)
        out[PER_TEXT[k]] = per_text[:, k].tobytes()
    spread = np.zeros(len(texts) + 1, np.int64)
    spread[rows + 1] = np.diff(bounds)
    out["bounds"] = np.cumsum(spread).tobytes()
    out["groups_sha256"] = _digests([store.groups[p] for p in place], numbers, bounds, rows, len(texts))
    number = store.numbers[:, 3]
    links = gather(store.links, (np.cumsum(number) - number)[place], number[place])
    pairs, index = np.unique(links, return_inverse=True)
    times = np.bincount(numbers, minlength=len(names))
    weights = np.repeat(times, number[place])
    totals = np.bincount(index, weights=weights, minlength=len(pairs)).astype(np.int64)
    out["link_bounds"] = np.concatenate([[0], np.cumsum(number[place])]).tobytes()
    out["links"] = index.astype(np.int32).tobytes()
    out["pairs"], out["pair_counts"] = pairs.tobytes(), totals.tobytes()
    return out


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[bounds])


def _digests(groups: list[bytes], numbers: np.ndarray, bounds: np.ndarray, rows: np.ndarray, n: int) -> list[str]:
    """SHA-256 of each text's groups, joined a bounded run of texts at a time."""
    out = [""] * n
    column = pa.array([g + b";" for g in groups], pa.binary())
    for first, number in slabs(np.diff(bounds), 1 << 18):
        a, b = int(bounds[first]), int(bounds[first + number])
        taken = column.take(pa.array(numbers[a:b]))
        offsets = np.frombuffer(taken.buffers()[1], np.int32, b - a + 1)
        data = memoryview(taken.buffers()[2])
        edges = offsets[bounds[first : first + number + 1] - a]
        for i in range(number):
            out[rows[first + i]] = hashlib.sha256(data[edges[i] : edges[i + 1] - 1]).hexdigest()
    return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner_of(a_path: str, b_path: str) -> Aligner:
    """One aligner per worker process, so that its tasks share what it remembers."""
    if (a_path, b_path) not in _aligners:
        _aligners.clear()
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def in_slabs(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Batches of texts put together or cut to slabs of about ``most`` bytes."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column("text").fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64)
        for first, number in slabs(lengths, most):
            part = int(lengths[first : first + number].sum())
            if held and size + part > most:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
            held.append(batch.slice(first, number))
            size += part
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def in_parts(row: dict) -> Iterator[pa.RecordBatch]:
    """The stored parts of a slab: its compressed row and its pairs, cut to as many pieces."""
    columns = [pa.array([row[f.name].to_pylist() if f.name == "doc_id" else row[f.name]], f.type) for f in SLAB_ROW]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, SLAB_ROW, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.RecordBatch.from_arrays(columns, schema=SLAB_ROW))
    data, pairs, counts = sink.getvalue(), *(np.frombuffer(row[c], np.int64) for c in ("pairs", "pair_counts"))
    parts = -(-max(data.size, pairs.nbytes + counts.nbytes) // PART_BYTES)
    ends, pair_ends = ([n * k // parts for k in range(parts + 1)] for n in (data.size, len(pairs)))
    for k in range(parts):
        own = slice(pair_ends[k], pair_ends[k + 1])
        values = row["slab"], k, pairs[own], counts[own], data[ends[k] : ends[k + 1]].to_pybytes()
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, PART_ROW)], schema=PART_ROW)


def joined_parts(parts: pa.Table) -> dict:
    """The row that was cut to these parts, which may come in any order."""
    data = parts.sort_by("part").column("data").to_pylist()
    return pa.ipc.open_stream(b"".join(data)).read_all().to_pylist()[0]


def aligned_slabs(docs: DataFrame, a_path: str, b_path: str, slab_bytes: int) -> DataFrame:
    def run(batches):
        aligner, task = aligner_of(a_path, b_path), TaskContext.get().partitionId()
        for number, table in enumerate(in_slabs(batches, slab_bytes)):
            columns = [table.column(c).chunk(0) for c in ("doc_id", "text")]
            row = align_slab(aligner, (task << 32) | number, *columns)
            pa.default_memory_pool().release_unused()
            yield from in_parts(row)

    with small_batches(docs.sparkSession):
        return materialise(docs.mapInArrow(run, SLAB), "aligned-slabs", **{"parquet.block.size": GROUP_BYTES})


def pair_counts(slab_rows: DataFrame) -> DataFrame:
    """(slab, pair, n): how often each slab links a pair of ids."""
    return slab_rows.select(F.col("slab").alias("slab"), F.inline(F.arrays_zip("pair", "n")))


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """Results per text of one slab from the corpus counts of its pairs."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in RESULT.split(", ")]
    if not left.num_rows:
        return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
    row = joined_parts(left)
    # a slab has asked for each of its pairs once, and its links have the places of pairs in order
    order = np.argsort(right.column("pair").to_numpy())
    bounds, link_bounds = (np.frombuffer(row[c], np.int64) for c in ("bounds", "link_bounds"))
    numbers, links = (np.frombuffer(row[c], np.int32) for c in ("numbers", "links"))
    sums_of = [
        sums(sums(right.column(c).to_numpy()[order][links], link_bounds)[numbers], bounds) for c in ("best", "n")
    ]
    columns = [row["doc_id"], *[np.frombuffer(row[c], np.int64) for c in PER_TEXT], *sums_of, row["groups_sha256"]]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
          slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    slab_rows = aligned_slabs(docs, a_path, b_path, slab_bytes)
    per_slab = pair_counts(slab_rows)
    counts = per_slab.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    # one row per id of tokenizer B
    highest = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("highest")))
    scored = counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).cast("long").alias("best"))
    asked = per_slab.select("slab", "pair").join(scored, "pair")
    stored = slab_rows.select("slab", "part", "data")
    return stored.groupBy("slab").cogroup(asked.groupBy("slab")).applyInArrow(_finish, RESULT)


def link_counts(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
                slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """(a_id, b_id, n): the corpus's table of linked ids, for mapping one vocabulary onto the other."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = pair_counts(aligned_slabs(docs, a_path, b_path, slab_bytes)).groupBy("pair").agg(F.sum("n").alias("n"))
    return counts.select(
        F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"), "n"
    )
