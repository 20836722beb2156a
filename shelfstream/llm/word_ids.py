"""Token ids and token counts of texts in Arrow batches, with the tokenizers and sentencepiece libraries.

Where a tokenizer's own rules drop white space and never look across it, each distinct word of a
slab of texts is encoded once, many to a line; ASCII punctuation at its end is a word of its own if a
letter or digit stands before, as the rules always cut there. Words that are met again, in a slab or
in a later one, are remembered. Other tokenizers get whole texts."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The normaliser steps and the pre-tokenizer under which words can be encoded apart.
APART_NORMALIZERS = ("NFC", "Lowercase", "Replace")
APART_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

SLAB_BYTES = 8 << 20
REMEMBERED = 250_000
SEEN = 1 << 22  # marks of words met before
LINE_WORDS = 500
# cut off the end of a word; not the apostrophe, which may begin a contraction
PUNCTUATION = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
ALNUM = np.array([chr(c).isalnum() and c < 128 for c in range(256)])


def slabs(lengths: np.ndarray, most: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of texts that hold at most ``most`` bytes, or one text."""
    ends = np.cumsum(lengths, dtype=np.int64)
    at, before = 0, 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, stop - at
        at, before = stop, int(ends[stop - 1])


def text_slabs(texts: pa.Array, most: int = SLAB_BYTES) -> Iterator[pa.Array]:
    """A column of texts in runs of bounded size, nulls as empty texts."""
    filled = texts.fill_null("")
    for first, number in slabs(pc.binary_length(filled).to_numpy(zero_copy_only=False), most):
        yield filled.slice(first, number)


def words_apart(path: str) -> bool:
    """Whether the tokenizer file's rules let every word be encoded by itself."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    normal = (rules.get("normalizer") or {}).get("normalizers", [])
    cuts = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        bool(normal) and all(n["type"] in APART_NORMALIZERS for n in normal)
        and all(n["pattern"] == {"Regex": r"\s+"} and n["content"] == " " for n in normal if n["type"] == "Replace")
        and bool(cuts) and cuts[0]["type"] == "Split" and cuts[0]["pattern"] == {"Regex": APART_PATTERN}
        and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
        and all(not t["lstrip"] and not t["rstrip"] for t in rules.get("added_tokens", []))
    )


def added_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file).get("added_tokens", [])]


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """The words between ASCII white space, as (place of each text's first word and the end, word
    numbers, distinct words, how often each stands). An empty word may be among them."""
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    return bounds - bounds[0], numbers, coded.dictionary, np.bincount(numbers, minlength=len(coded.dictionary))


def cut_words(words: pa.Array, kept: list[str]) -> tuple[np.ndarray, list[str]]:
    """(numbers of each word's two parts, distinct parts): what is before the ASCII punctuation at its end, and that
    punctuation, if an ASCII letter or digit or one of U+00C0 to U+00FF stands before it; else the word and
    nothing. Words that hold one of ``kept`` are not cut."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    raw = np.frombuffer(data or b"", np.uint8)
    ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    first, length = ends[:-1], np.diff(ends)
    stem = pc.binary_length(pc.ascii_rtrim(words, PUNCTUATION)).to_numpy(zero_copy_only=False)
    last = raw[np.maximum(first + stem - 1, 0)] if len(raw) else np.zeros(len(words), np.uint8)
    lead = raw[np.maximum(first + stem - 2, 0)] if len(raw) else last
    latin = (stem > 1) & (lead == 0xC3) & (last != 0x97) & (last != 0xB7)  # but the signs of multiplying and dividing
    cut = (stem > 0) & (ALNUM[last] | latin) if all(map(str.isascii, kept)) else np.zeros(len(words), bool)
    for token in kept:
        cut &= ~pc.match_substring(words, token, ignore_case=True).to_numpy(zero_copy_only=False)
    stem = np.where(cut, stem, length)
    number = np.column_stack([stem, length - stem]).ravel()
    parts = gather(raw, np.column_stack([first, first + stem]).ravel(), number)
    bounds = np.concatenate([[0], np.cumsum(number)])
    parts = pa.Array.from_buffers(pa.large_string(), len(number), [None, pa.py_buffer(bounds), pa.py_buffer(parts)])
    coded = parts.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).reshape(-1, 2), coded.dictionary.to_numpy(zero_copy_only=False).tolist()


class WordIds:
    """Ids of single words, joined to lines for the tokenizer and told apart by their offsets."""

    def __init__(self, tokenizer, kept: list[str]):
        self.tokenizer, self.kept = tokenizer, kept
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.seen = np.zeros(SEEN, bool)
        self.flat, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of each word's ids)."""
        flat, counts = [], []
        for i in range(0, len(words), 20 * LINE_WORDS):
            lines = [words[j : j + LINE_WORDS] for j in range(i, min(len(words), i + 20 * LINE_WORDS), LINE_WORDS)]
            for line, coded in zip(lines, self.tokenizer.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)):
                flat.append(np.array(coded.ids, np.uint32))
                starts = np.cumsum([0, *[len(w) + 1 for w in line[:-1]]])
                first = np.fromiter((a for a, _ in coded.offsets), np.int64, len(coded.ids))
                counts.append(np.bincount(np.searchsorted(starts, first, "right") - 1, minlength=len(line)))
        return np.concatenate(flat) if flat else np.zeros(0, np.uint32), np.concatenate(counts) if counts else np.zeros(0, np.int64)

    def look_up(self, words: pa.Array, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first place, number of ids) for distinct words that stand so often."""
        numbers, parts = cut_words(words, self.kept)
        ids, first, number = self._look_up(parts, np.bincount(numbers.ravel(), np.repeat(times, 2), len(parts)))
        both = number[numbers].sum(1)
        return gather(ids, first[numbers].ravel(), number[numbers].ravel()), np.cumsum(both) - both, both

    def _look_up(self, words: list[str], times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.known) > REMEMBERED:
            self._forget()
        place = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(place < 0)
        fresh = [words[i] for i in new]
        ids, counts = self.encode(fresh)
        place[new] = len(self.counts) + np.arange(len(new))
        all_ids, all_counts = np.concatenate([self.flat, ids]), np.concatenate([self.counts, counts])
        starts = np.cumsum(all_counts) - all_counts
        marks = np.fromiter(map(hash, fresh), np.int64, len(fresh)) % SEEN
        again = np.flatnonzero((times[new] > 1) | self.seen[marks])
        self.seen[marks] = True
        for i in again:
            self.known[fresh[i]] = len(self.known)
        own = starts[len(self.counts) :]
        self.flat = np.concatenate([self.flat, gather(ids, own[again] - len(self.flat), counts[again])])
        self.counts = np.concatenate([self.counts, counts[again]])
        return all_ids, starts[place], all_counts[place]


def gather(values: np.ndarray, first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The runs of values that begin at ``first``, one after the other."""
    ends = np.cumsum(number)
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + number, number)
    return values[places]


class Encoder:
    """Ids of whole texts by a tokenizer file; special tokens are neither added nor, in a text, treated
    otherwise than by the library's default."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            pieces = SentencePieceProcessor(model_file=path)
            self.whole = lambda texts: pieces.encode(texts, out_type=int, num_threads=1)
            self.words = None
        else:
            from tokenizers import Tokenizer

            known = Tokenizer.from_file(path)
            known.no_truncation()
            known.no_padding()
            self.whole = lambda texts: [x.ids for x in known.encode_batch_fast(texts, add_special_tokens=False)]
            self.words = WordIds(known, added_tokens(path)) if words_apart(path) else None

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of each text's ids) of one slab."""
        if self.words is None:
            coded = self.whole(texts.to_pylist())
            counts = np.array([len(x) for x in coded], np.int64)
            return np.concatenate([np.zeros(0, np.uint32), *[np.array(x, np.uint32) for x in coded]]), counts
        bounds, numbers, words, times = split_words(texts)
        ids, first, number = self.words.look_up(words, times)
        return gather(ids, first[numbers], number[numbers]), _sums(number[numbers], bounds)

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of each text's ids of one slab."""
        if self.words is None:
            return np.array([len(x) for x in self.whole(texts.to_pylist())], np.int64)
        bounds, numbers, words, times = split_words(texts)
        return _sums(self.words.look_up(words, times)[2][numbers], bounds)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[bounds])


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder per worker process, so that its tasks share what it remembers."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]
