"""Words encoded apart, cached token counts and aligned tokenizers, beside the plain libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfstream.llm import alignment, token_counts, word_ids
from shelfstream.session import fresh_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "a", "B", "é", "é", "́", "漢", "😀", " ", "  ", "\n", "\t", "　", "\xa0", "'s", "'", "1", "٣", "<|endoftext|>",
    "<|ENDOFTEXT|>", "<s>", "<0x41>", "\x00", "\x1c", "Σ", "ΑΣ", "İ", "ﬁ", "가", "क़", "!", "_", " foo", " bar",
]


def odd_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(n)]


def plain_count(tokenizer: str):
    if tokenizer == PIECES:
        pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        return lambda text: len(pieces.encode(text or ""))
    known = Tokenizer.from_file(tokenizer)
    return lambda text: len(known.encode(text or "", add_special_tokens=False).ids)


def test_words_apart_give_the_ids_of_whole_texts():
    assert word_ids.words_apart(WORDS) and not word_ids.words_apart(BYTES) and not word_ids.words_apart(PIECES)
    encoder, known = word_ids.Encoder(WORDS), Tokenizer.from_file(WORDS)
    for seed in range(100):
        texts = pa.array([*odd_texts(seed, 20), None, ""], pa.string())
        for slab in word_ids.text_slabs(texts, 200):
            want = [x.ids for x in known.encode_batch(slab.to_pylist(), add_special_tokens=False)]
            ids, counts = encoder.encode(slab)
            assert ids.tolist() == [i for x in want for i in x] and counts.tolist() == [len(x) for x in want]
            assert encoder.count(slab).tolist() == counts.tolist()


def test_words_that_come_again_with_other_punctuation_are_not_encoded_again():
    encoder, encoded = word_ids.Encoder(WORDS), []
    encode = encoder.words.encode
    encoder.words.encode = lambda words: encoded.extend(words) or encode(words)
    for text in ("Harbour, größe. straßé", "größe; Harbour! straßé###", "größe... Harbour### straßé."):
        encoded.clear()
        encoder.encode(pa.array([text]))
    assert not {"Harbour", "größe", "straßé"} & {w.rstrip("#.") for w in encoded}


def test_punctuation_at_the_end_of_words_is_cut_as_whole_texts_are():
    encoder, known = word_ids.Encoder(WORDS), Tokenizer.from_file(WORDS)
    stems = ["", "a", "Z", "7", "é", "É", "×", "÷", "İ", "ÿ", "e\u0301", "'", "x's", "x'", "²", "漢", "—", "a—", "Σ", "a<|endoftext", "<|EndOfText"]
    tails = ["", ".", "###", "'", ".'", "'.", "'s.", "|>", "|>.", "=\u0338", "_", "\x7f", "\x00.", "<|endoftext|>", "!é?"]
    words = [a + b for a in stems for b in tails]
    texts = pa.array([" ".join(words), *words, *(f"{w} {w}" for w in words)])
    want = [x.ids for x in known.encode_batch(texts.to_pylist(), add_special_tokens=False)]
    for at in (0, 1, 5, 40):
        ids, counts = encoder.encode(texts.slice(at))
        assert ids.tolist() == [i for x in want[at:] for i in x] and counts.tolist() == [len(x) for x in want[at:]]


def test_slabs_cover_all_texts_in_order():
    texts = pa.array(["ab", None, "c" * 50, "", "d"])
    assert [x.to_pylist() for x in word_ids.text_slabs(texts, 3)] == [["ab", ""], ["c" * 50], ["", "d"]]
    assert list(word_ids.text_slabs(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("tokenizer", [WORDS, BYTES, PIECES])
def test_token_counts(spark, tokenizer):
    count = plain_count(tokenizer)
    texts = [None, "", " ", "same text", "same  text", "same text", "w " * 2100, *odd_texts(1, 40)]
    rows = [(i if i % 9 else None, t, "x", 1) for i, t in enumerate(texts)] + [(3, "same text", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, n_tokens int").repartition(3)
    got = Counter(map(tuple, token_counts.count_tokens(docs, tokenizer).collect()))
    assert got == Counter((i, len((t or "").encode()), count(t), count(t) > 2048) for i, t, *_ in rows)
    assert token_counts.count_tokens(docs.limit(0), tokenizer).count() == 0


def test_only_missing_digests_are_encoded_and_appended(spark):
    cache = fresh_path(spark, "cache")
    folder = f"{cache}/tokenizer={token_counts.tokenizer_digest(WORDS)}"

    def run(texts):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, WORDS, cache).collect()}

    assert run(["one two", "one\n two", "three"]) == {0: 2, 1: 2, 2: 1}
    assert spark.read.parquet(folder).count() == 2
    # a stored count is taken as it is: nothing but "four" is encoded
    digests = spark.sql("SELECT unhex(sha2('three', 256)) AS digest, 0L AS n_tokens")
    digests.write.mode("append").parquet(folder)
    assert run(["three", "four", None]) == {0: 0, 1: 1, 2: 0}
    assert spark.read.parquet(folder).count() == 5
    assert run(["four"]) == {0: 1} and spark.read.parquet(folder).count() == 5


def test_the_cache_tells_tokenizers_apart():
    assert len({token_counts.tokenizer_digest(x) for x in (WORDS, BYTES, PIECES)}) == 3


def plain_alignment(texts):
    """Per text by the statement of the task: one loop over the bytes of space + text."""
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    symbols = alignment.byte_symbols()
    rows, counts = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        a_ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b.encode(text) if text else []
        a_bytes = [bytes(symbols[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in b_ids
        ]
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            rows.append(None)
            continue
        owner = [[k for k, x in enumerate(y) for _ in x] for y in (a_bytes, b_bytes)]
        links = sorted({(i, j) for i, j in zip(*owner)})
        groups, start = [], 0
        for at in range(1, len(raw) + 1):
            if at == len(raw) or all(o[at] != o[at - 1] for o in owner):
                parts = [",".join(str(ids[k]) for k in dict.fromkeys(o[start:at])) for ids, o in zip((a_ids, b_ids), owner)]
                groups.append("|".join(parts))
                start = at
        pairs = [(a_ids[i], b_ids[j]) for i, j in links]
        counts.update(pairs)
        rows.append((len(a_ids), len(b_ids), groups, pairs))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if r is None else (
            r[0], r[1], len(r[2]), len(r[3]), sum(counts[p] == highest[p[1]] for p in r[3]), sum(counts[p] for p in r[3]),
            hashlib.sha256(";".join(r[2]).encode()).hexdigest(),
        ) for r in rows
    ], counts


def test_alignment(spark):
    texts = [
        None, "", " ", "  ", " x", "x ", "x  ", "a\n  b", "a \n b", "a　 b", "a\x85  b", "a\xa0 b", "tab\t\t x", "▁", "a ▁b",
        "same words same words", "same words same words", "don't  stop", "w " * 3000, "漢字かな交じり文 と 😀😀 é", *odd_texts(5, 300),
    ]
    rows = [(i if i % 9 else None, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slab int, pair string").repartition(3)
    want, counts = plain_alignment(texts)
    assert sum(w[0] == 0 for w in want) >= 4
    for size in (alignment.SLAB_BYTES, 300):
        got = alignment.align(docs, BYTES, PIECES, slab_bytes=size).collect()
        assert Counter(map(tuple, got)) == Counter((r[0], *w) for r, w in zip(rows, want))
    links = alignment.link_counts(docs, BYTES, PIECES).collect()
    assert {(r.a_id, r.b_id): r.n for r in links} == dict(counts) and len(links) == len(counts)
    assert alignment.align(docs.limit(0), BYTES, PIECES).count() == 0


@pytest.mark.parametrize("by_spaces", [True, False])
def test_random_texts_align_in_slabs(by_spaces):
    aligner = alignment.Aligner(BYTES, PIECES)
    assert aligner.by_spaces
    aligner.by_spaces = by_spaces  # else every text is one chunk
    for seed in range(60):
        texts = odd_texts(seed, 30)
        row = alignment.align_slab(aligner, 0, pa.array(range(30)), pa.array(texts))
        want, _ = plain_alignment(texts)
        got = [np.frombuffer(row[c], np.int64).tolist() for c in alignment.PER_TEXT]
        assert list(zip(*got, row["groups_sha256"])) == [(*w[:4], w[6]) for w in want]


def test_slabs_are_stored_in_small_parts(spark):
    """No stored row is large, however much a slab holds, and the parts give the slab's row again."""
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(300)) for _ in range(200)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    stored = alignment.aligned_slabs(docs, BYTES, PIECES, alignment.SLAB_BYTES).toArrow()
    parts = len(stored)
    assert stored.column("slab").unique().to_pylist() == [0] and parts > 3
    assert max(len(d) + 8 * (len(p) + len(n)) for d, p, n in zip(*(stored.column(c).to_pylist() for c in ("data", "pair", "n")))) <= 2 * alignment.PART_BYTES
    want = alignment.align_slab(alignment.Aligner(BYTES, PIECES), 0, pa.array(range(202)), pa.array(texts))
    row = alignment.joined_parts(stored.take(pa.array(rng.sample(range(parts), parts))))
    assert row == {c: want[c].to_pylist() if c == "doc_id" else want[c] for c in row}
    in_order = stored.sort_by("part")
    for stands, c in (("pair", "pairs"), ("n", "pair_counts")):
        assert sum(in_order.column(stands).to_pylist(), []) == np.frombuffer(want[c], np.int64).tolist()
