"""License scans: phrases by word places, templates by an exact set-similarity join.

A block is a run of consecutive words of one document, across lines, at most ``1 / THRESHOLD`` times as
long as the template. A template is found in a block that holds at least ``THRESHOLD`` of its distinct
words. Words are cut into stretches of twice the longest block that begin one longest block apart, so each
block lies whole in a stretch. Template words are ranked by how many stretches of the whole corpus have
them, rarest first. With n words and ``need = ceil(THRESHOLD * n)``, one of a template's ``n - need + 1``
rarest words must be in the stretch (prefix filter), the stretch needs that many template words (length
filter), and behind the word they share both sides must have enough words left (position filter). In
stretches that pass, every block is verified by counting. Only DataFrame expressions run; templates are a
fixed list, so what is broadcast is bounded.

Defined cases: null text is empty; documents without words have no place and score 0; rows that
share id and text share their result; an empty table gives an empty result."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfstream.llm.text import row_key, whole

# fixed values: phrases, templates and the characters between words
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
            "gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8


def lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, BETWEEN), "")


def _places(low: Column, words: Column, phrase: str) -> Column:
    """Word numbers at which the phrase starts; texts without its letters aren't searched."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return found

    has = F.lit(True)
    for part in parts:
        has = has & low.contains(part)
    last = F.size(words) - len(parts)
    return F.when(has & (last >= 0), F.filter(F.sequence(F.lit(0), last), here)).otherwise(
        F.array().cast("array<int>")
    )


def base(docs: DataFrame) -> DataFrame:
    """(key, doc_id, n_words, n_base, first_word, last_word, found) of rows (key, doc_id, low)."""
    split = docs.select("key", "doc_id", "low", tokens(F.col("low")).alias("words"))
    placed = split.select(
        "key", "doc_id", F.size("words").cast("long").alias("n_words"),
        *[_places(F.col("low"), F.col("words"), p).alias(f"at{i}") for i, p in enumerate(PHRASES)],
    )
    places = F.concat(*[F.col(f"at{i}") for i in range(len(PHRASES))])
    found = F.array_compact(F.array(*[
        F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())
    ]))
    return placed.select(
        "key", "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        found.alias("found"),
    )


def longest(text: str, threshold: float = THRESHOLD) -> int:
    """Words of the longest block for a template."""
    return math.ceil(len(text.split()) / threshold - 1e-9)


def stretches(docs: DataFrame, vocabulary: list[str], step: int) -> DataFrame:
    """(key, words, known): stretches of ``2 * step`` words and which template words each has."""
    split = docs.select("key", tokens(F.col("low")).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - 1, F.lit(0)), F.lit(step))
    cut = split.select("key", F.explode(F.transform(starts, lambda i: F.slice(F.col("all"), i + 1, 2 * step))).alias("words"))
    vocabulary_list = F.array(*[F.lit(w) for w in vocabulary])
    return cut.select("key", "words", F.array_intersect("words", vocabulary_list).alias("known"))


def _list(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A bounded list of rows as literals."""
    names = [x.split()[0] for x in schema.split(", ")]
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("x")).select("x.*")


def similar(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, label, containment): blocks that hold enough of a template, best per key and label."""
    spark = docs.sparkSession
    sets = [(label, sorted(set(text.split())), longest(text, threshold)) for label, text in templates]
    vocabulary = sorted({w for _, words, _ in sets for w in words})
    found = stretches(docs, vocabulary, max(most for _, _, most in sets))
    often = {
        r["word"]: r["n"]
        for r in found.select(F.explode("known").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (often.get(w, 0), w)))}
    needs = [math.ceil(threshold * len(words) - 1e-9) for _, words, _ in sets]
    prefix_rows = [
        (t, label, len(words), need, place, r)
        for t, ((label, words, _), need) in enumerate(zip(sets, needs))
        for place, r in enumerate(sorted(rank[w] for w in words)[: len(words) - need + 1])
    ]
    prefixes = _list(spark, prefix_rows, "template int, label string, n int, need int, place int, rank int")
    members = _list(spark, [
        (t, most, words) for t, (_, words, most) in enumerate(sets)
    ], "template int, most int, members array<string>")
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    ranked = found.filter(F.size("known") >= min(needs)).select(
        "key", "words", F.array_sort(F.transform("known", lambda w: F.element_at(ranks, w))).alias("ranks")
    )
    rare = F.array(*[F.lit(r) for r in sorted({row[-1] for row in prefix_rows})])
    placed = F.transform("ranks", lambda r, i: F.struct(i.alias("at"), r.alias("rank")))
    hits = F.filter(placed, lambda x: F.array_contains(rare, x["rank"]))
    candidates = (
        ranked.select("key", "words", F.size("ranks").alias("many"), F.explode(hits).alias("hit"))
        .select("key", "words", "many", "hit.at", "hit.rank")
        .join(F.broadcast(prefixes), "rank")
        .filter(F.col("many") >= F.col("need"))
        .filter(F.least(F.col("n") - F.col("place"), F.col("many") - F.col("at")) >= F.col("need"))
    )
    places = F.sequence(F.lit(1), F.size("words"))
    held = candidates.join(F.broadcast(members), "template").withColumn("held", F.array_max(F.transform(
        places, lambda i: F.size(F.array_intersect(F.slice("words", i, F.col("most")), F.col("members")))
    )))
    return (
        held.filter(F.col("held") >= F.col("need"))
        .groupBy("key", "label").agg(F.max(F.col("held") / F.col("n")).alias("containment"))
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: words, places of base phrases, labels of phrases and of templates, and a score, the
    largest share of a template in one block, 1 where a base phrase stands."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), lower(whole(text)).alias("low"))
    rows = rows.select(row_key("doc_id", "low").alias("key"), "doc_id", "low")
    more = similar(rows).groupBy("key").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("containment")
    )
    joined = base(rows).join(more, "key", "left")
    labels = F.array_union("found", F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("found"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
