"""License scans: fixed phrases, and an exact set-similarity join with templates.

Words are runs of a-z, 0-9 and everything beyond ASCII in the text with A-Z
lower-cased.  The base scan finds places where a phrase's words stand one after
another.  The method joins text blocks (all stretches of ``BLOCK`` consecutive
words, across lines, and shorter texts whole) with license templates: a block
matches if it holds at least ``THRESHOLD`` of the template's distinct words.
Templates of fewer than ``LEAST`` distinct words say too little as sets; they
match where their words stand one after another.

The join is exact.  Template words are ordered by how many documents of the
whole corpus hold them, rarest first.  A block that meets the threshold must
hold one of a template's first t - need + 1 words (prefix filter) and at least
``need`` template words (length filter: the place of the word ``need`` - 1
template words further on must be in the block), and cannot reach ``need`` if
the rarest word it holds stands too far back in that order (positional filter).
A stretch can only be the best if it starts at a template word, so the starts
tried are as many as a text has template words, each looking at one block.  The
template side is a fixed list, so it travels as literals; nothing is shuffled
but the word counts.

Defined results: null counts as empty; a text without words has no places, no
labels, score 0; a very long text costs time in proportion to its words; the
score of a text without a match is 0, however near its blocks come; repeated
rows each get their row; ties cannot matter, as labels are sets; an empty table
gives an empty result.
"""

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairflow.llm.base import LOWER

# The phrases of the base scan and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Opening words of common license notices, further stretches of the
# texts (of at most 32 words, half a block), and their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-sa", "cc by sa"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial"),
)
THRESHOLD = 0.85
BLOCK = 64
LEAST = 6
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), *LOWER)


def _spaced(lowered: Column) -> Column:
    """The words, each between single spaces; one space if there is none."""
    return F.concat(F.lit(" "), F.ltrim(F.regexp_replace(F.concat(lowered, F.lit(" ")), NOT_WORD, " ")))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _array(words) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _words(spaced: Column) -> Column:
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def word_order(docs: DataFrame, words: list, text_col: str = "text") -> dict:
    """Documents that hold each of ``words``: at most one row for each comes back."""
    held = F.array_intersect(_words(_spaced(_lowered(F.col(text_col)))), _array(words))
    rows = docs.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    return {w: 0 for w in words} | {r["w"]: r["n"] for r in rows}


def _containment(hits: Column, template: list, need: int) -> Column:
    """The largest share of ``template`` (rarest word first) in any block of the
    text whose template words with their places are ``hits``; 0 below ``need``."""
    prefix, places = template[: len(template) - need + 1], _array(template)

    def best(own):
        def one(hit, i):
            block = F.filter(F.slice(own, i + 1, F.lit(BLOCK)), lambda x: x["p"] < hit["p"] + BLOCK)
            words = F.array_distinct(F.transform(block, lambda x: x["w"]))
            rarest = F.array_min(F.transform(words, lambda w: F.array_position(places, w)))
            return F.when(F.lit(len(template) + 1) - rarest >= need, F.size(words)).otherwise(0)

        def reach(hit, i):
            return F.try_element_at(own, i + need)["p"] < hit["p"] + BLOCK

        tried = F.transform(own, lambda hit, i: F.when(reach(hit, i), one(hit, i)).otherwise(0))
        able = (F.size(own) >= need) & F.exists(own, lambda x: x["w"].isin(prefix))
        return F.when(able, F.array_max(tried)).otherwise(0)

    own = F.filter(hits, lambda x: x["w"].isin(template))
    most = F.coalesce(F.element_at(F.transform(F.array(own), best), 1), F.lit(0))
    return F.when(most >= need, most / F.lit(float(len(template)))).otherwise(0.0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the largest containment of a template that a
    block matches; 1 where a phrase stands; else 0)."""
    short = [(label, text) for label, text in TEMPLATES if len(set(text.split())) < LEAST]
    sets = [(label, sorted(set(text.split()))) for label, text in TEMPLATES if (label, text) not in short]
    count = word_order(docs, sorted({w for _, t in sets for w in t}), text_col)
    ordered = [(label, sorted(t, key=lambda w: (count[w], w))) for label, t in sets]
    needs = [max(1, ceil(threshold * len(t) - 1e-9)) for _, t in ordered]
    prefixes = [t[: len(t) - need + 1] for (_, t), need in zip(ordered, needs)]
    rare = _array(sorted({w for p in prefixes for w in p}))

    rows = docs.select(F.col(id_col).alias("_id"), _spaced(_lowered(F.col(text_col))).alias("_s"))
    rows = rows.select("_id", "_s", (_spaces(F.col("_s")) - 1).cast("long").alias("n_words"))

    # Base phrases: the pieces between the places of a phrase give their number and positions.
    cols = ["_id", "_s", "n_words"]
    for n, (phrase, _) in enumerate(PHRASES):
        pieces = F.split("_s", f" {phrase}(?= )")
        rows = rows.select(*cols, F.when(F.col("_s").contains(f" {phrase} "), pieces).alias(f"_p{n}"))
        cols.append(f"_p{n}")
    places = [F.coalesce(F.size(f"_p{n}") - 1, F.lit(0)) for n in range(len(PHRASES))]
    found = [F.col(f"_p{n}").isNotNull() for n in range(len(PHRASES))]
    firsts = [F.when(found[n], _spaces(F.element_at(f"_p{n}", 1))) for n in range(len(PHRASES))]
    lasts = [
        F.when(found[n], F.col("n_words") - (_spaces(F.element_at(f"_p{n}", -1)) - 1) - len(p.split()))
        for n, (p, _) in enumerate(PHRASES)
    ]

    # Templates: only rows that hold a prefix word list their template words.
    words = _words(F.col("_s"))
    placed = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("p"), w.alias("w"))), lambda x: x["w"].isin(sorted(count)))
    none = F.array().cast("array<struct<p:int,w:string>>")
    rows = rows.withColumn("_h", F.when(F.arrays_overlap(words, rare), placed).otherwise(none))

    rows = rows.select(
        "_id",
        "n_words",
        sum(places[1:], places[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(f, F.lit(label)) for f, (_, label) in zip(found, PHRASES)])))).alias("_base"),
        F.array(
            *[_containment(F.col("_h"), t, need) for (_, t), need in zip(ordered, needs)],
            *[F.col("_s").contains(f" {text} ").cast("double") for _, text in short],
        ).alias("_c"),
    )
    names = [label for label, _ in ordered + short]
    matched = F.array_compact(F.array(*[F.when(F.col("_c")[n] > 0, F.lit(label)) for n, label in enumerate(names)]))
    return rows.select(
        F.col("_id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", matched)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.array_max("_c")).alias("score"),
    )
