"""Language ID with bit-sliced Bloom filters over letter trigrams.

Training counts the letter trigrams of every labelled text (one partial count
per task and batch, one shuffle, kept as a table).  A trigram belongs to a
language if it makes up at least ``MIN_SHARE`` of that language's trigrams,
which bounds a language's set by 1 / MIN_SHARE, and if no other language has it
``RIVAL`` times as often.  One bit-sliced Bloom filter holds all sets: position
p keeps a bitmask of languages, and the AND of a trigram's K positions is the
set of all languages that contain it.  A text counts, per language, the
trigrams whose mask has its bit, minus the hits that the filter's false
positives explain.

The filter goes to every task, so its bytes are reckoned before it is built.
Beyond ``FILTER_BYTES`` or ``MOST_LANGUAGES`` the sets stay a table, and the
trigrams of the distinct texts are joined with it: the same counts, without
false positives.

Defined results: text null or without a letter: ``und`` and score 0; a text
whose trigrams no language has, and ties: the language with more training
trigrams, then the smaller name; no labelled rows, an empty table too: ``und``.
Rows with a null language are never learned from; repeated rows are learned
from each time, and each gets its row.  Texts of any length are read whole, in
pieces of ``SLICE`` characters that count what the whole would count.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairflow.llm.base import codepoints, fresh, per_process, saved, strings

MIN_SHARE = 1e-5
RIVAL = 10.0
K = 4
FILTER_BYTES = 128 << 20  # of the filter, and of the trigrams it is built from
MOST_LANGUAGES = 256  # in a filter; more stay a table
SLICE = 1_000_000  # characters handled at once
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    return per_process("letters", lambda: np.array([chr(c).isalpha() for c in range(0x110000)]))


def _trigrams(pieces: list) -> tuple:
    """(codes, owner) of the trigrams around the letters of (owner, text, from, to);
    letters outside of from..to are neighbours only."""
    letter = _letters()
    arrays = [codepoints(" " + text + " ") for _, text, _, _ in pieces]
    a = np.concatenate(arrays)
    centre = letter[np.minimum(a, 0x10FFFF)]
    a = np.where(centre, a, 32).astype(np.int64)
    ends = np.cumsum([len(x) for x in arrays])
    for (_, _, low, high), x, end in zip(pieces, arrays, ends):
        centre[end - len(x) : end - len(x) + 1 + low] = False
        centre[end - len(x) + 1 + high : end] = False
    at = np.flatnonzero(centre)
    owner = np.repeat(np.array([p[0] for p in pieces], np.int64), [len(x) for x in arrays])
    return (a[at - 1] << 42) | (a[at] << 21) | a[at + 1], owner[at]


def trigrams(texts: list) -> Iterator[tuple]:
    """(codes, text index) of all letter trigrams around a letter, in bounded
    parts; a character that is no letter counts as a space."""
    pieces, size = [], 0
    for i, t in enumerate(texts):
        low = t.lower()
        for start in range(0, len(low), SLICE):
            stop = min(start + SLICE, len(low))
            first = max(0, start - 1)
            pieces.append((i, low[first : stop + 1], start - first, stop - first))
            size += stop - start
            if size >= SLICE:
                yield _trigrams(pieces)
                pieces, size = [], 0
    if pieces:
        yield _trigrams(pieces)


def _mix(codes: np.ndarray, k: int, size: int) -> np.ndarray:
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)).astype(np.int64) & (size - 1)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict:
    """Learn from all rows of ``docs``: ``names`` and either a filter of bounded
    size or ``sets``, a table (gram, lang, rank)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), strings(batch.column(1).to_pylist())
            for lang in sorted(set(langs)):
                for codes, _ in trigrams([t for t, x in zip(texts, langs) if x == lang]):
                    codes, n = np.unique(codes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"],
                    )

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    counts = saved(
        rows.mapInArrow(count, "lang string, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    order = [F.col("total").desc(), F.col("lang")]
    names = [r["lang"] for r in totals.orderBy(*order).limit(MOST_LANGUAGES + 1).collect()]
    if not names:
        return {"names": []}
    shares = counts.join(totals, "lang").select("gram", "lang", "total", (F.col("n") / F.col("total")).alias("s"))
    top = shares.groupBy("gram").agg(F.max("s").alias("top"))
    sets = shares.join(top, "gram").where((F.col("s") >= MIN_SHARE) & (F.col("s") * RIVAL >= F.col("top")))
    sets = saved(sets.select("gram", "lang", "total"))
    r = sets.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("gram").alias("grams")).first()
    size = 1 << max(12, int(np.ceil(np.log2(max(1, r["grams"]) * 12))))
    planes = -(-len(names) // 64)
    if len(names) > MOST_LANGUAGES or max(planes * size * 8, r["rows"] * 16) > FILTER_BYTES:
        return {"names": names, "sets": sets}
    index = F.array_position(F.array(*[F.lit(x) for x in names]), F.col("lang")) - 1
    grams = sets.select("gram", index.alias("l")).toPandas()
    codes, langs = grams["gram"].to_numpy(np.int64), grams["l"].to_numpy(np.int64)
    table = np.zeros((planes, size), np.uint64)
    for k in range(K):
        np.bitwise_or.at(table, (langs >> 6, _mix(codes, k, size)), np.uint64(1) << (langs & 63).astype(np.uint64))
    wrong = [float(np.mean((table[i >> 6] >> np.uint64(i & 63)) & np.uint64(1)) ** K) for i in range(len(names))]
    return {"names": names, "table": table, "wrong": wrong}


def rates(model: dict, texts: list) -> tuple:
    """Per text: trigrams, and the corrected share of them in each language."""
    names, table = model["names"], model["table"]
    n, hits = np.zeros(len(texts)), np.zeros((len(texts), len(names)))
    for codes, who in trigrams(texts):
        n += np.bincount(who, minlength=len(texts))
        spots = [_mix(codes, k, table.shape[1]) for k in range(K)]
        for p in range(table.shape[0]):
            mask = table[p][spots[0]]
            for s in spots[1:]:
                mask = mask & table[p][s]
            for i in range(64 * p, min(64 * p + 64, len(names))):
                hit = ((mask >> np.uint64(i & 63)) & np.uint64(1)).astype(bool)
                hits[:, i] += np.bincount(who[hit], minlength=len(texts))
    wrong = np.asarray(model["wrong"])
    return n, np.clip((hits / np.maximum(n, 1)[:, None] - wrong) / np.maximum(1e-9, 1 - wrong), 0, 1)


def _by_filter(model: dict, spark, text: Column) -> Column:
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, hit double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        for series in batches:
            texts = strings(series)
            n, rate = rates(m, texts)
            best = rate.argmax(axis=1)
            top = rate[np.arange(len(texts)), best]
            total = rate.sum(axis=1)
            yield pd.DataFrame(
                {
                    "lang": [m["names"][i] if k else UNDETERMINED for i, k in zip(best, n)],
                    "score": np.where(total > 0, top / np.maximum(total, 1e-12), 0.0),
                    "hit": top,
                }
            )

    return run(text)


def _by_join(model: dict, docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """Equal texts are counted once; a trigram of many texts is a hot key of the
    join, which AQE splits on the side of the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for codes, who in trigrams(strings(batch.column(1).to_pylist())):
                if not len(codes):
                    continue
                order = np.lexsort((codes, who))
                who, codes = who[order], codes[order]
                first = np.flatnonzero(np.r_[True, (np.diff(who) != 0) | (np.diff(codes) != 0)])
                n = np.diff(np.r_[first, len(codes)])
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(who[first])), pa.array(codes[first]), pa.array(n)], names=["key", "gram", "n"])

    key = fresh(docs, "_text_key")
    keyed = docs.withColumn(key, F.sha2(F.col(text_col), 256))
    texts = keyed.select(F.col(key).alias("key"), F.col(text_col).alias("text")).where("key is not null")
    grams = saved(texts.dropDuplicates(["key"]).mapInArrow(count, "key string, gram long, n long"))
    hits = grams.join(model["sets"], "gram").groupBy("key", "lang", "total").agg(F.sum("n").alias("hits"))
    best = hits.groupBy("key").agg(
        F.min(F.struct((-F.col("hits")).alias("h"), (-F.col("total")).alias("t"), "lang")).alias("best"), F.sum("hits").alias("all")
    )
    found = grams.groupBy("key").agg(F.sum("n").alias("n")).join(best, "key", "left")
    found = found.select(
        F.col("key").alias(key),
        F.struct(
            F.coalesce("best.lang", F.lit(model["names"][0])).alias("lang"),
            F.coalesce(-F.col("best.h") / F.col("all"), F.lit(0.0)).alias("score"),
            F.coalesce(-F.col("best.h") / F.col("n"), F.lit(0.0)).alias("hit"),
        ).alias(out),
    )
    nothing = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("hit"))
    return keyed.join(found, key, "left").withColumn(out, F.coalesce(out, nothing)).drop(key)


def predict(model: dict, docs: DataFrame, text_col: str = "text", out: str = "p") -> DataFrame:
    """``docs`` with a further column ``out``, struct<lang string, score double,
    hit double>: the language, its share of all languages' corrected rates, and
    its own corrected rate."""
    if not model["names"]:
        nothing = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("hit"))
        return docs.withColumn(out, nothing)
    if "sets" in model:
        return _by_join(model, docs, text_col, out)
    return docs.withColumn(out, _by_filter(model, docs.sparkSession, F.col(text_col)))
