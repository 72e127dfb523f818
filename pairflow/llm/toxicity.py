"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, applies Unicode compatibility forms, drops invisible
characters, maps look-alike letters to Latin ones and digits or signs beside
letters to the letters they stand for; i, l and 1 fold together.  One automaton
finds all terms (whole words, or stems at the start of a word) and all
exception phrases; a term inside an exception phrase doesn't count.  The sum of
weights, and that sum per hundred words, give the score through a logistic
curve.

Terms are learned from labelled texts: a word, or the first 4 to 8 letters of
one, joins the lexicon if the texts that hold it are toxic far more often than
others (likelihood ratio), with its log odds as weight.  Equal texts count
once.  Counting covers all labelled rows given, and the lexicon keeps every
term that passes and that no shorter one makes idle.  It travels to the tasks
as a broadcast; one of more than ``MOST_LETTERS`` letters is an error, not a
cut.  The curve is fitted on labelled rows that the lexicon has not seen, from
a histogram of bounded size.

Defined results: null counts as empty; a text without matches gets the curve's
floor; a very long text is matched in one walk over its letters; an empty table
gives an empty result; of terms that start at one place the heaviest counts;
labels null or of unknown documents are ignored; without labels of both kinds
the built-in lexicon and curve hold; repeated rows each get their row; where
labelled documents share an id, the text of the smallest hash is learned from.
"""

import math
import re
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairflow.llm.base import fold, per_process, saved, strings

MOST_LETTERS = 4_000_000  # about half a million terms; the automaton takes some hundred bytes a letter
LEAST_TEXTS = 4  # toxic texts that hold a term
LEAST_RATIO = 20.0  # twice the log likelihood ratio; more where many terms are tried, so that chance finds about none
FLUSH = 400_000  # counters held by a task before it hands them on
FLUSH_LETTERS = 8_000_000  # or letters of the words that they count
STEMS = range(4, 9)
# A small general lexicon with its weight, and phrases in which a term is harmless.
WORDS = ("idiot", "moron", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting", "imbecile", "clown", "trash", "filth", "dumbass", "asshole", "bastard", "bitch")
WEIGHT = 3.0
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pathetic fallacy", "sore loser", "pond scum", "idiot proof")
# Look-alike letters (Cyrillic, Greek, Latin variants) and the letters that they resemble.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ι": "i", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "κ": "k", "ε": "e",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "l",
}
# Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}

_ALIKE = str.maketrans({**LOOKALIKES, "l": "i"})
_STAND = str.maketrans(SUBSTITUTES)
_HIDDEN = re.compile("[­͏؜ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁤︀-️﻿]")
_BESIDE = re.compile(r"(?<=[^\W\d_])[0134578@$]+|[0134578@$]+(?=[^\W\d_])|(?<=[^\W\d_])[!|]+(?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")


def folded_words(text: str) -> list:
    t = text
    if not t.isascii():
        t = _HIDDEN.sub("", unicodedata.normalize("NFKC", t))
    t = t.lower()
    t = _BESIDE.sub(lambda m: m[0].translate(_STAND), t)
    return _WORD.findall(t.translate(_ALIKE))


def _key(phrase: str) -> str:
    return " " + " ".join(folded_words(phrase))


def _terms(words: list) -> set:
    """Whole words end in a space, stems don't."""
    own = set(words)
    out = {w + " " for w in own if len(w) >= 3}
    for n in STEMS:
        out.update({w[:n] for w in own if len(w) >= n})
    return out


def _learn(rows: DataFrame) -> list:
    """``rows``: (text, toxic).  The terms and weights of the lexicon."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple = (defaultdict(int), defaultdict(int))
        letters = 0

        def out():
            terms = sorted(held[0].keys() | held[1].keys())
            frame = pd.DataFrame({"term": terms, "pos": [held[1].get(t, 0) for t in terms], "neg": [held[0].get(t, 0) for t in terms]})
            held[0].clear()
            held[1].clear()
            return frame

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                own = held[int(toxic > 0)]
                for t in _terms(folded_words(text)):
                    if t not in own:
                        letters += len(t)
                    own[t] += 1
                if len(held[0]) + len(held[1]) >= FLUSH or letters >= FLUSH_LETTERS:
                    yield out()
                    letters = 0
        if held[0] or held[1]:
            yield out()

    totals = rows.agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).first()
    p, n = totals["p"] or 0, totals["n"] - (totals["p"] or 0)
    if not p or not n:
        return []
    terms = rows.mapInPandas(count, "term string, pos long, neg long").groupBy("term")
    terms = terms.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") >= LEAST_TEXTS)
    terms = saved(terms)
    least = max(LEAST_RATIO, 2 * math.log(max(1, terms.count())))
    share, base = F.col("pos") / (F.col("pos") + F.col("neg")), p / (p + n)
    clean = F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    ratio = 2 * (F.col("pos") * F.log(share / base) + clean)
    odds = F.log((F.col("pos") + 0.5) / (p + 1.0) / ((F.col("neg") + 0.5) / (n + 1.0)))
    best = terms.select("term", F.least(odds, F.lit(8.0)).alias("w"), odds.alias("o"), ratio.alias("g")).where(f"o >= 2 and g >= {least}")
    best = lexicon(saved(best.select("term", "w")))
    size = best.agg(F.sum(F.length("term"))).first()[0] or 0
    if size > MOST_LETTERS:
        raise ValueError(f"a lexicon of {size} letters; at most {MOST_LETTERS} are broadcast")
    return sorted((r["term"], r["w"]) for r in best.collect())


def lexicon(terms: DataFrame) -> DataFrame:
    """``terms``: (term, w), each once.  Those that say something new: a longer
    term doesn't where a stem of it weighs no less but a little."""
    whole = F.rtrim("term")
    stems = F.transform(F.array(*[F.lit(n) for n in STEMS]), lambda n: F.when((F.length(whole) >= n) & (n < F.length("term")), F.substring(whole, F.lit(1), n)))
    of = terms.select("term", "w", F.explode(F.array_compact(stems)).alias("stem"))
    idle = of.join(terms.select(F.col("term").alias("stem"), F.col("w").alias("has")), "stem").where("has >= w - 1").select("term")
    return saved(terms.join(idle, "term", "left_anti"))


def automaton(terms: list) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word in WORDS:
        a.add_word(_key(word) + " ", (len(_key(word)), WEIGHT))
    for term, weight in terms:
        a.add_word(" " + term, (len(term.rstrip()) + 1, weight))
    for phrase in EXCEPTIONS:
        a.add_word(_key(phrase) + " ", (len(_key(phrase)), None))
    a.make_automaton()
    return a


def weigh(a: ahocorasick.Automaton, text: str) -> tuple:
    """(words, matches, sum of weights) of one text."""
    words = folded_words(text)
    hits, excused = [], []
    s = " " + " ".join(words) + " "
    for end, (n, w) in a.iter(s):
        end -= s[end] == " "  # the end of the last letter
        (excused if w is None else hits).append((end - n + 1, end, w))
    if excused:
        hits = [h for h in hits if not any(x <= h[0] and h[1] <= y for x, y, _ in excused)]
    best: dict = {}
    for start, _, w in hits:  # one term for each place
        best[start] = max(w, best.get(start, 0.0))
    return len(words), len(best), float(sum(best.values()))


def features(terms: list, spark, text: Column) -> Column:
    """struct<n_words, n_matches, weight> of each text."""
    held, key = spark.sparkContext.broadcast(terms), f"lexicon-{uuid.uuid4().hex}"

    @F.pandas_udf("n_words long, n_matches long, weight double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a = per_process(key, lambda: automaton(held.value))
        for series in batches:
            yield pd.DataFrame([weigh(a, t) for t in strings(series)], columns=["n_words", "n_matches", "weight"])

    return run(text)


def _inputs(weight, words) -> tuple:
    return F.log1p(weight), F.log1p(100 * weight / F.greatest(words, F.lit(20)))


def _fit(rows: DataFrame) -> tuple:
    """Logistic curve from (weight, n_words, toxic): Newton steps over a
    histogram whose cells are halves of either input (each is below 25)."""
    x, y = _inputs(F.col("weight"), F.col("n_words"))
    cells = rows.select(F.round(2 * x).alias("x"), F.round(2 * y).alias("y"), "toxic").groupBy("x", "y", "toxic").count().toPandas()
    if cells["toxic"].nunique() < 2:
        return -3.0, 2.0, 1.0
    a = np.column_stack([np.ones(len(cells)), cells["x"] / 2, cells["y"] / 2])
    t, n = cells["toxic"].to_numpy(float), cells["count"].to_numpy(float)
    b, ridge = np.zeros(3), np.diag([1e-6, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (n * (t - p)) - ridge @ b)
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(max(0, b[1])), float(max(0, b[2]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic") -> dict:
    """Learn from the rows of ``labels`` and the texts that they name."""
    spark = docs.sparkSession
    marks = labels.select(F.col(id_col).alias("_id"), (F.col(toxic_col) > 0).cast("int").alias("toxic")).where("_id is not null and toxic is not null")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where("_id is not null and text is not null")
    # One of equal texts, found among ids and hashes alone.
    narrow = texts.select("_id", F.xxhash64("text").alias("h")).join(marks, "_id")
    one = narrow.groupBy("h").agg(F.min("_id").alias("_id"), F.max("toxic").alias("toxic")).drop("h")
    texts = texts.withColumn("_h", F.xxhash64("text")).join(one, "_id").groupBy("_id").agg(F.min(F.struct("_h", "text", "toxic")).alias("r")).select("_id", "r.text", "r.toxic")
    rows = saved(texts.select((fold("_id", 5) == 4).alias("_check"), "text", "toxic"))
    terms = _learn(rows.where("not _check").select("text", "toxic"))
    seen = rows.where("_check").select(features(terms, spark, F.col("text")).alias("f"), "toxic").select("f.*", "toxic")
    return {"terms": terms, "curve": _fit(seen)}


def score(model: dict, spark, text: Column) -> Column:
    """struct<n_words, n_matches, weight>; see ``probability``."""
    return features(model["terms"], spark, text)


def probability(model: dict, found: Column) -> Column:
    """The probability that a text is toxic, from what ``score`` found in it."""
    x, y = _inputs(found["weight"], found["n_words"])
    a, b, c = model["curve"]
    return 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * x + F.lit(c) * y)))
