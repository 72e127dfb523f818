"""Language ID against plain Python: trigrams of cut texts, sets, both ways of matching."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairflow.llm import langid


def grams(text):
    """Trigrams around each letter; any other character, and either end, is a space."""
    t = [" ", *((c if c.isalpha() else " ") for c in (text or "").lower()), " "]
    return Counter("".join(t[i - 1 : i + 2]) for i in range(1, len(t) - 1) if t[i] != " ")


def spelled(codes):
    return Counter("".join(chr((c >> s) & 0x1FFFFF) for s in (42, 21, 0)) for c in codes.tolist())


def brute(rows, texts):
    """The language, score and hit share of each text, learned from (text, lang) rows."""
    seen = {}
    for text, lang in rows:
        if lang is not None and text is not None:
            seen.setdefault(lang, Counter()).update(grams(text))
    total = {x: sum(c.values()) for x, c in seen.items()}
    share = {x: {g: n / total[x] for g, n in c.items()} for x, c in seen.items() if total[x]}
    top = Counter()
    for c in share.values():
        for g, s in c.items():
            top[g] = max(top[g], s)
    sets = {x: {g for g, s in c.items() if s >= langid.MIN_SHARE and s * langid.RIVAL >= top[g]} for x, c in share.items()}
    names = sorted(sets, key=lambda x: (-total[x], x))
    out = []
    for text in texts:
        c = grams(text)
        n = sum(c.values())
        hits = [sum(k for g, k in c.items() if g in sets[x]) for x in names]
        best = max(hits, default=0)
        out.append(("und", 0.0, 0.0) if not n or not names else (names[hits.index(best)], best / max(1, sum(hits)), best / n))
    return out


@pytest.fixture(scope="module")
def rows():
    """Four languages of own and shared words, equal texts, ties and texts of neither."""
    rng = random.Random(5)
    words = {x: ["".join(rng.choices(abc, k=rng.randint(2, 7))) for _ in range(60)] for x, abc in (("aa", "abcdefgh"), ("bb", "efghijkl"), ("cc", "ßäöüé"), ("dd", "中文字符"))}
    out = [(" ".join(rng.choices(words[x], k=rng.randint(1, 40))), x if rng.random() < 0.8 else None) for x in words for _ in range(40)]
    out += [("Abc, abc! ABC", "aa")] * 30 + [(None, "aa"), ("", "bb"), ("12 34", "cc"), ("zzz zzz", None), ("İI ΑΣ ΑΣΑ", None), (None, None)]
    return [(i, t, x) for i, (t, x) in enumerate(out)]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_pieces_count_what_whole_texts_count(monkeypatch, size):
    monkeypatch.setattr(langid, "SLICE", size)
    texts = ["", "a", "ab cd  ef-gh", "İstanbul ΑΣ ΑΣΑ", "x" * 50, " ", "1 2 3 letters 4"]
    got = [Counter() for _ in texts]
    for codes, who in langid.trigrams(texts):
        for i in set(who.tolist()):
            got[i] += spelled(codes[who == i])
    assert got == [grams(t) for t in texts]


@pytest.mark.parametrize("bound", [0, 128 << 20])
def test_language_equals_brute_force(spark, monkeypatch, rows, bound):
    """Bound 0: the join on trigrams, exact; else the filter, whose false positives are corrected."""
    monkeypatch.setattr(langid, "FILTER_BYTES", bound)
    schema = "doc_id long, text string, lang string, gram int, key int, n int, total int, _text_key int, hits int"
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], schema).repartition(4)
    model = langid.train(docs)
    assert ("sets" in model) == (bound == 0)
    found = langid.predict(model, docs)
    assert found.columns == [*docs.columns, "p"]
    got = {r.doc_id: r for r in found.collect()}
    want = brute([(t, x) for _, t, x in rows], [t for _, t, _ in rows])
    assert len(got) == len(rows)
    off = 1e-9 if bound == 0 else 0.02
    for (i, _, _), (lang, score, hit) in zip(rows, want):
        p = got[i].p
        assert (p["lang"], p["score"], p["hit"]) == (lang, pytest.approx(score, abs=off), pytest.approx(hit, abs=off))


def test_more_languages_than_a_filter_holds(spark):
    rows = [(i, f"{chr(0x4E00 + i)}{chr(0x5E00 + i)} {chr(0x6E00 + i)}", f"l{i:03}") for i in range(langid.MOST_LANGUAGES + 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert "sets" in model
    found = langid.predict(model, docs)
    assert found.where(F.col("p.lang") != F.col("lang")).count() == 0 and found.count() == len(rows)


def test_held_out_accuracy(spark):
    from pairflow.llm.queries import op4_language_id

    found = op4_language_id(spark, "/root/testdata/sf0.01")
    rows = found.join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    r = rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.count("*").alias("n")).first()
    assert r["n"] > 100 and r["right"] >= 0.95
