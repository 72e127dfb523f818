"""Every dealt operator on awkward rows, and against brute force on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairflow.llm import bpe, iblt, langid, licenses, mixing, packing, postings, search, simhash, toxicity, wordpiece
from pairflow.llm.base import fold
from pairflow.llm.graph import components
from pairflow.llm.queries import RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp int, term string, row int, _id int, shard int"
LONG = "The quick brown fox jumps over the lazy dog. " * 3000
TEXTS = [
    (1, "the cat sat on the mat", "en"), (2, "the cat sat on the mat", "en"), (3, "the cat sat on the mat!", "en"),
    (4, None, None), (5, "", "en"), (6, " \n\t ", None), (7, LONG, "en"), (8, "1234 5678", None), (None, "le chat est sur la table", "fr"),
    (10, "le chien est dans la maison\nReleased under the MIT License.", "fr"), (11, "x" * 700, "de"), (12, "der hund ist im haus, nicht wahr?", "de"),
    (13, "You 1d10t, you are stup1d\nand wоrthless", "en"), (14, "put it in the trash can", "en"), (14, "put it in the trash can", "en"),
    (15, "Licensed under the Apache License, Version 2.0 (CC BY)", "en"), (16, "é中\U0001f600  a b", None),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", None if t is None else len(t), 1, "t", 2, 3, 4) for i, t, g in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS).repartition(3).cache()


@pytest.fixture(scope="module")
def marks(spark):
    rows = [(13, 1), (14, 0), (1, 0), (None, 1), (99, 1), (7, None)]
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def words(t):
    return (t or "").encode().lower().split()


OPERATORS = {
    "search": lambda d, m: search.search(d, d),
    "counts": lambda d, m: wordpiece.token_counts(d, RANKS),
    "packing": lambda d, m: packing.pack(d),
    "langid": lambda d, m: langid.predict(langid.train(d), d).select("doc_id", "p"),
    "simhash": lambda d, m: simhash.near_duplicates(d),
    "mixing": lambda d, m: mixing.score(d, F.col("doc_id") != 3, "lang"),
    "bpe": lambda d, m: d.select(bpe.decode(bpe.encode(F.col("text"), RANKS, P.PATTERN), RANKS).alias("raw")),
    "bpe round trip": lambda d, m: d.select(bpe.round_trip(F.col("text"), RANKS, P.PATTERN).alias("t")).select("t.*"),
    "iblt": lambda d, m: iblt.fingerprints(d),
    "licenses": lambda d, m: licenses.scan(d),
    "toxicity": lambda d, m: d.select("doc_id", toxicity.score(toxicity.train(d, m), d.sparkSession, F.col("text")).alias("f")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table_gives_empty_result(spark, marks, name):
    assert OPERATORS[name](frame(spark, []), marks).collect() == []


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"search", "packing"}))
def test_one_row_for_each_input_row(docs, marks, name):
    assert len(OPERATORS[name](docs, marks).collect()) == len(TEXTS)


def test_search_equals_brute_force(docs):
    tf = [(i, Counter(words(t)), len(words(t)) + 1) for i, t, _ in TEXTS]
    df, n = Counter(w for _, c, _ in tf for w in c), len(tf)
    mean = max(1.0, sum(m - 1 for _, _, m in tf) / n)
    got: dict = {}
    for r in search.search(docs, docs.where("doc_id is not null").dropDuplicates(["doc_id"]), k=4).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r["id"], round(r["score"], 6)))
    for q, c, _ in tf:
        if q is None or not c:
            assert q not in got or q is None
            continue
        ask = sorted(sorted(c, key=lambda w: (df[w] < 2, df[w], w))[: search.TERMS])
        part = lambda w, d, m: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * d[w] * 2.2 / (d[w] + 1.2 * (0.25 + 0.75 * m / mean))
        all_ = [(-sum(part(w, d, m) for w in ask if w in d), i is None, i) for i, d, m in tf if any(w in d for w in ask)]
        assert got[q] == [(i, pytest.approx(-s, abs=2e-6)) for s, _, i in sorted(all_, key=lambda x: (round(x[0], 9), x[1], x[2] or 0))[:4]]


def test_wand_equals_a_full_scan():
    import random

    rng = random.Random(5)
    for _ in range(60):
        lists = []
        for _ in range(rng.randrange(1, 5)):
            d = sorted(rng.sample(range(2000), rng.randrange(1, 900)))
            lists.append((rng.random() * 5, d, [rng.randrange(1, 9) for _ in d], [rng.randrange(2, 60) for _ in d]))
        full: Counter = Counter()
        for x in lists:
            one = search.List(*x, 20.0)
            for doc, s in zip(one.docs.tolist(), one.parts.tolist()):
                full[doc] += s
        want = sorted(full.values(), reverse=True)[:10]
        got = search.top([search.List(*x, 20.0) for x in lists], 10)
        assert [s for s, _ in got][:10] == pytest.approx(want) and all(full[d] == pytest.approx(s) for s, d in got)


def test_token_counts_are_greedy_longest_match():
    first, rest = [b" a", b" ab", b" abcd", b" "], [b"a", b"b", b"c", b"d", b"bc", b"cdd"]
    auto = wordpiece.Automaton(first, rest)

    def slow(w):
        n, pool = 0, first
        while w:
            fits = [p for p in pool if w.startswith(p)]
            if not fits:
                return -1
            w, n, pool = w[len(max(fits, key=len)) :], n + 1, rest
        return n

    import itertools

    for size in range(6):
        for w in itertools.product("abcde", repeat=size):
            word = (" " + "".join(w)).encode()
            assert auto.count(word) == slow(word), word


def test_packing_loses_no_token_and_overfills_no_bin(docs):
    rows = packing.pack(docs, lengths=(8, 16, 64)).collect()
    bins: dict = {}
    for r in rows:
        bins.setdefault((r.bin_id, r.bin_length), []).append((r.bin_offset, r.n_tokens))
    for (_, size), parts in bins.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size and not any(s >= at for s in (8, 16, 64) if s < size)
    assert sum(r.n_tokens for r in rows) == sum(len(words(t)) + 1 for _, t, _ in TEXTS)


def test_packing_opens_what_costs_least(spark):
    import random

    longest = lambda p, sizes: packing.fitted(p, sorted(sizes), False)[1]
    for seed in range(30):
        rng = random.Random(seed)
        sizes = tuple(rng.sample(range(4, 300), 3))
        pieces = [rng.randint(1, max(sizes)) for _ in range(rng.randrange(1, 200))]
        where, final = packing.best_fit(pieces, sizes)
        held = Counter()
        for n, (b, offset) in sorted(zip(pieces, where), key=lambda x: x[1]):
            assert held[b] == offset
            held[b] += n
        assert all(final[b] == min(c for c in sizes if c >= n) for b, n in held.items())
        assert sum(map(packing.price, final)) <= sum(map(packing.price, longest(pieces, sizes)))
    # The longest holds three pieces and a rest, the shorter two without one.
    pieces = [3] * 600
    assert packing.best_fit(pieces, (6, 10))[1] == [6] * 300 and sum(longest(pieces, (6, 10))) > 6 * 300
    mixed = [70] * 40 + [48] * 40
    assert set(packing.best_fit(mixed, (96, 160))[1]) == {96, 160} and sum(packing.best_fit(mixed, (96, 160))[1]) <= sum(longest(mixed, (96, 160)))
    d = spark.createDataFrame([(i, "a b") for i in range(600)], "doc_id long, text string").coalesce(1)
    assert {r.bin_length for r in packing.pack(d, lengths=(6, 10)).collect()} == {6}


def test_language_id(docs, spark):
    rows = frame(spark, [x for x in TEXTS if x[1] != LONG])  # one long text would outweigh its language
    found = langid.predict(langid.train(rows), docs)
    got = {(r.doc_id, r.text): (r.p["lang"], r.p["score"]) for r in found.collect()}
    for i, t, lang in TEXTS:
        if not t or not any(c.isalpha() for c in t):
            assert got[i, t] == ("und", 0.0)
        elif lang and t != LONG:
            assert got[i, t][0] == lang and 0 <= got[i, t][1] <= 1
    assert langid.train(rows.where("lang is null"))["names"] == []


def test_simhash_links_equal_brute_force(spark):
    centre = 0x123456789ABCDEF0
    prints = {centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 7) for b in range(0, 64, 9)} | {centre ^ 0xFF << s for s in range(0, 50, 3)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    got = {r.node: r.component for r in components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()}
    parent = {x: x for x in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in signed:
        for b in signed:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert all(got.get(x, x) == root(x) for x in signed)


def test_one_of_each_keeps_one_and_all_columns(docs):
    kept = simhash.one_of_each(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(14) == 1 and 1 in ids and 2 not in ids and ids.count(None) == 1 and len({4, 5, 6} & set(ids)) == 1


def test_scores_have_the_exact_base(docs):
    train = [t for i, t, _ in TEXTS if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for t in train for w in [*words(t), b""])
    n, v = sum(count.values()), len(count)
    rows = mixing.score(docs.where("doc_id is not null"), fold("doc_id", 5) != 1, "lang").collect()
    want = Counter((i, len(words(t)) + 1, sum(1 for w in [*words(t), b""] if count[w])) for i, t, _ in TEXTS if i is not None)
    assert Counter((r.doc_id, r.n_tokens, r.n_known) for r in rows) == want
    text = {i: t for i, t, _ in TEXTS}
    for r in rows:
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*words(text[r.doc_id]), b""])
        assert r.train_tokens == n and r.base_score == pytest.approx(base, abs=1e-6) and r.score < 0


def test_bits_are_a_probability():
    import numpy as np

    table = np.zeros((mixing.ORDERS, mixing.SLOTS, 2), np.uint32)
    known = [b"ab", b"abc", b"b", b""] * 3
    mixing.count_bits(known, table)
    model = mixing.model_of(table, *mixing.fit(table, known))
    one = [bytes([a]) for a in range(256) if a != 32] + [b""]
    mass = sum(10 ** mixing.log10_bytes(model, one))
    assert 0 < mass <= 1 and mixing.log10_bytes(model, [b"ab"])[0] > mixing.log10_bytes(model, [b"zq"])[0]


def test_bpe_equals_the_library(docs):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = docs.select("text", bpe.encode(F.col("text"), RANKS, P.PATTERN).alias("ids"))
    both = docs.select(bpe.round_trip(F.col("text"), RANKS, P.PATTERN).alias("t")).select("t.ids", "t.decoded")
    assert sorted(map(tuple, both.collect())) == sorted((r["ids"], r["raw"]) for r in rows.select("ids", bpe.decode(F.col("ids"), RANKS).alias("raw")).collect())
    for r in rows.select("text", "ids", bpe.decode(F.col("ids"), RANKS).alias("raw")).collect():
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in lib.encode_ordinary(r.text or ""))
        assert bytes(r.raw) == (r.text or "").encode()


def test_fingerprints_equal_brute_force(spark):
    rows = [(i, t, None) for i, t in ((1, "a\nb\nc\nd"), (2, "a\nb\nx\ny"), (5, ""), (7, LONG), (9, "z" * 500 + "\nq"), (12, None), (30, "a\nb\nc\nd"))]
    got = {r.doc_id: r for r in iblt.fingerprints(frame(spark, rows).repartition(4)).collect()}
    order = sorted(rows, reverse=True)
    pieces = lambda t: set(re.findall(r"[^\n]{1,128}", t))
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (i, t, _) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(alike(pieces(t), pieces(edited))) and r.near_next == pytest.approx(alike(pieces(t), pieces(nxt)))
    assert got[1].fingerprint == got[30].fingerprint != got[2].fingerprint


def test_sketches_retry_until_they_peel(spark):
    pairs = spark.range(3).select(
        F.col("id").alias("pair"),
        F.transform(F.sequence(F.lit(0), F.lit(200)), lambda x: F.xxhash64(x)).alias("a"),
        F.transform(F.sequence(F.lit(100), F.lit(300)), lambda x: F.xxhash64(x)).alias("b"),
        F.lit(1).alias("expect"),
    )
    sides = pairs.select("pair", F.array_except("a", "b").alias("a"), F.array_except("b", "a").alias("b")).collect()
    want = {r.pair: sorted([(x, 1) for x in r.a] + [(x, -1) for x in r.b]) for r in sides}
    got = {r.pair: sorted(map(tuple, r.differ)) for r in iblt.differences(pairs).collect()}
    assert got == want and all(len(x) == 200 for x in got.values())


def test_license_scan(docs):
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[10].base_labels, got[10].labels, got[10].n_base, got[10].first_word) == ("mit", "mit", 1, 9)
    assert got[15].base_labels == "apache,cc-by" and got[15].n_base == 2 and got[15].last_word == 8
    assert (got[4].n_words, got[4].labels, got[4].score, got[4].first_word) == (0, "", 0.0, None)
    assert got[1].labels == "" and got[1].score < licenses.THRESHOLD


def test_toxicity_folds_and_excuses(docs, marks, spark):
    model = toxicity.train(docs, marks)
    f = toxicity.score(model, spark, F.col("text"))
    got = {r.doc_id: r for r in docs.select("doc_id", f.alias("f")).select("doc_id", "f", toxicity.probability(model, F.col("f")).alias("p")).collect()}
    assert got[13].f["n_matches"] == 3 and got[13].p >= 0.5
    assert got[14].f["n_matches"] == 0 and all(0 <= r.p < 0.5 for i, r in got.items() if i != 13)


def test_pipeline_drops_what_it_should_and_keeps_the_rest(spark, docs, marks, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    marks.write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {1, 7, 10, 12, 14, 15, None} <= got and not {2, 4, 5, 6, 8, 13} & got


def test_packed_postings_round_trip():
    rng = np.random.default_rng(3)
    offsets = np.r_[0, np.cumsum(rng.integers(1, 9, 40))]
    records = np.frombuffer(rng.bytes(10 * int(offsets[-1])), postings.RECORD)
    assert (postings.unpack(postings.pack(records, offsets).tobytes(), offsets) == records).all()


def test_search_asks_with_every_word_of_the_query(spark):
    rare = [f"rare{i}" for i in range(12)]
    rows = [(1, " ".join(rare + [f"plain{i}" for i in range(40)])), (2, " ".join(f"plain{i}" for i in range(40)))]
    rows += [(10 + i, f"{w} other") for i, w in enumerate(rare)] + [(100 + i, f"plain{i % 40} common") for i in range(80)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [r.id for r in search.search(d, d.where("doc_id = 1"), k=100).orderBy("rank").collect()]
    assert got[:2] == [1, 2] and set(got) == {i for i, _ in rows}  # 8 rare words would find 9 documents, not the second
    assert len(search.search(d, d.where("doc_id = 1"), k=100, terms=8).collect()) == 9


def test_whole_queries_skip_no_document(monkeypatch):
    rng = np.random.default_rng(7)
    n = 2000
    lists = [np.sort(rng.choice(n, rng.integers(1, m), replace=False)) for m in (5, 40, 200, 900, 1500, 1990) * 5]
    held = np.array([len(x) for x in lists])
    docs, tfs, lens = np.concatenate(lists).astype(np.uint16), rng.integers(1, 9, held.sum()).astype(np.uint32), rng.integers(20, 90, n)
    terms, ids = pa.array([b"%02d" % i for i in range(30)]), pa.array([None, *range(n - 1, 0, -1)], pa.int64())
    weights = np.array([5.0, 4.0, 3.0, 1.0, 0.3, 0.05] * 5)
    for block in (8, 256):
        monkeypatch.setattr(search, "RANGE", block)
        shard = search.Shard(terms, held, docs, tfs, lens, ids, 50.0)
        own = shard.weigh(terms, weights)
        full = np.bincount(docs, search.impacts(1.0, tfs.astype(float), lens[docs], 50.0) * np.repeat(weights, held), n)
        want = np.lexsort((shard.ranks, -full))[:10]
        assert shard.ranks[0] == n - 1  # the null id comes last
        for least in (0.0, full[want[4]]):
            for common in (1, 2, 1000):
                monkeypatch.setattr(search, "COMMON", common)
                shard.weigh(terms, weights)
                found, scores = shard.best(own, 10, least)
                assert found.tolist() == [d for d in want if full[d] >= least] and (scores == full[found]).all()
        shard.asked = shard.read = 0
        found, scores = shard.best(own, 10, full.max() * 10)
        assert len(found) == 0 and shard.read < shard.asked
        found, scores = shard.short(own[:4], 10)
        part = np.bincount(docs[: held[:4].sum()], (shard.plain * np.repeat(weights, held))[: held[:4].sum()], n)
        assert found.tolist() == np.lexsort((shard.ranks, -part))[:10].tolist() and (scores == part[found]).all()


def test_license_blocks_cross_line_breaks(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"
    gpl = "you can redistribute it and/or modify\nit under the terms of the GNU General\nPublic License"
    rest = "Redistributions of source code must retain the above copyright\n * notice, this list of conditions and the following disclaimer."
    texts = [bsd, f"{'word ' * 45}\n{bsd}\n{'word ' * 90}", gpl, rest, "source\nand binary\nforms"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.labels for r in licenses.scan(d).orderBy("doc_id").collect()] == ["bsd", "bsd", "gpl", "bsd", ""]
    assert all(len(t.split()) <= licenses.BLOCK // 2 for _, t in licenses.TEMPLATES)


def scanned(text):
    """(labels, score) of one text, by looking at every block."""
    found = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    line, labels, score = f" {' '.join(found)} ", set(), 0.0
    for phrase, label in licenses.PHRASES:
        if f" {phrase} " in line:
            labels.add(label)
            score = 1.0
    blocks = [set(found[i : i + licenses.BLOCK]) for i in range(max(1, len(found) - licenses.BLOCK + 1))]
    for label, template in licenses.TEMPLATES:
        own = set(template.split())
        share = max(len(b & own) / len(own) for b in blocks) if len(own) >= licenses.LEAST else float(f" {template} " in line)
        if share >= licenses.THRESHOLD:
            labels.add(label)
            score = max(score, share)
    return ",".join(sorted(labels)), score


def test_license_blocks_equal_all_stretches(spark):
    import random

    rng = random.Random(11)
    texts = [None, "", "a buy cc of goods by the door and nc state", "public opinion: lesser gnu general store", "CC BY-NC 4.0"]
    for k in range(160):
        label, template = rng.choice(licenses.TEMPLATES)
        kept = [w for w in template.split() if rng.random() > 0.12 * (k % 3)]
        if k % 4 == 0:
            rng.shuffle(kept)
        out = ["foreign"] * rng.randrange(0, 90)
        for w in kept:
            out += [w] + [rng.choice(["and", "the", "other", "x9"])] * rng.choice([0, 0, 1, 3, 5])
        out += rng.choice([[], ["tail"] * 70, rng.choice(licenses.TEMPLATES)[1].split()])
        texts.append(rng.choice([" ", "\n", ", "]).join(out))
    texts.append(" ".join(t for _, t in licenses.TEMPLATES) + " word" * 500)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(d).collect()}
    for i, t in enumerate(texts):
        labels, score = scanned(t)
        assert got[i] == (labels, pytest.approx(score)), t
    assert [got[i][0] for i in range(5)] == ["", "", "", "", "cc-by,cc-by-nc"]
    assert len({x[0] for x in got.values()}) > 10


def test_lexicon_has_no_cap_and_no_idle_terms(spark):
    import random

    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = {"".join(rng.choice(letters) for _ in range(rng.randrange(3, 12))) + " " * rng.randrange(2): rng.uniform(2, 8) for _ in range(30_000)}
    for t in rng.sample(sorted(many), 3000):  # longer ones of the same stem
        many[t.rstrip() + rng.choice(letters) + " "] = rng.uniform(2, 8)
    many = {t: w for t, w in many.items() if t.endswith(" ") or len(t) in toxicity.STEMS}
    got = {r.term for r in toxicity.lexicon(spark.createDataFrame(sorted(many.items()), "term string, w double")).collect()}
    idle = {t for t, w in many.items() if any(k < len(t) and t[:k] == t.rstrip()[:k] and len(t.rstrip()) >= k and many.get(t[:k], -9) >= w - 1 for k in toxicity.STEMS)}
    assert got == many.keys() - idle and idle and len(got) > 20_000


def test_a_learned_lexicon_of_more_than_20000_terms_loses_none(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEMS", range(4, 4))
    monkeypatch.setattr(toxicity, "LEAST_RATIO", 0.0)
    word = lambda i: "z" + "".join(chr(97 + i // 26**k % 26) for k in range(4)) + "q" * 40
    bad = [(" ".join(word(i) for i in range(s, s + 2100)), 1) for s in range(0, 21_000, 2100) for _ in range(30)]
    good = [("fine words only", 0)] * 20_000
    rows = spark.createDataFrame(bad + good, "text string, toxic int")
    terms = toxicity._learn(rows)
    assert {t for t, _ in terms} == {" ".join(toxicity.folded_words(word(i))) + " " for i in range(21_000)}


def test_fingerprints_peel_without_the_texts(spark):
    rows = [(0, "a\nb\nc\nd", "a\nb\nc\ne"), (1, "a\nb", "a\nb"), (2, "", "x\ny"), (3, "same\n" + "\n".join(map(str, range(500))), "\n".join(map(str, range(501)))), (4, "", "\n".join(map(str, range(90))))]
    d = spark.createDataFrame(rows, "pair long, s string, t string").select("pair", iblt.digests(F.col("s")).alias("x"), iblt.digests(F.col("t")).alias("y"))
    found = iblt.printed_differences(d.select("pair", iblt.printed(F.col("x")).alias("a"), iblt.printed(F.col("y")).alias("b")))
    got = {r.pair: (sorted(map(tuple, r.differ)), r.n_left) for r in found.collect()}
    for r in d.collect():
        want = sorted([(x, 1) for x in set(r.x) - set(r.y)] + [(x, -1) for x in set(r.y) - set(r.x)])
        assert got[r.pair] == (want, 0) if r.pair < 4 else got[r.pair][1] > 0


@pytest.mark.parametrize("kind", ["string", "timestamp", "date", "double", "decimal(20,3)"])
def test_next_documents_of_any_id_type(spark, kind):
    n = {"string": "concat('k\"', id, '\\\\')", "timestamp": "timestamp_micros(id * 1000001)", "date": "date_add(date'2020-01-01', int(id))"}.get(kind, f"cast(id / 7 as {kind})")
    d = spark.range(60).selectExpr(f"{n} as _id", "concat('text ', id) as _text").unionByName(spark.range(40).selectExpr(f"cast(null as {kind}) as _id", "concat('hot ', id) as _text"))
    rows = iblt.with_next(d.repartition(5), ["_text"]).collect()
    key = {r._text: (r._id is not None, r._id if r._id is not None else 0) for r in rows}
    assert len(rows) == 100 and len({r.row for r in rows}) == 100
    after, at, walk = {r._text: r.next__text for r in rows}, rows[0]._text, []
    for _ in rows:
        walk.append(at)
        at = after[at]
    assert at == walk[0] and set(walk) == set(after)  # one ring of all rows
    assert sum(key[a] < key[after[a]] for a in walk) == 1  # that rises once, from the last to the first


def test_many_ranges_are_planned_as_one_literal(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 500)
    try:
        d = spark.range(3000).selectExpr("id as _id", "concat('text ', id) as _text")
        rows = iblt.with_next(d, ["_text"])
        assert {(r._id, r.next__text) for r in rows.select("_id", "next__text").collect()} == {(i, f"text {(i - 1) % 3000}") for i in range(3000)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_near_duplicates_equal_brute_force(spark):
    import random

    import xxhash

    rng = random.Random(9)
    base = [" ".join(rng.choice(["red", "blue", "green", "one", "two"]) + str(rng.randrange(400)) for _ in range(300)) for _ in range(6)]
    rows = [(i, rng.choice(base)) for i in range(40)] + [(100 + i, base[i % 6].upper() + " tail" * (i % 3)) for i in range(20)]
    rows += [(None, base[0]), (None, None), (7, base[1]), (300, ""), (301, "a b"), (302, "A b"), (303, "a b c")]
    schema = "doc_id long, text string, _print int, _kept string, several int, _id long"
    d = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], schema).repartition(3)

    def print_of(t):
        w = words(t)
        grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = [print_of(t) for _, t in rows]
    of = list(range(len(rows)))
    for _ in rows:
        of = [min(of[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 2) for i in range(len(rows))]
    group = lambda i: [rows[j][0] for j in range(len(rows)) if of[j] == of[i] and rows[j][0] is not None]
    want = Counter((rows[i][0], f"{prints[i]:016x}", min(group(i), default=None)) for i in range(len(rows)))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(d).collect()) == want
    kept = simhash.one_of_each(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({w[2] for w in want})


def test_pipeline_on_empty_tables_and_clashing_columns(spark, docs, marks, tmp_path):
    for name, d, m in (("none", docs.limit(0), marks.limit(0)), ("no labels", docs, marks.limit(0)), ("full", docs, marks)):
        folder = str(tmp_path / name)
        extra = ["_lang", "_toxic", "_print", "_kept", "_k_id", "several", "grp", "lang_pred", "bin_id", "w"]
        d.select("*", *[F.lit(7).alias(c) for c in extra]).write.parquet(f"{folder}/documents.parquet")
        m.write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder)
        assert {"doc_id", "bin_id", "bin_length", "bin_offset"} <= set(got.columns)
        ids = {r.doc_id for r in got.collect()}
        assert ids == set() if name == "none" else {1, 7, 10} <= ids and not {2, 4, 5, 6} & ids
        columns = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = stage(spark, columns, folder)
            assert set(columns.columns) == {*docs.columns, *extra}
