"""How many rows tasks hold at once where a row is large: see ``base.batches_of``."""

import pytest

from pairflow.llm import search, simhash
from pairflow.llm.base import BATCH_SIZES, batches_of
from pairflow.sources import rows_to_df


def _docs(spark, n):
    rows = [(i, f"w{i % 7} w{i % 5} common words of text {i}") for i in range(n)]
    return rows_to_df(spark, rows, "doc_id long, text string").coalesce(1)


def _sizes(spark):
    return [spark.conf.get(k) for k in BATCH_SIZES]


def test_batch_sizes_hold_inside_only(spark):
    before = _sizes(spark)
    with pytest.raises(ValueError), batches_of(spark, 3):
        assert _sizes(spark) == ["3", "3"]
        raise ValueError
    assert _sizes(spark) == before


def test_fingerprints_take_few_texts_at_once(spark, monkeypatch):
    docs = _docs(spark, 40)
    want = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    strings = simhash.strings

    def few(series):
        assert len(series) <= 8
        return strings(series)

    monkeypatch.setattr(simhash, "TEXTS", 8, raising=False)
    monkeypatch.setattr(simhash, "strings", few)
    assert {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()} == want


def test_shards_meet_queries_one_row_at_once(spark, monkeypatch):
    docs, before, seen, saved = _docs(spark, 40), _sizes(spark), [], search.saved

    def spied(df, **options):
        if "ask" in df.columns and "score" in df.columns:
            seen.append(_sizes(spark))
        return saved(df, **options)

    monkeypatch.setattr(search, "saved", spied)
    hits = search.search(docs, docs.where("doc_id % 10 = 0"), k=3).collect()
    assert seen == [["1", "1"]] and _sizes(spark) == before
    assert sorted((h.query, h.rank) for h in hits) == [(q, r) for q in (0, 10, 20, 30) for r in (1, 2, 3)]
    assert all(h.id == h.query for h in hits if h["rank"] == 1)


def test_words_of_queries_are_worked_out_once(spark, monkeypatch):
    docs = rows_to_df(spark, [(1, "b a b A"), (2, None), (None, "c"), (1, "a"), (3, " ")], "doc_id long, text string")
    monkeypatch.setattr(search, "WORDS", 2, raising=False)
    words = search.query_words(docs, "doc_id", "text").distinct()
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") == 1
    assert {(r["query"], bytes(r.term)) for r in words.collect()} == {(1, b"a"), (1, b"b"), (None, b"c")}
