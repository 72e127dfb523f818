"""Query catalogue: every operator of the inventory as a query over the
driver's tables, and the DuckDB SQL that computes the same answer.

All queries read whole tables and whole texts.  Outer joins need keys that
are missing on either side; the word counts of ``documents`` against the
words of ``benchmark`` have both (words only in documents, words only in
benchmark items, and words in several items - the duplicate right key of
the reference's ``meanings`` input).
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce

import pandas as pd
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairflow.functions import WORD_DELIMITER, format_row, tokens, words
from pairflow.operators import (
    Split,
    aggregate_by_key,
    apply_transform,
    checked,
    cogroup,
    cogroup_apply,
    cogroup_grid,
    cogroup_split,
    cogroup_stream,
    combine_by_key,
    count_by_value,
    filter_rows,
    flat_map,
    flat_map_pandas,
    group_by_key,
    group_stream,
    group_then_fold,
    join,
    key_value,
    map_pandas,
    map_partitions,
    map_rows,
    map_workers,
    multiset_diff,
    multiset_digest,
    observed,
    pair_with,
    reduce_by_key,
    reduce_by_key_pandas,
    sum_by_key,
    table_function,
)
from pairflow.operators.skew import materialize
from pairflow.sources import rows_to_df, spread, table

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- helpers

def documents(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """The text column and ``cols`` of ``documents``, dealt by id.

    A Parquet split is one row group at least, and tokenising a text costs far
    more than moving it, so text queries deal the documents over all tasks first,
    whatever the size and layout of the table."""
    docs = table(spark, d, "documents").select("doc_id", "text", *cols)
    return spread_out(spark, docs, "doc_id")


def spread_out(spark: SparkSession, df: DataFrame, *by: str) -> DataFrame:
    return spread(df, int(spark.conf.get("spark.sql.shuffle.partitions")), *by)


def doc_words(spark: SparkSession, d: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return words(documents(spark, d, *[c for c in keep if c != "doc_id"]), "text", "word", keep)


def doc_word_counts(spark: SparkSession, d: str) -> DataFrame:
    return count_by_value(doc_words(spark, d), ["word"], "n")


def bench_words(spark: SparkSession, d: str) -> DataFrame:
    """(word, item_id): each benchmark item once per word it contains."""
    return words(table(spark, d, "benchmark"), "text", "word", ("item_id",)).distinct()


# A small keyed table, with a repeated key, to join word counts with.
MEANINGS = [("the", "der"), ("the", "die"), ("of", "von"), ("and", "und"), ("de", "of"), ("la", "the"), ("zzz", "nothing")]


def q_join_meanings(spark, d):
    """The reference's last program: word counts joined with an inline keyed table."""
    meanings = rows_to_df(spark, MEANINGS, "word string, meaning string")
    j = join(doc_word_counts(spark, d), meanings, "word")
    return j.select(format_row("word", "n", "meaning").alias("s"))


# ---------------------------------------------------------------- P1 F1-F3

def q_map_filter_flat_map(spark, d):
    """flatMap, filter and map one after another: long words with their initial."""
    toks = flat_map(documents(spark, d), tokens("text"), "word", ("doc_id",))
    long_ = filter_rows(toks, F.length("word") >= 10)
    return count_by_value(map_rows(long_, F.substring("word", 1, 1).alias("initial"), F.length("word").alias("len")), ["initial", "len"], "n")



def q_flat_map_tokens(spark, d):
    """Per-document token statistics.  A document's tokens come from one row,
    so array functions answer it inside one projection: no explode, no shuffle."""
    toks = F.filter(tokens("text"), lambda w: w != "")
    return documents(spark, d).select(
        "doc_id",
        F.coalesce(F.size(toks), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.coalesce(F.size(F.array_distinct(toks)), F.lit(0)).cast("bigint").alias("n_distinct"),
    )


# Opaque Python route of the same flatMap: the tokeniser runs in Python on
# Arrow batches (the delimiter is the same fixed pattern).
_PY_DELIM = regex.compile(WORD_DELIMITER)


def _py_tokens(pdf: pd.DataFrame) -> pd.DataFrame:
    ids, toks = [], []
    for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
        some = False
        for w in _PY_DELIM.split((text or "").lower()):
            if w:
                ids.append(doc_id)
                toks.append(w)
                some = True
        if not some:  # the document has no words: one row without a word
            ids.append(doc_id)
            toks.append(None)
    return pd.DataFrame({"doc_id": ids, "word": toks})


def q_flat_map_pandas_tokens(spark, d):
    """Same statistics through an opaque Python flatMap that emits token rows.

    Python output carries no partitioning, so the per-document aggregate
    needs one exchange on ``doc_id``; a document's distinct words are
    bounded by the document (one row), so a partial ``collect_set`` per
    document is safe and keeps it to that one exchange."""
    docs = documents(spark, d)
    w = flat_map_pandas(docs, _py_tokens, "doc_id bigint, word string")
    return w.groupBy("doc_id").agg(
        F.count("word").alias("n_tokens"), F.size(F.collect_set("word")).cast("bigint").alias("n_distinct")
    )


# ---------------------------------------------------------------- A1 P2 F4

def q_count_by_value_words(spark, d):
    return doc_word_counts(spark, d)


def q_observed_word_count(spark, d):
    """Per-step counts: the word count with two steps observed.  The counts of
    the steps fill in while the result is written; they are columns of it."""
    docs, docs_seen = observed(documents(spark, d), "read", documents=F.count(F.lit(1)))
    w, words_seen = observed(words(docs, "text", "word"), "tokenise", tokens=F.count(F.lit(1)))
    counts = materialize(count_by_value(w, ["word"], "n"))
    return counts.select("word", "n", F.lit(docs_seen.get["documents"]).alias("documents"), F.lit(words_seen.get["tokens"]).alias("tokens"))


def q_format_counts(spark, d):
    return doc_word_counts(spark, d).select(format_row("word", "n").alias("s"))


def q_count_by_value_cols(spark, d):
    return count_by_value(table(spark, d, "customer"), ["c_mktsegment", "c_nationkey"], "n")


# ---------------------------------------------------------------- word count routes

def q_wordcount_group_fold(spark, d):
    pairs = pair_with(doc_words(spark, d), "word", 1, "one")
    return group_then_fold(pairs, "word", "one", None, "sum", "n")


def q_wordcount_reduce(spark, d):
    pairs = pair_with(doc_words(spark, d), "word", 1, "one")
    return reduce_by_key(pairs, "word", "one", "sum", out="n")


def q_wordcount_sum(spark, d):
    pairs = key_value(doc_words(spark, d), "word", F.lit(1).cast("bigint"), "word", "one")
    return sum_by_key(pairs, "word", "one", out="n")


def _tokenise(df: DataFrame) -> DataFrame:
    return words(df, "text", "word")


def _count_words(df: DataFrame) -> DataFrame:
    return count_by_value(df, ["word"], "n")


def q_wordcount_transform_chain(spark, d):
    """applyTransform: the word count as a chain of reusable steps."""
    return apply_transform(apply_transform(documents(spark, d), _tokenise), _count_words)


def _py_lengths(s: pd.Series) -> pd.Series:
    return s.str.len().astype("Int64")


def q_word_lengths_pandas(spark, d):
    """Opaque Python map (pandas UDF on Arrow batches), then count by value."""
    lengths = doc_words(spark, d).select(map_pandas(F.col("word"), _py_lengths, "bigint").alias("len"))
    return count_by_value(lengths, ["len"], "n")


# ---------------------------------------------------------------- A2 A4

def q_group_by_key(spark, d):
    o = table(spark, d, "orders")
    return group_by_key(o, "o_custkey", "o_orderkey", out="orderkeys", sort=True)


def q_reduce_max(spark, d):
    o = table(spark, d, "orders")
    return reduce_by_key(o, "o_custkey", "o_totalprice", "max", out="max_price")


def q_group_by_key_split(spark, d):
    """The chunked layout on words, whose keys are skewed: per word the number
    of chunks' values and that no chunk passes its bound."""
    w = doc_words(spark, d, ("doc_id",)).groupBy("word", "doc_id").count()
    g = group_by_key(w, "word", "doc_id", out="docs", split=Split(by=("doc_id",), max_rows=50, parts=4))
    return g.groupBy("word").agg(F.sum(F.size("docs")).alias("n_docs"), (F.max(F.size("docs")) <= 50).alias("bounded"))


def q_reduce_min_struct(spark, d):
    """The longest word per language, the first of equal ones: a built-in minimum of structs."""
    w = doc_words(spark, d, ("lang",)).select("lang", F.struct((-F.length("word")).alias("l"), "word").alias("v"))
    return reduce_by_key(w, "lang", "v", "min").select("lang", F.col("v.word").alias("longest"))


def q_reduce_expr(spark, d):
    """A reduction without a built-in: the longest common prefix of a customer's order priorities."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority")

    def prefix(a, b):
        n = F.least(F.length(a), F.length(b))
        same = F.filter(F.sequence(F.lit(0), n), lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))
        return F.substring(a, F.lit(1), F.array_max(same))

    return reduce_by_key(o, "o_custkey", "o_orderpriority", prefix, out="prefix")


def _gcd(a, b):
    while b:
        a, b = b, a % b
    return a


def q_reduce_opaque(spark, d):
    """An opaque Python reduction: the greatest common divisor."""
    li = table(spark, d, "lineitem").select("l_suppkey", F.col("l_partkey").cast("bigint").alias("v"))
    return reduce_by_key_pandas(li, "l_suppkey", "v", _gcd)


def _no_cents():
    return {"n": 0, "total": 0, "least": None, "most": None}


def _add_cents(acc, batch):
    cents = batch.column(0)
    both = pc.min_max(cents).as_py()
    return _merge_cents(acc, {"n": len(cents), "total": pc.sum(cents).as_py(), "least": both["min"], "most": both["max"]})


def _merge_cents(a, b):
    ends = [x for x in (a["least"], a["most"], b["least"], b["most"]) if x is not None]
    return {"n": a["n"] + b["n"], "total": a["total"] + b["total"], "least": min(ends), "most": max(ends)}


def cents(spark: SparkSession, d: str) -> DataFrame:
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return table(spark, d, "lineitem").select("l_suppkey", price.alias("cents"))


def q_combine_mean_range(spark, d):
    """combineByKey: the exact mean and the range of each supplier's prices, in
    cents, by a user accumulator (count, total, least, most)."""
    found = combine_by_key(
        cents(spark, d),
        "l_suppkey",
        "cents",
        _no_cents,
        _add_cents,
        _merge_cents,
        lambda a: {"mean": a["total"] / a["n"], "range": a["most"] - a["least"]},
        "struct<n:bigint,total:bigint,least:bigint,most:bigint>",
        "m",
        "struct<mean:double,range:bigint>",
    )
    return found.select("l_suppkey", "m.mean", "m.range")


def q_aggregate_mean_range(spark, d):
    """The same with an accumulator of built-in aggregates."""
    parts = {"n": F.count("cents"), "total": F.sum("cents"), "least": F.min("cents"), "most": F.max("cents")}
    found = aggregate_by_key(
        cents(spark, d),
        "l_suppkey",
        parts,
        lambda a: F.struct((a["total"].cast("double") / a["n"].cast("double")).alias("mean"), (a["most"] - a["least"]).alias("range")),
        "m",
    )
    return found.select("l_suppkey", "m.mean", "m.range")


def _longest_gap(key, batches):
    """Number of documents of a word, and the widest gap between their ids."""
    last, n, gap = None, 0, 0
    for batch in batches:
        ids = batch.column(0).to_numpy()
        steps = ids[1:] - ids[:-1]
        gap = max(gap, int(steps.max()) if len(steps) else 0, 0 if last is None else int(ids[0]) - last)
        last, n = int(ids[-1]), n + len(ids)
    yield (key[0], n, gap)


def q_group_stream_words(spark, d):
    """groupByKey read as a stream: a fold over each word's documents in order."""
    return group_stream(doc_of_words(spark, d), "word", "doc_id", _longest_gap, "word string, n_docs bigint, gap bigint", order=["doc_id"])


# ---------------------------------------------------------------- A5 A7 A8

def q_set_union(spark, d):
    li = table(spark, d, "lineitem")
    s = sum_by_key(li, "l_orderkey", "l_returnflag", out="flags", semigroup="set")
    return s.select("l_orderkey", F.sort_array("flags").alias("flags"))


def q_sum_long(spark, d):
    return sum_by_key(table(spark, d, "lineitem"), "l_returnflag", "l_linenumber", out="sum_linenumber")


def q_sum_decimal(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    )
    return sum_by_key(li, "l_returnflag", "price", out="sum_price")


def q_sum_struct(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_returnflag",
        F.struct(
            F.col("l_linenumber").alias("a"), F.col("l_extendedprice").cast("decimal(18,2)").alias("b")
        ).alias("v"),
    )
    return sum_by_key(li, "l_returnflag", "v", flat=True)


def q_sum_map(spark, d):
    ev = table(spark, d, "events").select("user_id", F.create_map("event_type", F.lit(1).cast("bigint")).alias("m"))
    return sum_by_key(ev, "user_id", "m", flat=True)


def q_sum_map_empty(spark, d):
    """Map sums where some keys have only empty maps; they stay, with size 0."""
    ev = table(spark, d, "events")
    one = F.create_map("event_type", F.lit(1).cast("bigint"))
    m = F.when(F.col("event_type") == "purchase", one).otherwise(F.create_map().cast("map<string,bigint>"))
    s = sum_by_key(ev.select("event_id", m.alias("m")), "event_id", "m")
    return s.select("event_id", F.size("m").alias("n_keys"), F.try_element_at("m", F.lit("purchase")).alias("n"))


def q_sum_list(spark, d):
    ev = table(spark, d, "events").select("user_id", F.array("event_id", "event_id").alias("ids"))
    s = sum_by_key(ev, "user_id", "ids")
    return s.select("user_id", F.sort_array("ids").alias("ids"))


def q_sum_set(spark, d):
    ev = table(spark, d, "events").select("user_id", F.array("event_type").alias("types"))
    s = sum_by_key(ev, "user_id", "types", semigroup="set")
    return s.select("user_id", F.sort_array("types").alias("types"))


def q_sum_max(spark, d):
    li = table(spark, d, "lineitem")
    return sum_by_key(li, "l_linestatus", "l_extendedprice", out="max_price", semigroup="max")


def q_sum_optional(spark, d):
    ev = table(spark, d, "events").select(
        "user_id", F.when(F.col("event_type") == "purchase", F.lit(1).cast("bigint")).alias("purchases")
    )
    return sum_by_key(ev, "user_id", "purchases")


def q_sum_nested_struct(spark, d):
    """A struct of a number, a map of numbers and a set, in one aggregation; flattened."""
    li = table(spark, d, "lineitem").select(
        "l_suppkey",
        F.struct(
            F.col("l_linenumber").alias("lines"),
            F.create_map("l_returnflag", F.struct(F.lit(1).cast("bigint").alias("n"), F.col("l_linenumber").alias("lines"))).alias("flags"),
            F.array("l_linestatus").alias("statuses"),
        ).alias("v"),
    )
    s = sum_by_key(li, "l_suppkey", "v", arrays="set", flat=True)
    one = F.explode("v_flags").alias("flag", "f")
    return s.select("l_suppkey", "v_lines", F.concat_ws(",", F.array_sort("v_statuses")).alias("statuses"), one).select(
        "l_suppkey", "v_lines", "statuses", "flag", F.col("f.n").alias("n"), F.col("f.lines").alias("lines")
    )


def q_sum_nested_map(spark, d):
    """A map of maps of sets: per user, event type and hour the days seen; flattened."""
    hours = F.create_map(F.hour("ts"), F.array(F.dayofmonth("ts")))
    ev = table(spark, d, "events").select("user_id", F.create_map("event_type", hours).alias("m"))
    s = sum_by_key(ev, "user_id", "m", arrays="set", flat=True)
    s = s.select("user_id", F.col("m_key").alias("event_type"), F.explode("m_value").alias("hour", "days"))
    return s.select("user_id", "event_type", "hour", F.array_sort("days").alias("days"))


def q_group_nested_pair(spark, d):
    li = table(spark, d, "lineitem")
    g = group_by_key(li, "l_orderkey", ["l_partkey", "l_suppkey"], out="pairs", sort=True)
    return g.select(
        "l_orderkey",
        F.transform("pairs", lambda p: p["l_partkey"]).alias("partkeys"),
        F.transform("pairs", lambda p: p["l_suppkey"]).alias("suppkeys"),
    )


# ---------------------------------------------------------------- G1-G3 J1-J4 (Q13-Q15)

def q_cogroup_words(spark, d):
    return cogroup(doc_word_counts(spark, d), bench_words(spark, d), "word", "n", "item_id", sort=True)


def doc_of_words(spark: SparkSession, d: str) -> DataFrame:
    """(word, doc_id): each document once per word it contains."""
    return doc_words(spark, d, ("doc_id",)).distinct()


def q_cogroup_split_words(spark, d):
    """A cogroup whose left side is split, as a word's documents may not fit a
    row: pairs of a word's documents and items, each met once."""
    cg = cogroup_split(
        doc_of_words(spark, d), bench_words(spark, d), "word", "doc_id", "item_id", Split(by=("doc_id",), max_rows=50, parts=4)
    )
    met = F.size("vs").cast("bigint") * F.size("ws")
    return cg.groupBy("word").agg(F.sum(F.size("vs")).alias("n_docs"), F.max(F.size("ws")).cast("bigint").alias("n_items"), F.sum(met).alias("pairs"))


def conv_words(spark: SparkSession, d: str) -> DataFrame:
    """(word, conv_id): each conversation once per word it contains."""
    conv = spread_out(spark, table(spark, d, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn")
    return words(conv, "text", "word", ("conv_id",)).distinct()


def q_cogroup_three_words(spark, d):
    """n-way cogroup of documents' word counts, benchmark items and conversations
    per word: all values of each side, put together from chunks of bounded size,
    how many they are, and the tuples of values met."""
    outs = ["vs", "ws", "zs"]
    # Sorted, so that a chunk's list is the same wherever the grid repeats it.
    grid = cogroup_grid(
        [
            (doc_word_counts(spark, d), "n", None),
            (bench_words(spark, d), "item_id", Split(by=("item_id",), max_rows=100, parts=1)),
            (conv_words(spark, d), "conv_id", Split(by=("conv_id",), max_rows=1000, parts=8)),
        ],
        "word",
        outs,
        sort=True,
    )
    met = reduce(operator.mul, [F.size(c).cast("bigint") for c in outs])
    chunks = [F.collect_set(F.struct(f"chunk_{i}", F.col(c).alias("own"))).alias(c) for i, c in enumerate(outs)]
    rows = grid.groupBy("word").agg(*chunks, F.sum(met).alias("tuples"))
    rows = rows.select("word", *[F.sort_array(F.flatten(F.col(c)["own"])).alias(c) for c in outs], "tuples")
    counts = [F.size(c).cast("bigint").alias(name) for c, name in zip(outs, ("n_counts", "n_items", "n_convs"))]
    return rows.select("word", *outs, *counts, "tuples")


def _spread_of(key, vs, ws):
    """A function of both whole lists: total count, and the median item."""
    yield (key[0], int(sum(vs)), sorted(ws)[len(ws) // 2] if ws else None)


def q_cogroup_apply_words(spark, d):
    cg = cogroup(doc_word_counts(spark, d), bench_words(spark, d), "word", "n", "item_id")
    return cogroup_apply(cg, "word", ("vs", "ws"), _spread_of, "word string, n bigint, median_item bigint")


def _stream_of(key, items, counts):
    """The same answer with the counts read as a stream past the held items."""
    total = sum(pc.sum(batch.column(0)).as_py() for batch in counts)
    yield (key[0], total, sorted(items)[len(items) // 2] if items else None)


def q_cogroup_stream_words(spark, d):
    return cogroup_stream(
        bench_words(spark, d), doc_word_counts(spark, d), "word", "item_id", "n", _stream_of, "word string, n bigint, median_item bigint"
    )


def _join(how):
    def q(spark, d):
        return join(doc_word_counts(spark, d), bench_words(spark, d), "word", how)

    return q


def q_format_join(spark, d):
    j = join(doc_word_counts(spark, d), bench_words(spark, d), "word", "inner")
    return j.select(format_row("word", "n", "item_id").alias("s"))


# ---------------------------------------------------------------- K1 U1

def q_multiset_diff(spark, d):
    expected = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"))
    actual = table(spark, d, "events").select(F.col("user_id").alias("custkey"))
    return multiset_diff(expected, actual)


def q_multiset_digest_routes(spark, d):
    """Counts and digests of two routes of the word count, and whether they agree."""
    a = multiset_digest(q_wordcount_reduce(spark, d)).withColumn("route", F.lit("reduce"))
    b = multiset_digest(q_wordcount_sum(spark, d)).withColumn("route", F.lit("sum"))
    both = a.unionByName(b)
    one = both.agg((F.count_distinct("digest") == 1).alias("same"))
    return both.select("route", "n").join(one)


def q_checked_word_count(spark, d):
    """The word count, whose job fails if its rows aren't those of another route."""
    return checked(doc_word_counts(spark, d), q_wordcount_sum(spark, d))


class LongWords:
    """Counts long words by initial and length: rows of ``eval`` are documents of
    one partition, ``terminate`` hands on its counts."""

    def __init__(self):
        self.counts = {}

    def eval(self, row):
        for w in _PY_DELIM.split((row["text"] or "").lower()):
            if len(w) >= 10:
                self.counts[w[0], len(w)] = self.counts.get((w[0], len(w)), 0) + 1

    def terminate(self):
        for (initial, length), n in self.counts.items():
            yield initial, length, n


def q_table_function_words(spark, d):
    """flatMap by a table function: long words per document, then added up."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = table_function(docs, LongWords, "initial string, len int, n bigint", "doc_id")
    return found.groupBy("initial", "len").agg(F.sum("n").alias("n"))


def _tally_rows(state, pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"n_rows": [len(pdf)], "sum_linenumber": [int(pdf["l_linenumber"].sum())]})


def q_worker_stats(spark, d):
    """A state per worker process; the totals don't depend on which tasks share one."""
    li = table(spark, d, "lineitem").select("l_linenumber")
    per_batch, _ = map_workers(li, _tally_rows, "n_rows bigint, sum_linenumber bigint", setup=dict, teardown=dict.clear)
    return per_batch.agg(F.sum("n_rows").alias("n_rows"), F.sum("sum_linenumber").alias("sum_linenumber"))


def _start_bundle(state) -> None:
    state["rows"] = state["sum"] = 0


def _count_bundle(state, pdf: pd.DataFrame) -> None:
    state["rows"] += len(pdf)
    state["sum"] += int(pdf["l_linenumber"].sum())


def _finish_bundle(state) -> pd.DataFrame:
    return pd.DataFrame({"n_rows": [state["rows"]], "sum_linenumber": [state["sum"]]})


def q_partition_stats(spark, d):
    """All hooks: each bundle's totals are set up, counted and handed on by the
    hook that ends it; their sum doesn't depend on the layout."""
    li = table(spark, d, "lineitem").select("l_linenumber")
    per_bundle = map_partitions(
        li,
        _count_bundle,
        "n_rows bigint, sum_linenumber bigint",
        setup=dict,
        start_bundle=_start_bundle,
        finish_bundle=_finish_bundle,
        teardown=dict.clear,
    )
    return per_bundle.agg(F.sum("n_rows").alias("n_rows"), F.sum("sum_linenumber").alias("sum_linenumber"))


QUERIES: dict[str, Query] = {
    "join_meanings": q_join_meanings,
    "map_filter_flat_map": q_map_filter_flat_map,
    "group_by_key_split": q_group_by_key_split,
    "reduce_min_struct": q_reduce_min_struct,
    "sum_map_empty": q_sum_map_empty,
    "cogroup_split_words": q_cogroup_split_words,
    "flat_map_tokens": q_flat_map_tokens,
    "flat_map_pandas_tokens": q_flat_map_pandas_tokens,
    "count_by_value_words": q_count_by_value_words,
    "observed_word_count": q_observed_word_count,
    "format_counts": q_format_counts,
    "count_by_value_cols": q_count_by_value_cols,
    "wordcount_transform_chain": q_wordcount_transform_chain,
    "word_lengths_pandas": q_word_lengths_pandas,
    "wordcount_group_fold": q_wordcount_group_fold,
    "wordcount_reduce": q_wordcount_reduce,
    "wordcount_sum": q_wordcount_sum,
    "group_by_key": q_group_by_key,
    "reduce_max": q_reduce_max,
    "reduce_expr": q_reduce_expr,
    "reduce_opaque": q_reduce_opaque,
    "set_union": q_set_union,
    "sum_long": q_sum_long,
    "sum_decimal": q_sum_decimal,
    "sum_struct": q_sum_struct,
    "sum_map": q_sum_map,
    "sum_list": q_sum_list,
    "sum_set": q_sum_set,
    "sum_max": q_sum_max,
    "sum_optional": q_sum_optional,
    "group_nested_pair": q_group_nested_pair,
    "cogroup_words": q_cogroup_words,
    "cogroup_apply_words": q_cogroup_apply_words,
    "cogroup_three_words": q_cogroup_three_words,
    "join_inner_words": _join("inner"),
    "join_left_words": _join("left"),
    "join_right_words": _join("right"),
    "join_full_words": _join("full"),
    "format_join": q_format_join,
    "multiset_diff": q_multiset_diff,
    "partition_stats": q_partition_stats,
    "combine_mean_range": q_combine_mean_range,
    "aggregate_mean_range": q_aggregate_mean_range,
    "group_stream_words": q_group_stream_words,
    "cogroup_stream_words": q_cogroup_stream_words,
    "multiset_digest_routes": q_multiset_digest_routes,
    "checked_word_count": q_checked_word_count,
    "table_function_words": q_table_function_words,
    "worker_stats": q_worker_stats,
    "sum_nested_struct": q_sum_nested_struct,
    "sum_nested_map": q_sum_nested_map,
}


# ---------------------------------------------------------------- DuckDB oracle

_TOK = "unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+'))"
DOC_WORDS = f"(select * from (select doc_id, lang, {_TOK} as word from documents) where word <> '')"
WORD_COUNTS = f"(select word, count(*)::bigint as n from {DOC_WORDS} group by word)"
BENCH_WORDS = f"(select distinct item_id, word from (select item_id, {_TOK} as word from benchmark) where word <> '')"
CONV_WORDS = f"(select distinct conv_id, word from (select conv_id, {_TOK} as word from conversations) where word <> '')"

ORACLE: dict[str, str] = {
    "flat_map_tokens": f"""
        select d.doc_id, coalesce(t.n_tokens, 0)::bigint as n_tokens, coalesce(t.n_distinct, 0)::bigint as n_distinct
        from documents d left join (
            select doc_id, count(*) as n_tokens, count(distinct word) as n_distinct
            from {DOC_WORDS} group by doc_id) t on d.doc_id = t.doc_id""",
    "count_by_value_words": f"select word, n from {WORD_COUNTS}",
    "format_counts": f"select word || ' ' || cast(n as varchar) as s from {WORD_COUNTS}",
    "word_lengths_pandas": f"select length(word)::bigint as len, count(*)::bigint as n from {DOC_WORDS} group by 1",
    "cogroup_three_words": f"""
        select word,
               coalesce(list(n order by n nulls first) filter (where t = 0), []) as vs,
               coalesce(list(item_id order by item_id nulls first) filter (where t = 1), []) as ws,
               coalesce(list(conv_id order by conv_id nulls first) filter (where t = 2), []) as zs,
               count(*) filter (where t = 0)::bigint as n_counts, count(*) filter (where t = 1)::bigint as n_items,
               count(*) filter (where t = 2)::bigint as n_convs,
               (count(*) filter (where t = 0) * count(*) filter (where t = 1) * count(*) filter (where t = 2))::bigint as tuples
        from (select word, n, null::bigint as item_id, null::bigint as conv_id, 0 as t from {WORD_COUNTS}
              union all select word, null, item_id, null, 1 from {BENCH_WORDS}
              union all select word, null, null, conv_id, 2 from {CONV_WORDS})
        group by word""",
    "combine_mean_range": """
        select l_suppkey, sum(c)::bigint::double / count(*)::double as mean, (max(c) - min(c))::bigint as range
        from (select l_suppkey, round(l_extendedprice * 100)::bigint as c from lineitem) group by l_suppkey""",
    "sum_nested_struct": """
        select f.l_suppkey, t.v_lines, t.statuses, f.flag, f.n, f.lines
        from (select l_suppkey, l_returnflag as flag, count(*)::bigint as n, sum(l_linenumber)::bigint as lines
              from lineitem group by 1, 2) f
        join (select l_suppkey, sum(l_linenumber)::bigint as v_lines, string_agg(distinct l_linestatus, ',' order by l_linestatus) as statuses
              from lineitem group by 1) t on f.l_suppkey = t.l_suppkey""",
    "sum_nested_map": """
        select user_id, event_type, hour(ts)::int as hour, list_sort(list_distinct(list(dayofmonth(ts)::int))) as days
        from events group by 1, 2, 3""",
    "group_stream_words": f"""
        select word, count(*)::bigint as n_docs, coalesce(max(step), 0)::bigint as gap
        from (select word, doc_id - lag(doc_id) over (partition by word order by doc_id) as step
              from (select distinct word, doc_id from {DOC_WORDS})) group by word""",
    "multiset_digest_routes": f"""
        select r as route, (select count(*) from {WORD_COUNTS})::bigint as n, true as same
        from (values ('reduce'), ('sum')) t(r)""",
    "count_by_value_cols": """
        select c_mktsegment, c_nationkey, count(*)::bigint as n from customer group by 1, 2""",
    "group_by_key": """
        select o_custkey, list(o_orderkey order by o_orderkey) as orderkeys
        from orders group by o_custkey""",
    "reduce_max": "select o_custkey, max(o_totalprice) as max_price from orders group by o_custkey",
    "join_meanings": f"""
        select c.word || ' ' || cast(c.n as varchar) || ' ' || m.meaning as s
        from {WORD_COUNTS} c join (values {", ".join(str(m) for m in MEANINGS)}) m(word, meaning) on c.word = m.word""",
    "map_filter_flat_map": f"""
        select word[1:1] as initial, length(word)::int as len, count(*)::bigint as n
        from {DOC_WORDS} where length(word) >= 10 group by 1, 2""",
    "group_by_key_split": f"""
        select word, count(distinct doc_id)::bigint as n_docs, true as bounded from {DOC_WORDS} group by word""",
    "sum_map_empty": """
        select event_id, case when event_type = 'purchase' then 1 else 0 end::int as n_keys,
               case when event_type = 'purchase' then 1 end::bigint as n from events""",
    "cogroup_split_words": f"""
        select coalesce(c.word, b.word) as word, coalesce(c.n, 0)::bigint as n_docs, coalesce(b.n, 0)::bigint as n_items,
               (coalesce(c.n, 0) * coalesce(b.n, 0))::bigint as pairs
        from (select word, count(distinct doc_id) as n from {DOC_WORDS} group by word) c
        full outer join (select word, count(*) as n from {BENCH_WORDS} group by word) b on c.word = b.word""",
    "reduce_min_struct": f"""
        select lang, first(word order by length(word) desc, word) as longest
        from {DOC_WORDS} group by lang""",
    "reduce_expr": """
        select o_custkey, case when min(o_orderpriority) = max(o_orderpriority) then min(o_orderpriority)
               else list_max([min(o_orderpriority)[1:i] for i in range(0, 20)
                              if min(o_orderpriority)[1:i] = max(o_orderpriority)[1:i]]) end as prefix
        from orders group by o_custkey""",
    "reduce_opaque": """
        select l_suppkey, list_reduce(list(l_partkey::bigint), lambda a, b: gcd(a, b)) as v from lineitem group by l_suppkey""",
    "observed_word_count": f"""
        select word, n, (select count(*) from documents)::bigint as documents,
               (select count(*) from {DOC_WORDS})::bigint as tokens from {WORD_COUNTS}""",
    "set_union": """
        select l_orderkey, list_sort(list_distinct(list(l_returnflag))) as flags
        from lineitem group by l_orderkey""",
    "sum_long": """
        select l_returnflag, sum(l_linenumber)::bigint as sum_linenumber from lineitem group by 1""",
    "sum_decimal": """
        select l_returnflag, sum(cast(l_extendedprice as decimal(18,2)))::decimal(28,2) as sum_price
        from lineitem group by 1""",
    "sum_struct": """
        select l_returnflag, sum(l_linenumber)::bigint as v_a,
               sum(cast(l_extendedprice as decimal(18,2)))::decimal(28,2) as v_b
        from lineitem group by 1""",
    "sum_map": """
        select user_id, event_type as m_key, count(*)::bigint as m_value from events group by 1, 2""",
    "sum_list": """
        select user_id, list_sort(flatten(list([event_id, event_id]))) as ids
        from events group by user_id""",
    "sum_set": """
        select user_id, list_sort(list_distinct(list(event_type))) as types from events group by user_id""",
    "sum_max": "select l_linestatus, max(l_extendedprice) as max_price from lineitem group by 1",
    "sum_optional": """
        select user_id, sum(case when event_type = 'purchase' then 1 end)::bigint as purchases
        from events group by user_id""",
    "group_nested_pair": """
        select l_orderkey,
               list(l_partkey order by l_partkey, l_suppkey) as partkeys,
               list(l_suppkey order by l_partkey, l_suppkey) as suppkeys
        from lineitem group by l_orderkey""",
    "cogroup_words": f"""
        select word,
               coalesce(list(n order by n) filter (where t = 0), []) as vs,
               coalesce(list(item_id order by item_id) filter (where t = 1), []) as ws
        from (select word, n, null::bigint as item_id, 0 as t from {WORD_COUNTS}
              union all
              select word, null::bigint, item_id, 1 from {BENCH_WORDS})
        group by word""",
    "cogroup_apply_words": f"""
        select coalesce(c.word, b.word) as word, coalesce(c.n, 0)::bigint as n, b.items[len(b.items) // 2 + 1] as median_item
        from {WORD_COUNTS} c
        full outer join (select word, list(item_id order by item_id) as items from {BENCH_WORDS} group by word) b
          on c.word = b.word""",
    "join_inner_words": f"select c.word, c.n, b.item_id from {WORD_COUNTS} c join {BENCH_WORDS} b on c.word = b.word",
    "join_left_words": f"select c.word, c.n, b.item_id from {WORD_COUNTS} c left join {BENCH_WORDS} b on c.word = b.word",
    "join_right_words": f"select b.word, c.n, b.item_id from {WORD_COUNTS} c right join {BENCH_WORDS} b on c.word = b.word",
    "join_full_words": f"""
        select coalesce(c.word, b.word) as word, c.n, b.item_id
        from {WORD_COUNTS} c full outer join {BENCH_WORDS} b on c.word = b.word""",
    "format_join": f"""
        select c.word || ' ' || cast(c.n as varchar) || ' ' || cast(b.item_id as varchar) as s
        from {WORD_COUNTS} c join {BENCH_WORDS} b on c.word = b.word""",
    "multiset_diff": """
        select custkey, case when d > 0 then 'missing' else 'unexpected' end as side, abs(d)::bigint as n
        from (select custkey, sum(d) as d
              from (select c_custkey as custkey, 1 as d from customer
                    union all select user_id, -1 from events)
              group by custkey)
        where d <> 0""",
    "partition_stats": """
        select count(*)::bigint as n_rows, sum(l_linenumber)::bigint as sum_linenumber from lineitem""",
}
# Same answer, other route: the routes must agree with one oracle.
for _alias, _same in {
    "wordcount_group_fold": "count_by_value_words",
    "wordcount_reduce": "count_by_value_words",
    "wordcount_sum": "count_by_value_words",
    "wordcount_transform_chain": "count_by_value_words",
    "flat_map_pandas_tokens": "flat_map_tokens",
    "aggregate_mean_range": "combine_mean_range",
    "cogroup_stream_words": "cogroup_apply_words",
    "checked_word_count": "count_by_value_words",
    "table_function_words": "map_filter_flat_map",
    "worker_stats": "partition_stats",
}.items():
    ORACLE[_alias] = ORACLE[_same]
