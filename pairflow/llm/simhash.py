"""SimHash near-duplicates with pigeonring filtering.

A fingerprint's 64 bits stand as four segments on a ring.  If two fingerprints
differ in at most 2 bits, some segment starts a chain whose first segment
differs in 0 bits, whose first two differ in at most 1 and whose first three in
at most 1 (the budgets in proportion, rounded down).  So the start is equal and
one of the next two is equal: the chain's keys are (segment i, segment i+1) and
(segment i, segment i+2).  A fingerprint none of whose keys occurs in another
fingerprint has no partner and is pruned.  The keys are counted, never paired,
so a hot segment costs one counter.

The full Hamming check of the survivors needs no pairs either: two
fingerprints differ in at most 2 bits exactly if they meet in a value that is
at most one flipped bit away from each.  A value has at most 65 such
fingerprints, so its list is bounded; each links to the smallest of them, which
is again checked bit by bit.  Equal fingerprints are one node from the start.

Defined results: a text without words, or null, has fingerprint zero and links
like any other; a very long text is counted in slices of its shingles; ties
cannot matter, as a component is named by its smallest id; null ids take part in links but never name a component unless
it has no other id (then it is null); repeated rows each get their row; an
empty table gives an empty result.
"""

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairflow.llm.base import batches_of, fresh, saved, strings
from pairflow.llm.graph import components

SEED = 42
SLICE = 65_536  # shingles whose bits are counted at once
TEXTS = 1024  # texts that a task hands to Python at once


def simhash(text: str, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = text.encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return 0
    if n < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), n - shingle + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, SLICE):
        bits = np.unpackbits(h[a : a + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long (the same 64 bits)."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            h = np.array([simhash(t, shingle) for t in strings(series)], np.uint64)
            yield pd.Series(h.view(np.int64))

    return run(text)


def segment(c: str, i: int) -> Column:
    return F.shiftrightunsigned(F.col(c), 16 * (i % 4)).bitwiseAND(F.lit(0xFFFF))


def links(prints: DataFrame) -> DataFrame:
    """``prints``: distinct (fp).  Returns edges (u, v) that join all
    fingerprints at 2 or fewer bits, directly or through others so linked."""
    # Chains (0,1) (1,2) (2,3) (3,0) and (0,2) (1,3): each pair of segments once.
    chains = sorted({tuple(sorted((i, (i + d) % 4))) for i in range(4) for d in (1, 2)})
    keys = F.array(*[F.struct(F.lit(n).alias("p"), F.shiftleft(segment("fp", a), 16).bitwiseOR(segment("fp", b)).alias("k")) for n, (a, b) in enumerate(chains)])
    keyed = prints.select("fp", F.explode(keys).alias("c")).select("fp", "c.p", "c.k")
    shared = saved(keyed.groupBy("p", "k").agg(F.count("*").alias("n")).where("n > 1").select("p", "k"))
    alive = saved(keyed.join(shared, ["p", "k"], "left_semi").select("fp").distinct())
    flips = F.array(F.lit(0), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)])
    met = alive.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))
    met = met.groupBy("at").agg(F.collect_list("fp").alias("near")).where(F.size("near") > 1)
    edges = met.select(F.array_min("near").alias("v"), F.explode("near").alias("u")).where("u <> v").distinct()
    return edges.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row per input row: id, fp (long), fingerprint (16 hex digits), grp
    (a fingerprint that names the component), component_id (the smallest id
    reachable)."""
    with batches_of(docs.sparkSession, TEXTS):
        rows = saved(docs.select(F.col(id_col).alias("_id"), fingerprint(F.col(text_col), shingle).alias("fp")))
    prints = saved(rows.groupBy("fp").agg(F.min("_id").alias("first")))
    group = components(links(prints.select("fp")))
    named = prints.join(group, prints["fp"] == group["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("grp")
    )
    least = named.groupBy("grp").agg(F.min("first").alias("component_id"))
    named = saved(named.join(least, "grp").select("fp", "grp", "component_id"))
    return rows.join(named, "fp").select(
        F.col("_id").alias(id_col), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "grp", "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null
    ids last, then of the smallest fingerprint; of repeated rows, any one.  Rows
    are found again by their id; fingerprints are only computed a second time
    for rows that share their id with others."""
    found = near_duplicates(docs, id_col, text_col, shingle).select(F.col(id_col).alias("_id"), "fp", "grp")
    best = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "fp")).alias("b")
    keep = found.groupBy("grp").agg(best).select("b._id", "b.fp")
    times = found.groupBy("_id").agg(F.count("*").alias("n")).withColumnRenamed("_id", "_same")
    name, mine = fresh(docs, "_kept"), fresh(docs, "_print")
    keep = keep.join(times, F.col("_id").eqNullSafe(F.col("_same")))
    keep = saved(keep.select(F.col("_id").alias(name), F.col("fp").alias(mine), (F.col("n") > 1).alias("several")))
    # One plan at every size: a broadcast would end where the kept ids outgrow it.
    alone, several = keep.where("not several").hint("merge"), keep.where("several").hint("merge")
    once = docs.join(alone, docs[id_col].eqNullSafe(alone[name]), "left_semi")
    if several.isEmpty():
        return once
    shared = docs.join(several, docs[id_col].eqNullSafe(several[name]), "left_semi").withColumn(mine, fingerprint(F.col(text_col), shingle))
    shared = shared.join(several, shared[id_col].eqNullSafe(several[name]) & (shared[mine] == several[mine]), "left_semi")
    return once.unionByName(shared.dropDuplicates([id_col, mine]).drop(mine))
