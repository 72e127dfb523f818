"""Checks inside a plan, worker states, one read per side of an outer join, the entry's guard."""

import os
import re
import signal
import subprocess
import sys

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairflow import checked, join, map_workers, multiset_digest, rows_to_df, sum_by_key
from pairflow.catalog import bench_words, doc_word_counts
from pairflow.plans import plan_text

from conftest import SF_SMALL, bag

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_digest_ignores_order_and_layout_but_not_repeats(spark):
    a = rows_to_df(spark, [(1, None, [1, None]), (None, 1, [None, 1]), (1, 1, []), (1, 1, [])], "a int, b int, c array<int>")
    d = lambda df: tuple(multiset_digest(df).first())
    assert d(a) == d(a.orderBy("b").repartition(3)) and d(a)[0] == 4
    others = [
        rows_to_df(spark, rows, "a int, b int, c array<int>")
        for rows in (
            [(None, 1, [1, None]), (None, 1, [None, 1]), (1, 1, []), (1, 1, [])],  # a null moved to its neighbour
            [(1, None, [None, 1]), (None, 1, [None, 1]), (1, 1, []), (1, 1, [])],  # ... within a list
            [(1, None, [1, None]), (1, None, [1, None]), (None, 1, [None, 1]), (1, 1, [])],  # other repeats
        )
    ]
    assert len({d(x) for x in [a, *others]}) == 4
    assert d(a.limit(0)) == (0, "0:0")


def test_checked_fails_the_action_itself(spark):
    a = spark.range(0, 1000, 1, 4).select((F.col("id") % 7).alias("k"), "id")
    assert checked(a.repartition(3), a).count() == 1000
    for wrong in (a.union(a.limit(1)), a.where("id > 0"), a.limit(0)):
        with pytest.raises(Exception, match="datasets differ"):
            checked(wrong, a).write.format("noop").mode("overwrite").save()


def test_worker_state_serves_many_tasks(spark):
    df = spark.range(0, 64_000, 1, 64)
    out, seen = map_workers(df, lambda state, pdf: pd.DataFrame({"n": [len(pdf) + state["zero"]]}), "n bigint", lambda: {"zero": 0})
    assert out.agg(F.sum("n")).first()[0] == 64_000
    assert seen.get["tasks"] == 64 and 1 <= seen.get["setups"] < 64 and seen.get["batches"] >= 64


CLOSES = """
import os, signal, sys
sys.path.insert(0, {root!r})
from pairflow.operators import partitions as p
down = lambda s: os.write(1, f"down {{s}};".encode())
for i in range(p.MOST_STATES + 1):
    assert p._worker_state(f"t{{i}}", lambda: i, down) == (i, True)
assert p._worker_state("t1", lambda: 9, down) == (1, False)
{end}
"""


@pytest.mark.parametrize("end, code", [("os._exit(3)", 3), ("os.kill(os.getpid(), signal.SIGHUP)", -signal.SIGHUP)])
def test_worker_states_are_torn_down_when_the_process_ends(end, code):
    p = subprocess.run([sys.executable, "-c", CLOSES.format(root=ROOT, end=end)], capture_output=True, text=True)
    assert p.returncode == code, p.stderr
    assert sorted(p.stdout.split(";")[:-1]) == [f"down {i}" for i in range(5)] and p.stdout.startswith("down 0;")


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join_reads_and_shuffles_a_derived_side_once(spark, how):
    j = join(doc_word_counts(spark, SF_SMALL), bench_words(spark, SF_SMALL), "word", how)
    j.collect()
    final = plan_text(j).split("Initial Plan")[0]
    scans = [x for x in final.splitlines() if "FileScan" in x and "doc_id" in x]
    assert len(scans) == 1 and "ReusedExchange" in final and "checkpoint" not in final.lower()


@pytest.mark.parametrize("how", ["left", "right", "full"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_outer_join_of_derived_sides_equals_sparks(spark, how, null_safe):
    a = rows_to_df(spark, [("x", 1), ("x", 2), (None, 3), ("y", 4), ("y", 4), ("w", None)], "k string, v int")
    b = rows_to_df(spark, [("x", 5), ("x", 6), (None, 7), ("z", 8), ("w", None)], "k string, u int")
    left, right = a.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")), b.groupBy("k").agg(F.max("u").alias("u"))
    key = a["k"].eqNullSafe(b["k"]) if null_safe else a["k"] == b["k"]
    l2, r2 = left.alias("l"), right.alias("r")
    cond = F.col("l.k").eqNullSafe(F.col("r.k")) if null_safe else F.col("l.k") == F.col("r.k")
    want = l2.join(r2, cond, how).select(F.coalesce("l.k", "r.k").alias("k"), "v", "n", "u")
    assert key is not None and bag(join(left, right, "k", how, null_safe=null_safe)) == bag(want)


def test_both_zeros_are_one_set_element(spark):
    df = rows_to_df(spark, [("a", [0.0, 1.0]), ("a", [-0.0, None, float("nan")]), ("a", [float("nan")])], "k string, v array<double>")
    assert len(sum_by_key(df, "k", "v", semigroup="set").first()["v"]) == 4


@pytest.mark.parametrize("gone", ["ahocorasick", "xxhash", "public_tokenizers"])
def test_a_missing_package_drops_the_subpackage_only(gone):
    code = f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules[{gone!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    from pairflow.catalog import ORACLE, QUERIES

    p = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    found = re.findall(r"\d+", p.stdout)
    assert int(found[0]) >= len(QUERIES) and int(found[1]) >= len(ORACLE), p.stderr
