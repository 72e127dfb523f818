import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairflow import map_partitions, multiset_diff, observed, rows_to_df, words
from pairflow.operators import assert_same_multiset
from pairflow.operators.checks import MultisetMismatch

from conftest import bag


def test_multiset_diff_counts_repeats(spark):
    a = rows_to_df(spark, [(1,), (1,), (2,)], "x int")
    b = rows_to_df(spark, [(1,), (3,)], "x int")
    assert bag(multiset_diff(a, b)) == [(1, "missing", 1), (2, "missing", 1), (3, "unexpected", 1)]
    # EXCEPT-style set difference would miss the wrong repeat count
    assert multiset_diff(a, a).count() == 0


def test_assert_same_multiset_raises(spark):
    a = rows_to_df(spark, [(1,), (1,)], "x int")
    b = rows_to_df(spark, [(1,)], "x int")
    with pytest.raises(MultisetMismatch):
        assert_same_multiset(a, b)
    assert_same_multiset(b, b)


def test_map_partitions_hooks(spark):
    log_dir = tempfile.mkdtemp(prefix="pairflow-hooks-")
    df = spark.range(0, 30_000, numPartitions=3).select(F.col("id").alias("x"))

    def setup():
        return {"bundles": 0, "rows": 0, "path": os.path.join(log_dir, f"{os.getpid()}-{id(object())}")}

    def start(state):
        state["bundles"] += 1

    def process(state, pdf):
        state["rows"] += len(pdf)
        return pd.DataFrame({"n": [len(pdf)], "kind": ["rows"]})

    def finish(state):
        return pd.DataFrame({"n": [1], "kind": ["bundle"]})

    def teardown(state):
        with open(state["path"], "w") as f:
            f.write(f"{state['bundles']} {state['rows']}")

    out = map_partitions(df, process, "n bigint, kind string", setup, start, finish, teardown)
    totals = {r.kind: r.n for r in out.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    assert totals["rows"] == 30_000
    assert totals["bundle"] >= 3
    logs = [open(os.path.join(log_dir, f)).read().split() for f in os.listdir(log_dir)]
    assert sum(int(r) for _, r in logs) == 30_000


def test_map_partitions_teardown_runs_on_error(spark):
    log_dir = tempfile.mkdtemp(prefix="pairflow-hooks-")
    df = spark.range(0, 10, numPartitions=1)

    def process(state, pdf):
        raise RuntimeError("boom")

    def teardown(state):
        open(os.path.join(log_dir, "down"), "w").close()

    with pytest.raises(Exception):
        map_partitions(df, process, "id bigint", setup=dict, teardown=teardown).collect()
    assert os.path.exists(os.path.join(log_dir, "down"))


def test_observed_counts_a_step(lines):
    w, obs = observed(words(lines, "line"), "tokens", rows=F.count(F.lit(1)))
    w.groupBy("word").count().collect()
    assert obs.get["rows"] == 26  # sum of the golden word counts
