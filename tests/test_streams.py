"""Accumulators, bounded reductions and groups read as streams."""

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from pairflow import (
    Split,
    cogroup,
    cogroup_grid,
    cogroup_stream,
    combine_by_key,
    group_stream,
    reduce_by_key,
    rows_to_df,
    table_function,
)
from pairflow.operators import grouping
from pairflow.plans import exchanges, plan_text

from conftest import bag


def total_and_count(df, keys, **options):
    def add(acc, batch):
        return merge(acc, (pc.sum(batch.column(0)).as_py() or 0, batch.num_rows))

    def merge(a, b):
        a, b = (tuple(x.values()) if isinstance(x, dict) else x for x in (a, b))
        return (a[0] + b[0], a[1] + b[1])

    def extract(acc):
        acc = tuple(acc.values()) if isinstance(acc, dict) else acc
        return f"{acc[0]}/{acc[1]}"

    return combine_by_key(df, keys, "v", lambda: (0, 0), add, merge, extract, "struct<s:bigint,n:bigint>", "r", "string", **options)


@pytest.mark.parametrize("flush", [1, 100_000])
def test_combine_by_key_equals_the_aggregate(spark, flush):
    df = spark.range(0, 20_000, 1, 5).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 5 != 0, F.col("id")).alias("v"),
    )
    want = df.groupBy("k").agg(F.concat_ws("/", F.coalesce(F.sum("v"), F.lit(0)), F.count(F.lit(1))).alias("r"))
    assert bag(total_and_count(df, "k", flush_keys=flush)) == bag(want)


def test_combine_by_key_groups_keys_as_spark_does(spark):
    rows = [(0.0, (1, "a"), 1), (-0.0, (1, "a"), 2), (float("nan"), (2, None), 3), (float("nan"), (2, None), 4), (None, None, 5)]
    df = rows_to_df(spark, rows, "k double, s struct<a:int,b:string>, v bigint").repartition(3)
    assert sorted(r.r for r in total_and_count(df, "k").collect()) == ["3/2", "5/1", "7/2"]
    assert sorted(r.r for r in total_and_count(df, ["k", "s"]).collect()) == ["3/2", "5/1", "7/2"]
    assert total_and_count(df.where("v > 9"), "k").count() == 0


def test_combine_by_key_folds_before_its_one_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = total_and_count(df, "k")
    lines = [x for x in plan_text(plan).splitlines() if "MapInArrow" in x or "Exchange" in x]
    assert ["merged" in lines[0], "Exchange" in lines[1], "partial" in lines[2], len(lines)] == [True, True, True, 3]


def test_expression_reduce_never_holds_a_list_over_the_bound(spark, monkeypatch):
    whole = grouping._reduce_list

    def guarded(xs, f, kind):
        return F.when(F.size(xs) <= 64, whole(xs, f, kind)).otherwise(F.raise_error(F.lit("list over the bound")).cast(kind))

    monkeypatch.setattr(grouping, "_reduce_list", guarded)
    hot = F.when(F.col("id") % 11 != 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 999))
    df = spark.range(0, 1_100_000, 1, 8).select(hot.alias("k"), F.col("id").alias("v"))
    assert df.where("k = 'hot'").count() == 1_000_000
    r = reduce_by_key(df, "k", "v", lambda a, b: F.greatest(a, b), fan_in=64)
    text = plan_text(r)
    assert len(exchanges(r)) == 1 and text.rindex("Exchange") < text.index("MapInArrow")  # the tree starts below it
    assert bag(r) == bag(df.groupBy("k").agg(F.max("v")))
    with pytest.raises(Exception, match="over the bound"):
        reduce_by_key(df, "k", "v", lambda a, b: F.greatest(a, b), fan_in=65).collect()


def test_expression_reduce_keeps_null_keys_and_values(spark):
    df = rows_to_df(spark, [(None, 1), (None, 5), ("a", None), ("b", 2)], "k string, v int")
    r = reduce_by_key(df, "k", "v", lambda a, b: F.greatest(a, b))
    assert bag(r) == bag(rows_to_df(spark, [(None, 5), ("a", None), ("b", 2)], "k string, v int"))


def hot_rows(spark):
    k = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 99))
    return spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") > 10, k).alias("k"), (40_000 - F.col("id")).alias("v"))


def test_group_stream_reads_bounded_batches_in_order(spark):
    def seen(key, batches):
        last, n, most = -1, 0, 0
        for batch in batches:
            vs = batch.column(0).to_pylist()
            assert vs == sorted(vs) and vs[0] > last
            last, n, most = vs[-1], n + len(vs), max(most, len(vs))
        yield key[0], n, most

    df = hot_rows(spark)
    g = group_stream(df, "k", "v", seen, "k string, n bigint, most int", order=["v"], batch_rows=700)
    assert len(exchanges(g)) == 1 and plan_text(g).count("Sort [") == 1
    assert max(r.most for r in g.collect()) == 700
    assert bag(g.select("k", "n")) == bag(df.groupBy("k").count())


def test_group_stream_may_stop_early_or_give_nothing(spark):
    df = hot_rows(spark)
    first = group_stream(df, "k", "v", lambda key, b: [(key[0], next(b).column(0)[0].as_py())], "k string, v bigint", order=["v"], batch_rows=10)
    assert bag(first) == bag(df.groupBy("k").agg(F.min("v")))
    assert group_stream(df, "k", "v", lambda key, b: [], "k string").count() == 0
    assert group_stream(df.where("v < 0"), "k", "v", lambda key, b: [key], "k string").count() == 0


def test_cogroup_stream_equals_the_cogroup(spark):
    left = hot_rows(spark)
    right = rows_to_df(spark, [("hot", 3), ("hot", 1), ("k7", 2), ("solo", 9), (None, 4)], "k string, w int")

    def fn(key, held, batches):
        sizes = [b.num_rows for b in batches]
        assert all(n <= 500 for n in sizes)
        yield key[0], sorted(held), sum(sizes)

    got = cogroup_stream(right, left, "k", "w", "v", fn, "k string, ws array<int>, n bigint", batch_rows=500)
    want = cogroup(left, right, "k", "v", "w", sort=True).select("k", "ws", F.size("vs").cast("bigint").alias("n"))
    assert len(exchanges(got)) == 1
    assert bag(got) == bag(want)


def test_cogroup_stream_of_several_values_and_empty_sides(spark):
    a = rows_to_df(spark, [("x", 1, "p")], "k string, v int, s string")
    b = rows_to_df(spark, [("x", 2.0)], "k string, w double")
    fn = lambda key, held, batches: [(key[0], str(held), sum(b.num_rows for b in batches))]
    schema = "k string, held string, n int"
    assert bag(cogroup_stream(a, b, "k", ["v", "s"], "w", fn, schema)) == [("x", "[(1, 'p')]", 1)]
    assert bag(cogroup_stream(a, b.where("w > 9"), "k", "v", "w", fn, schema)) == [("x", "[1]", 0)]
    assert bag(cogroup_stream(a.where("v > 9"), b, "k", "v", "w", fn, schema)) == [("x", "[]", 1)]


@pytest.mark.parametrize("bound", [1, 3, 100])
def test_every_tuple_of_a_grid_meets_once(spark, bound):
    a = rows_to_df(spark, [("a", i) for i in range(7)] + [("l", 1), (None, 1)], "k string, v int")
    b = rows_to_df(spark, [("a", i) for i in range(5)] + [("r", 1), (None, 2)], "k string, w int")
    c = rows_to_df(spark, [("a", i) for i in range(4)] + [("z", 1), (None, 3), ("r", 5)], "k string, z int")
    splits = [Split(by=(x,), max_rows=bound, parts=2) for x in "vwz"]
    grid = cogroup_grid([(a, "v", splits[0]), (b, "w", splits[1]), (c, "z", None)], "k", ["vs", "ws", "zs"]).cache()
    assert grid.agg(F.max(F.greatest(F.size("vs"), F.size("ws")))).first()[0] <= bound
    tuples = grid.select("k", F.explode("vs").alias("v"), "ws", "zs").select("k", "v", F.explode("ws").alias("w"), "zs").select("k", "v", "w", F.explode("zs").alias("z"))
    want = [("a", v, w, z) for v in range(7) for w in range(5) for z in range(4)] + [(None, 1, 2, 3)]
    assert bag(tuples) == sorted(want, key=repr)
    assert {r.k for r in grid.select("k").collect()} == {"a", "l", "r", "z", None}
    assert all(r.vs == [] and r.chunk_0 is None for r in grid.where("k in ('r', 'z')").collect())


def test_table_function_keeps_state_per_partition(spark):
    class Pairs:
        def __init__(self):
            self.last = None

        def eval(self, row):
            if self.last is not None:
                yield row["k"], self.last, row["v"]
            self.last = row["v"]

        def terminate(self):
            yield None, self.last, None

    df = rows_to_df(spark, [("a", 3), ("a", 1), ("b", 2), (None, 4), (None, 5)], "k string, v int").repartition(3)
    got = table_function(df, Pairs, "k string, a int, b int", "k", order="v")
    assert bag(got) == sorted([("a", 1, 3), (None, 4, 5), (None, 3, None), (None, 2, None), (None, 5, None)], key=repr)
