"""Hot keys: split only where the caller says so, exact bounds, nothing lost."""

import pytest
from pyspark.sql import functions as F

from pairflow import (
    Split,
    assert_same_multiset,
    cogroup,
    cogroup_apply,
    cogroup_split,
    group_by_key,
    group_then_fold,
    reduce_by_key,
    rows_to_df,
    sum_by_key,
)
from pairflow.plans import exchanges

from conftest import bag

HOT_ROWS = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    # key "hot" holds half the rows, as repeated and as distinct values
    hot = [("hot", i % 10, i) for i in range(HOT_ROWS)]
    cold = [(f"k{i % 500}", i, i) for i in range(HOT_ROWS)]
    return rows_to_df(spark, hot + cold, "k string, v bigint, id bigint").repartition(6)


def test_unsplit_is_one_row_per_key_at_any_size(skewed):
    g = group_by_key(skewed, "k", "v")
    assert g.columns == ["k", "values"] and g.count() == g.select("k").distinct().count()
    assert len(g.where("k = 'hot'").first()["values"]) == HOT_ROWS


@pytest.mark.parametrize("bound", [1, 7, 1000, 10**6])
def test_split_bounds_are_exact_and_nothing_is_lost(skewed, bound):
    g = group_by_key(skewed, "k", "v", split=Split(by=("id",), max_rows=bound, parts=4))
    assert g.columns == ["k", "chunk", "values"]
    assert g.select(F.max(F.size("values"))).first()[0] <= bound
    assert_same_multiset(skewed.select("k", "v"), g.select("k", F.explode("values").alias("v")))


def test_split_holds_constant_values_within_the_bound(spark):
    df = spark.range(0, 20_000, 1, 2).select(F.lit("a").alias("k"), F.lit(1).alias("v"), "id")
    g = group_by_key(df, "k", "v", split=Split(by=("id",), max_rows=100))
    sizes = [len(r["values"]) for r in g.collect()]
    assert max(sizes) <= 100 and sum(sizes) == 20_000


def test_split_bounds_bytes(spark):
    df = rows_to_df(spark, [("a", "x" * 100, i) for i in range(50)], "k string, v string, id int")
    g = group_by_key(df, "k", "v", split=Split(by=("id",), max_rows=1000, parts=1, size=F.length("v"), max_bytes=1000))
    assert all(sum(map(len, r["values"])) <= 1100 for r in g.collect()) and g.count() == 5


def test_split_is_one_exchange_besides_the_fixture(skewed):
    g = group_by_key(skewed, "k", "v", split=Split(by=("id",), max_rows=10))
    assert len([e for e in exchanges(g) if "_part" in e]) == 1


def test_reduce_and_fold_with_an_expression_equal_the_builtin(skewed):
    want = bag(reduce_by_key(skewed, "k", "v", "sum"))
    for spread in (1, 5):
        assert bag(reduce_by_key(skewed, "k", "v", lambda a, b: a + b, spread=spread)) == want
        assert bag(group_then_fold(skewed, "k", "v", F.lit(0).cast("bigint"), lambda a, x: a + x, "v", spread=spread)) == want
    assert bag(group_then_fold(skewed, "k", "v", None, "sum", "v")) == want


def test_expression_reduce_keeps_decimals(spark):
    df = rows_to_df(spark, [("a", 1), ("a", 2), ("b", 3)], "k string, v int").select("k", F.col("v").cast("decimal(18,2)").alias("v"))
    r = reduce_by_key(df, "k", "v", lambda a, b: a + b)
    assert r.schema["v"].dataType.simpleString() == "decimal(18,2)" and sorted(float(x.v) for x in r.collect()) == [3.0, 3.0]


def test_split_list_sum_keeps_all(skewed):
    arr = skewed.select("k", "id", F.array("v", "v").alias("vs"))
    s = sum_by_key(arr, "k", "vs", split=Split(by=("id", "_p"), max_rows=1000))
    assert s.where("k = 'hot'").count() > 1
    assert s.select(F.sum(F.size("vs"))).first()[0] == 2 * 2 * HOT_ROWS


@pytest.mark.parametrize("bound", [1, 3, 100])
@pytest.mark.parametrize("side", ["left", "right"])
def test_every_pair_of_a_split_cogroup_meets_once(spark, bound, side):
    left = rows_to_df(spark, [("a", i) for i in range(10)] + [("l", 1)], "k string, v int")
    right = rows_to_df(spark, [("a", 100), ("a", 101), ("r", 7), (None, 8)], "k string, w int")
    by = ("v",) if side == "left" else ("w",)
    cg = cogroup_split(left, right, "k", "v", "w", Split(by=by, max_rows=bound), side=side)
    pairs = lambda key, vs, ws: [(key[0], len(vs) * len(ws))]
    with pytest.raises(ValueError):
        cogroup_apply(cg, "k", ("vs", "ws"), pairs, "k string, n int")
    n = cogroup_apply(cg, "k", ("vs", "ws"), pairs, "k string, n int", per_chunk=True)
    got = {r.k: r.n for r in n.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    assert got == {"a": 20, "l": 0, "r": 0, None: 0}


def test_unsplit_cogroup_shows_whole_lists(spark, skewed):
    right = rows_to_df(spark, [("hot", "x"), ("hot", "y"), ("solo", "w")], "k string, w string")
    cg = cogroup(skewed, right, "k", "v", "w")
    hot = cg.where("k = 'hot'").collect()
    assert len(hot) == 1 and len(hot[0].vs) == HOT_ROWS and sorted(hot[0].ws) == ["x", "y"]


def test_reserved_names_are_refused(spark):
    df = rows_to_df(spark, [(1, 2)], "chunk int, v int")
    with pytest.raises(ValueError):
        group_by_key(df, "chunk", "v", split=Split(by=("v",), max_rows=1))
    with pytest.raises(ValueError):
        group_by_key(df.withColumnRenamed("chunk", "_v"), "_v", "v")
