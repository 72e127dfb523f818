"""The plan shapes the operators promise."""

import pytest
from pyspark.sql import functions as F

from pairflow import count_by_value, group_by_key, join, reduce_by_key, sum_by_key, table, words
from pairflow.plans import exchanges, gathers_lists, has_partial_aggregate, pushed_filters, read_schemas

from conftest import SF_SMALL


def test_count_by_value_partial_then_one_exchange(spark):
    w = words(table(spark, SF_SMALL, "documents"), "text")
    df = count_by_value(w, ["word"])
    assert has_partial_aggregate(df)
    assert len(exchanges(df)) == 1


def test_sum_and_builtin_reduce_are_partial(spark):
    li = table(spark, SF_SMALL, "lineitem")
    for df in (sum_by_key(li, "l_returnflag", "l_linenumber"), reduce_by_key(li, "l_suppkey", "l_quantity", "max")):
        assert has_partial_aggregate(df) and not gathers_lists(df)
        assert len(exchanges(df)) == 1


def test_group_by_key_without_hot_keys_is_one_exchange(spark):
    o = table(spark, SF_SMALL, "orders")
    df = group_by_key(o, "o_custkey", "o_orderkey")
    assert len(exchanges(df)) == 1
    assert "BroadcastHashJoin" not in "\n".join(exchanges(df))


def test_join_does_not_gather_lists(spark):
    c = table(spark, SF_SMALL, "customer").select("c_custkey", "c_name")
    o = table(spark, SF_SMALL, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    assert not gathers_lists(join(c, o, "c_custkey", "inner"))


def test_filter_and_columns_reach_the_scan(spark):
    li = table(spark, SF_SMALL, "lineitem").where(F.col("l_quantity") > 10)
    df = sum_by_key(li, "l_returnflag", "l_linenumber")
    assert any("l_quantity" in p for p in pushed_filters(df))
    schema = read_schemas(df)[0]
    assert "l_extendedprice" not in schema and "l_linenumber" in schema


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _final_plan_has_skew_split(df):
    df.collect()  # runs this DataFrame's own query, so explain shows AQE's final plan
    from pairflow.plans import plan_text

    return "skew=true" in plan_text(df)


@pytest.mark.parametrize("hot_side", ["left", "right"])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_joins_split_a_hot_key_on_either_side(spark, how, hot_side):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
        big = spark.range(0, 300_000).select(hot.alias("k"), F.col("id").alias("v"))
        small = spark.range(0, 2_000).select((F.col("id") % 1200).alias("k"), F.col("id").alias("w"))
        a, b = (big, small) if hot_side == "left" else (small, big)
        assert _final_plan_has_skew_split(join(a, b, "k", how))
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_spread_is_explicit(spark):
    import pairflow.sources as src

    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    assert exchanges(docs) == []
    assert any("REPARTITION_BY_NUM" in e for e in exchanges(src.spread(docs, 8, "doc_id")))
