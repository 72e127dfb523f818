"""Property checks on random small bags against plain Python."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairflow import Split, count_by_value, group_by_key, multiset_diff, reduce_by_key, rows_to_df, sum_by_key

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.sampled_from(["a", "b", "c", None])
pairs = st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(-50, 50))), min_size=0, max_size=60)


@SETTINGS
@given(rows=pairs)
def test_count_by_value_is_a_counter(spark, rows):
    df = rows_to_df(spark, rows, "k string, v int")
    got = {(r.k, r.v): r.n for r in count_by_value(df).collect()}
    assert got == dict(Counter(rows))


@SETTINGS
@given(rows=pairs, max_rows=st.integers(1, 8))
def test_group_by_key_chunks_partition_the_values(spark, rows, max_rows):
    df = rows_to_df(spark, rows, "k string, v int")
    expected = defaultdict(Counter)
    for k, v in rows:
        expected[k][v] += 1
    got = defaultdict(Counter)
    for r in group_by_key(df, "k", "v", split=Split(by=("v",), max_rows=max_rows, parts=2)).collect():
        got[r.k].update(r["values"])
    assert got == expected


@SETTINGS
@given(rows=pairs)
def test_sum_by_key_skips_nulls(spark, rows):
    df = rows_to_df(spark, rows, "k string, v int")
    expected: dict = {}
    for k, v in rows:
        if v is not None:
            expected[k] = (expected.get(k) or 0) + v
        else:
            expected.setdefault(k, None)
    assert {r.k: r.v for r in sum_by_key(df, "k", "v").collect()} == expected


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=pairs, max_rows=st.integers(1, 5))
def test_expression_reduce_equals_builtin(spark, rows, max_rows):
    df = rows_to_df(spark, [(k, v) for k, v in rows if v is not None], "k string, v int")
    a = {r.k: r.v for r in reduce_by_key(df, "k", "v", lambda x, y: F.greatest(x, y), spread=max_rows).collect()}
    b = {r.k: r.v for r in reduce_by_key(df, "k", "v", "max").collect()}
    assert a == b


@SETTINGS
@given(a=st.lists(st.integers(0, 5), max_size=30), b=st.lists(st.integers(0, 5), max_size=30))
def test_multiset_diff_is_counter_difference(spark, a, b):
    da = rows_to_df(spark, [(x,) for x in a], "x int")
    db = rows_to_df(spark, [(x,) for x in b], "x int")
    got = {(r.x, r.side): r.n for r in multiset_diff(da, db).collect()}
    ca, cb = Counter(a), Counter(b)
    expected = {(x, "missing"): n for x, n in (ca - cb).items()}
    expected.update({(x, "unexpected"): n for x, n in (cb - ca).items()})
    assert got == expected
