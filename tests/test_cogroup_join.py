"""cogroup and the join family against brute force on small inputs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from pairflow import cogroup, cogroup_apply, join, rows_to_df
from pairflow.operators import cogroup_many

from conftest import bag


@pytest.fixture(scope="module")
def sides(spark):
    left = rows_to_df(spark, [("a", 1), ("a", 2), ("b", 3), (None, 9), ("a", None)], "k string, v int")
    right = rows_to_df(spark, [("a", "x"), ("c", "y"), (None, "n")], "k string, w string")
    return left, right


def test_cogroup_full_outer_with_empty_lists(sides):
    left, right = sides
    got = {}
    for r in cogroup(left, right, "k", "v", "w").collect():
        got[r.k] = (sorted(r.vs, key=lambda x: (x is None, x)), sorted(r.ws))
    assert got == {
        "a": ([1, 2, None], ["x"]),
        "b": ([3], []),
        "c": ([], ["y"]),
        None: ([9], ["n"]),
    }


def test_cogroup_three_inputs(spark, sides):
    left, right = sides
    third = rows_to_df(spark, [("b", 1.5)], "k string, z double")
    r = {x.k: x for x in cogroup_many([(left, "v"), (right, "w"), (third, "z")], "k", ["vs", "ws", "zs"]).collect()}
    assert r["b"].zs == [1.5] and r["c"].zs == [] and r["c"].ws == ["y"]


def test_cogroup_empty_side(spark, sides):
    left, _ = sides
    empty = rows_to_df(spark, [], "k string, w bigint")
    rows = cogroup(left, empty, "k", "v", "w").collect()
    assert len(rows) == 3 and all(r.ws == [] for r in rows)


def test_cogroup_apply_chunkwise(sides):
    left, right = sides
    cg = cogroup(left, right, "k", "v", "w")
    out = cogroup_apply(cg, "k", ("vs", "ws"), lambda k, vs, ws: [(k[0], len(vs), len(ws))], "k string, nv bigint, nw bigint")
    assert bag(out) == sorted([("a", 3, 1), ("b", 1, 0), ("c", 0, 1), (None, 1, 1)], key=repr)


def brute(left_rows, right_rows, how, null_safe=False):
    def eq(a, b):
        return a == b if (a is not None and b is not None) else (null_safe and a is None and b is None)

    out = []
    matched_r = set()
    for lk, lv in left_rows:
        hits = [(j, rv) for j, (rk, rv) in enumerate(right_rows) if eq(lk, rk)]
        for j, rv in hits:
            out.append((lk, lv, rv))
            matched_r.add(j)
        if not hits and how in ("left", "full"):
            out.append((lk, lv, None))
    if how in ("right", "full"):
        for j, (rk, rv) in enumerate(right_rows):
            if j not in matched_r:
                out.append((rk, None, rv))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_join_kinds_match_brute_force(spark, how, null_safe):
    rng = random.Random(7)
    keys = ["a", "b", "c", "d", None]
    lrows = [(rng.choice(keys), i) for i in range(40)]
    rrows = [(rng.choice(keys[1:] + ["e"]), f"r{i}") for i in range(25)]
    left = rows_to_df(spark, lrows, "k string, v int")
    right = rows_to_df(spark, rrows, "k string, w string")
    got = bag(join(left, right, "k", how, null_safe=null_safe))
    assert got == brute(lrows, rrows, how, null_safe)


def test_full_join_equals_native(spark):
    rng = random.Random(3)
    lrows = [(rng.randrange(30), i) for i in range(300)]
    rrows = [(rng.randrange(20, 50), i) for i in range(200)]
    left = rows_to_df(spark, lrows, "k int, v int")
    right = rows_to_df(spark, rrows, "k int, w int")
    native = left.join(right, "k", "full").select("k", "v", "w")
    assert bag(join(left, right, "k", "full")) == bag(native)


def test_join_refuses_map_keys(spark):
    df = rows_to_df(spark, [({"a": 1}, 1)], "m map<string,int>, v int")
    other = rows_to_df(spark, [({"a": 1}, 2)], "m map<string,int>, w int")
    with pytest.raises(TypeError):
        join(df, other, "m")


def test_join_refuses_clashing_columns(spark):
    a = rows_to_df(spark, [(1, 1)], "k int, v int")
    with pytest.raises(ValueError):
        join(a, a, "k")


def test_duplicate_right_keys_multiply(spark):
    a = rows_to_df(spark, [("hast", 6)], "word string, n bigint")
    b = rows_to_df(spark, [("hast", "hate"), ("hast", "have")], "word string, meaning string")
    assert len(list(itertools.chain(join(a, b, "word").collect()))) == 2
    assert join(a, b, "word").where(F.col("n") == 6).count() == 2
