"""Joins (J1-J4): inner, left, right and full equi-joins on key columns.

Output: ``keys..., left values..., right values...``; duplicate keys
multiply (per-key product), unmatched rows vanish (inner) or get nulls on
the missing side.  Strategy is Spark's: broadcast hash join when the
planner or AQE measures a side under the broadcast threshold, otherwise
sort-merge with AQE splitting skewed partitions.

AQE splits both sides of an inner join, only the left side of a left or
left-anti join, only the right side of a right join, and neither side of a
full join.  So an outer join is the inner join plus the rows without a match,
found by a left-anti join against the other side's keys, one row per key and
task before they are shuffled: a hot key on either side is split.  Where the
caller declares with ``unique`` that the other side's keys are unique, it can
have no hot key, and the plain join is used.

Both parts work on the same shuffled rows.  Left alone, Catalyst would push
the anti join below a side's aggregation, or drop the value columns of the
lookup, and then compute that side once more per part.  A condition that holds
for every row but names a value column of each side keeps the parts' inputs
alike, so Spark reuses their exchanges: a side that comes out of a shuffle is
read and shuffled once.  A side that is a mere scan has its keys alone read
again for the lookup.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from pairflow.operators.skew import as_list

HOW = {"inner": "inner", "left": "left", "right": "right", "full": "full", "outer": "full"}


def _check(left: DataFrame, right: DataFrame, keys: list[str]) -> None:
    for side, df in (("left", left), ("right", right)):
        for k in keys:
            if isinstance(df.schema[k].dataType, MapType):
                raise TypeError(f"join: map column {k!r} on the {side} side cannot be a join key; use cogroup")
    if "_any" in [c.lower() for c in (*left.columns, *right.columns)]:
        raise ValueError("join: the column name '_any' is reserved")
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"join: non-key columns on both sides: {sorted(clash)}; rename one side")


# Nodes of a logical plan below which rows are shuffled.
SHUFFLES = re.compile(r"\b(Aggregate|Join|Window|RepartitionByExpression|Repartition|Sort|Intersect|Except)\b")
LEAST = -(1 << 63)


def _shuffled(df: DataFrame) -> bool:
    return bool(SHUFFLES.search(df._jdf.queryExecution().optimizedPlan().toString()))


def _some(vals: list[str]) -> Column:
    """A number made of the value columns (maps can't be hashed, so their entries)."""
    return F.xxhash64(*vals) if vals else F.lit(0).cast("bigint")


def _names(df: DataFrame, vals: list[str]) -> list:
    return [F.map_entries(c) if isinstance(df.schema[c].dataType, MapType) else F.col(c) for c in vals]


def join(left: DataFrame, right: DataFrame, keys, how: str = "inner", null_safe: bool = False, unique: str | None = None) -> DataFrame:
    """Equi-join on ``keys``; ``null_safe`` lets null keys match each other.
    ``unique`` ("left", "right" or "both"): sides on which no key repeats."""
    keys = as_list(keys)
    if how not in HOW:
        raise ValueError(f"join: unknown kind {how!r}")
    if unique not in (None, "left", "right", "both"):
        raise ValueError(f"join: unknown side {unique!r}")
    how = HOW[how]
    _check(left, right, keys)
    lvals = [c for c in left.columns if c not in keys]
    rvals = [c for c in right.columns if c not in keys]
    l = left.select(*[F.col(k).alias(f"_l_{k}") for k in keys], *lvals)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *rvals)
    pairs = [(F.col(f"_l_{k}"), F.col(f"_r_{k}")) for k in keys]
    cond = reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])

    def out(df: DataFrame, key_side: str) -> DataFrame:
        return df.select(*[F.col(f"_{key_side}_{k}").alias(k) for k in keys], *lvals, *rvals)

    def alone(side: str) -> DataFrame:
        own, other, vals, lost, kept = (l, r, lvals, rvals, right) if side == "l" else (r, l, rvals, lvals, left)
        gone = [f"_{'r' if side == 'l' else 'l'}_{k}" for k in keys]
        if not lost or not _shuffled(other):
            rest = own.join(other.select(*gone).distinct(), cond, "left_anti")
        else:
            held = other.groupBy(*gone).agg(F.bit_xor(_some(_names(other, lost))).alias("_any"))
            always = (_some(_names(own, vals)) >= LEAST) | (F.col("_any") >= LEAST)
            rest = own.join(held, cond & always, "left_anti")
        return out(rest.select("*", *[F.lit(None).cast(kept.schema[c].dataType).alias(c) for c in lost]), side)

    if how == "left" and unique in ("right", "both"):
        return out(l.join(r, cond, "left"), "l")
    if how == "right" and unique in ("left", "both"):
        return out(l.join(r, cond, "right"), "r")
    matched = out(l.join(r, cond, "inner"), "l")
    if how in ("left", "full"):
        matched = matched.unionByName(alone("l"))
    if how in ("right", "full"):
        matched = matched.unionByName(alone("r"))
    return matched
