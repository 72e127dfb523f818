"""Keyed grouping and reduction (A2-A4, A6-A8, P6).

``group_by_key`` keeps every value and gives one row per key, or chunks of
exact size for every key if the caller asks for a ``Split`` (see ``skew``).
Whenever the question is a reduction, ``reduce_by_key`` or ``sum_by_key``
answers it with partial aggregation instead.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType
from pyspark.sql.window import Window

from pairflow.operators.batches import hashable, runs, windows
from pairflow.operators.skew import Split, as_list, refuse, with_chunks

# Reducers with a built-in aggregate: partial aggregation, codegen, no lists.
BUILTIN_REDUCERS = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "bit_or": F.bit_or,
    "bit_and": F.bit_and,
    "bit_xor": F.bit_xor,
    "bool_and": F.bool_and,
    "bool_or": F.bool_or,
}


def _bare(df: DataFrame, values: list[str]) -> bool:
    """One value column that cannot hold nulls needs no struct wrapper."""
    return len(values) == 1 and not df.schema[values[0]].nullable


def _gather(df: DataFrame, keys: list[str], values: list[str], extra: list[str] | None = None) -> DataFrame:
    """(keys, extra, _vs).  A nullable value is wrapped in a struct so its nulls
    survive collect_list (which skips null elements)."""
    refuse(df, keys, "_v", "_vs")
    wrapped = F.col(values[0]) if _bare(df, values) else F.struct(*values)
    by = keys + (extra or [])
    return df.select(*by, wrapped.alias("_v")).groupBy(*by).agg(F.collect_list("_v").alias("_vs"))


def _unwrap(values: list[str], bare: bool = False) -> Column:
    if bare:
        return F.col("_vs")
    if len(values) == 1:
        return F.transform(F.col("_vs"), lambda x: x[values[0]])
    return F.col("_vs")


def group_by_key(df: DataFrame, keys, values, out: str = "values", sort: bool = False, split: Split | None = None) -> DataFrame:
    """groupByKey: ``keys..., out``, one row per key with every value of it.

    One value column gives ``array<value>``, several give
    ``array<struct<...>>``.  Null keys form one group and null values are
    kept.  ``sort`` orders each list.  With ``split`` the result is
    ``keys..., chunk, out``: chunks of bounded size for every key.
    """
    keys, values = as_list(keys), as_list(values)
    extra = [] if split is None else ["_part", "chunk"]
    rows = df if split is None else with_chunks(df, keys, split)
    vals = _unwrap(values, _bare(df, values))
    grouped = _gather(rows, keys, values, extra)
    return grouped.select(*keys, *extra[1:], (F.sort_array(vals) if sort else vals).alias(out))


# Values that a list of an expression reduction holds at most.
FAN_IN = 2048


def _runs(df: DataFrame, keys: list[str], value: str, fan_in: int) -> DataFrame:
    """(keys, _xs): the values that a window of a task's rows has for a key, in
    lists of at most ``fan_in``; made inside the task, without an exchange."""
    nk = len(keys)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for window in windows(batches):
            order, starts = runs([window.column(i) for i in range(nk)])
            ends = np.r_[starts[1:], len(order)]
            cuts = -(-(ends - starts) // fan_in)
            within = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            lists = np.repeat(starts, cuts) + fan_in * within
            firsts = pa.array(order[lists])
            offsets = pa.array(np.r_[lists, len(order)].astype(np.int32))
            xs = pa.ListArray.from_arrays(offsets, window.column(nk).take(pa.array(order)))
            cols = [window.column(i).take(firsts) for i in range(nk)]
            yield pa.RecordBatch.from_arrays([*cols, xs], names=[*keys, "_xs"])

    fields = [df.schema[k] for k in keys] + [StructField("_xs", ArrayType(df.schema[value].dataType, True), True)]
    return df.select(*keys, value).mapInArrow(gather, StructType(fields))


def _tree(df: DataFrame, keys: list[str], value: str, reduce: Callable[[Column], Column], out: str, spread: int, fan_in: int) -> DataFrame:
    """Reduce each key's values in a tree of lists of at most ``fan_in``.

    Two levels inside the task, before any exchange: the lists of a window, then
    the lists of these results.  Partial results meet on (key, part), are
    numbered there, and go up ``fan_in`` at a time until one is left; the same
    partitioning serves every level.  The depth covers as many partial results
    as a row number can count, so it doesn't depend on the data.
    """
    if fan_in < 2 or spread < 1:
        raise ValueError("fan_in must be at least 2, spread at least 1")
    refuse(df, keys, "_x", "_xs", "_n", "_s")
    kind = df.schema[value].dataType
    rows = df.select(*keys, F.col(value).alias("_x"))
    for _ in range(2):
        rows = _runs(rows, keys, "_x", fan_in).select(*keys, reduce(F.col("_xs")).cast(kind).alias("_x"))
    rows = rows.withColumn("_s", F.pmod(F.spark_partition_id(), F.lit(spread)))
    by = [*keys, "_s"] if spread > 1 else keys
    number = F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(0))) - 1
    rows = rows.select(*by, number.alias("_n"), F.struct("_x").alias("_x"))

    def up(rows: DataFrame, by: list) -> DataFrame:
        lists = rows.groupBy(*by).agg(F.collect_list("_x").alias("_xs"))
        return lists.withColumn("_x", F.struct(reduce(F.transform("_xs", lambda r: r["_x"])).cast(kind).alias("_x"))).drop("_xs")

    for _ in range(math.ceil(31 / math.log2(fan_in)) - 1):
        rows = up(rows.withColumn("_n", F.floor(F.col("_n") / fan_in)), [*by, "_n"])
    rows = up(rows, by)  # at most fan_in numbers are left
    if spread > 1:
        rows = rows.withColumn("_n", F.floor(F.col("_s") / fan_in))
        rows = up(up(rows, [*keys, "_n"]) if spread > fan_in else rows, keys)
    return rows.select(*keys, F.col("_x")["_x"].alias(out))


def group_then_fold(
    df: DataFrame, keys, value: str, zero: Column | None, op: str | Callable[[Column, Column], Column], out: str, spread: int = 1, fan_in: int = FAN_IN
) -> DataFrame:
    """groupByKey followed by a fold of each list (A3 + P6).

    A built-in ``op`` (``sum``, ``max``, ...) is the aggregate itself: partial
    sums before the one exchange, no lists.  Otherwise ``op`` must be
    associative and commutative with ``zero`` as identity.
    """
    keys = as_list(keys)
    if isinstance(op, str):
        return reduce_by_key(df, keys, value, op, out)
    return _tree(df, keys, value, lambda xs: F.aggregate(xs, zero, op), out, spread, fan_in)


def _reduce_list(xs: Column, f: Callable[[Column, Column], Column], kind) -> Column:
    rest = F.slice(xs, 2, F.greatest(F.size(xs) - 1, F.lit(0)))
    return F.aggregate(rest, F.element_at(xs, 1), lambda a, x: f(a, x).cast(kind))


def reduce_by_key(
    df: DataFrame, keys, value: str, f: str | Callable[[Column, Column], Column], out: str | None = None, spread: int = 1, fan_in: int = FAN_IN
) -> DataFrame:
    """reduceByKey with an associative, commutative ``f``.

    * ``f`` names a built-in (``sum``, ``max``, ``min``, ``bit_or``, ...; max
      and min order structs too): partial aggregate, one exchange, no lists.
    * ``f`` is a function of two Columns returning a Column: a tree of lists
      with at most ``fan_in`` values each, at any key size.  Its first two levels
      are inside the task, so partial results cross the exchange, not values;
      ``spread`` parts per key (one by default) deal these over several tasks.
      ``f`` stays a Spark expression; Arrow only brings equal keys together.
      The result keeps the value's type.

    A key with a single value returns it without calling ``f``.  For opaque
    Python functions use ``reduce_by_key_pandas``.
    """
    keys = as_list(keys)
    out = out or value
    if isinstance(f, str):
        if f not in BUILTIN_REDUCERS:
            raise ValueError(f"unknown built-in reducer {f!r}; known: {sorted(BUILTIN_REDUCERS)}")
        return df.groupBy(*keys).agg(BUILTIN_REDUCERS[f](F.col(value)).alias(out))
    kind = df.schema[value].dataType
    return _tree(df, keys, value, lambda xs: _reduce_list(xs, f, kind), out, spread, fan_in)


# Number of distinct keys a map task folds before it flushes its partial results.
PARTIAL_FLUSH_KEYS = 100_000


def reduce_by_key_pandas(
    df: DataFrame,
    keys,
    value: str,
    fn: Callable[[Any, Any], Any],
    out: str | None = None,
) -> DataFrame:
    """reduceByKey with an opaque Python binary function (A4 c).

    Two phases over Arrow record batches, the DataFrame form of a combiner:
    ``mapInArrow`` folds each task's rows per key (bounded memory: flushes
    every ``PARTIAL_FLUSH_KEYS`` keys), one exchange on the key, then
    ``applyInArrow`` folds the partials, streaming a key's partial rows
    batch by batch so a hot key never sits in memory whole.  Values reach
    ``fn`` as exact Python values (``None`` for null, ints stay ints); a
    null key is one group.
    """
    keys = as_list(keys)
    out = out or value
    fields = [df.schema[k] for k in keys] + [StructField(out, df.schema[value].dataType, True)]
    schema = StructType(fields)
    cols = keys + [out]
    nk = len(keys)

    def rows_of(batch):
        return zip(zip(*[batch.column(i).to_pylist() for i in range(nk)]), batch.column(nk).to_pylist())

    def emit(acc: dict, arrow_schema):
        columns = list(zip(*[(*k, v) for k, v in acc.values()]))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), type=arrow_schema.field(i).type) for i, c in enumerate(columns)], schema=arrow_schema
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict = {}  # hashable form of the key -> (key, value)
        arrow_schema = None
        for batch in batches:
            arrow_schema = batch.schema
            for k, v in rows_of(batch):
                h = hashable(k)
                acc[h] = (k, fn(acc[h][1], v) if h in acc else v)
            if len(acc) >= PARTIAL_FLUSH_KEYS:
                yield emit(acc, arrow_schema)
                acc = {}
        if acc:
            yield emit(acc, arrow_schema)

    def final(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, total, arrow_schema = None, None, None
        for batch in batches:  # all rows are of one key, as Spark groups keys
            arrow_schema = batch.schema
            for k, v in rows_of(batch):
                first, total = (k, v) if first is None else (first, fn(total, v))
        if first is not None:
            yield emit({None: (first, total)}, arrow_schema)

    partials = df.select(*keys, F.col(value).alias(out)).mapInArrow(partial, schema)
    return partials.groupBy(*keys).applyInArrow(final, schema)
