"""combineByKey (A6): a user accumulator whose type differs from the value's.

    create()                 -> an empty accumulator
    add(acc, values)         -> acc with a batch of one key's values in it
    merge(acc, acc)          -> both together
    extract(acc)             -> the result of a key

Values are folded batch-wise, not pairwise: ``add`` sees an Arrow record
batch with all values that a window of the task's rows has for the key, so a
vectorised ``add`` costs one call per key and window.  A key that holds a third
of the rows crosses the one exchange as one accumulator per task.  Keys of which
a window has fewer than ``FEW`` rows would cost a call for about every row, the
more keys the more calls; these rows cross it as they are and are added behind
it, where all of a key's stand together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, DataType, StructField, StructType, _parse_datatype_string

from pairflow.operators.batches import changes, hashable, runs, windows
from pairflow.operators.skew import as_list, refuse

# Distinct keys whose accumulators a task holds before it hands them on.
FLUSH_KEYS = 100_000
# Rows of a window, of narrow rows (wide ones end it by their bytes): the more, the more of a key's.
ROWS = 1 << 20
# Rows of a key that a window must hold for them to be added before the exchange.
FEW = 8


def _type(t) -> DataType:
    return t if isinstance(t, DataType) else _parse_datatype_string(t)


def combine_by_key(
    df: DataFrame,
    keys,
    values,
    create: Callable[[], Any],
    add: Callable[[Any, pa.RecordBatch], Any],
    merge: Callable[[Any, Any], Any],
    extract: Callable[[Any], Any],
    acc_type,
    out: str,
    out_type,
    flush_keys: int = FLUSH_KEYS,
) -> DataFrame:
    """``keys..., out`` with the extracted result of each key's accumulator.

    ``merge`` must be associative and commutative, and ``create`` its identity.
    ``acc_type`` and ``out_type`` are Spark types (or DDL); accumulators are
    Python values of that type (dicts for structs).  Null keys are one group,
    null values reach ``add``.  An empty input gives no rows.

    Plan: ``mapInArrow`` (accumulators of a task, at most ``flush_keys`` of
    them held, and the rows of rare keys), one exchange on the keys, a sort
    within partitions, and ``mapInArrow`` again, which adds up a key's rows and
    merges its accumulators with one of them in memory.
    """
    keys, values = as_list(keys), as_list(values)
    own_names = [f"_v{i}" for i in range(len(values))]
    refuse(df, keys, "_acc", "_raw", *own_names, out.lower())
    acc_type, out_type = _type(acc_type), _type(out_type)
    key_fields = [df.schema[k] for k in keys]
    own_fields = [StructField(n, df.schema[v].dataType, True) for n, v in zip(own_names, values)]
    middle = StructType([*key_fields, StructField("_acc", acc_type, True), StructField("_raw", BooleanType(), False), *own_fields])
    final = StructType([*key_fields, StructField(out, out_type, True)])
    arrow_acc, arrow_out = to_arrow_type(acc_type), to_arrow_type(out_type)
    nk = len(keys)

    def columns(rows: list, kinds: list, last: pa.DataType) -> list[pa.Array]:
        """Rows of (key values, last value); keys keep the Arrow types they came with."""
        cols = [pa.array([k[i] for k, _ in rows], type=t) for i, t in enumerate(kinds)]
        return [*cols, pa.array([v for _, v in rows], type=last)]

    def emit(rows: list, kinds: list) -> pa.RecordBatch:
        n, nulls = len(rows), [pa.nulls(len(rows), t) for t in kinds[nk:]]
        cols = [*columns(rows, kinds[:nk], arrow_acc), pa.array(np.zeros(n, bool)), *nulls]
        return pa.RecordBatch.from_arrays(cols, names=middle.names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}  # hashable form of the key -> [key, accumulator]
        kinds: list = []
        for window in windows(batches, ROWS):
            kinds = [c.type for c in window.columns]
            order, starts = runs([window.column(i) for i in range(nk)])
            sizes = np.diff(np.r_[starts, len(order)])
            rare = np.repeat(sizes < FEW, sizes)
            if rare.any():
                rows = window.take(pa.array(order[rare]))
                n = rows.num_rows
                cols = [*rows.columns[:nk], pa.nulls(n, arrow_acc), pa.array(np.ones(n, bool)), *rows.columns[nk:]]
                yield pa.RecordBatch.from_arrays(cols, names=middle.names)
            starts, sizes = starts[sizes >= FEW], sizes[sizes >= FEW]
            rows = window.take(pa.array(order[~rare]))
            firsts = zip(*[window.column(i).take(pa.array(order[starts])).to_pylist() for i in range(nk)])
            own = rows.select(list(range(nk, rows.num_columns)))
            ends = np.cumsum(sizes)
            for key, a, b in zip(firsts, (ends - sizes).tolist(), ends.tolist()):
                at = held.setdefault(hashable(key), [key, None])
                at[1] = add(create() if at[1] is None else at[1], own.slice(a, b - a))
                if len(held) >= flush_keys:
                    yield emit(list(held.values()), kinds)
                    held = {}
        if held:
            yield emit(list(held.values()), kinds)

    def added(window: pa.RecordBatch, raw: np.ndarray, run: np.ndarray, n: int) -> list[list]:
        """For each of the n runs its accumulators, that of its rows among them."""
        rows = window.take(pa.array(np.flatnonzero(raw)))
        own = pa.RecordBatch.from_arrays(rows.columns[nk + 2 :], names=values)
        sizes = np.bincount(run[raw], minlength=n)
        ends = np.cumsum(sizes)
        some = np.flatnonzero(sizes)
        sums = [add(create(), own.slice(a, b - a)) for a, b in zip((ends - sizes)[some].tolist(), ends[some].tolist())]
        out: list[list] = [[] for _ in range(n)]
        # In the form in which accumulators come from the exchange.
        for i, acc in zip(some.tolist(), pa.array(sums, type=arrow_acc).to_pylist()):
            out[i].append(acc)
        for i, acc in zip(run[~raw].tolist(), window.column(nk).take(pa.array(np.flatnonzero(~raw))).to_pylist()):
            out[i].append(acc)
        return out

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, acc, kinds = None, None, None, []
        for window in windows(batches):
            kinds = [window.column(i).type for i in range(nk)]
            starts = changes([window.column(i) for i in range(nk)])
            run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, window.num_rows]))
            raw = window.column(nk + 1).to_numpy(zero_copy_only=False)
            firsts = zip(*[window.column(i).take(pa.array(starts)).to_pylist() for i in range(nk)])
            done = []
            for k, accs in zip(firsts, added(window, raw, run, len(starts))):
                h = hashable(k)
                if h != now:
                    if now is not None:
                        done.append((key, extract(acc)))
                    now, key, acc = h, k, accs.pop(0)
                for a in accs:
                    acc = merge(acc, a)
            if done:
                yield pa.RecordBatch.from_arrays(columns(done, kinds, arrow_out), names=final.names)
        if now is not None:
            yield pa.RecordBatch.from_arrays(columns([(key, extract(acc))], kinds, arrow_out), names=final.names)

    partials = df.select(*keys, *values).mapInArrow(partial, middle)
    return partials.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merged, final)


def aggregate_by_key(df: DataFrame, keys, parts: dict[str, Column], extract: Callable[[dict[str, Column]], Column], out: str) -> DataFrame:
    """The same with an accumulator of built-in aggregates: ``parts`` are the
    accumulator's fields, ``extract`` makes the result from them.  Partial
    aggregation, whole-stage code, no Python."""
    keys = as_list(keys)
    names = {name: f"_acc_{name}" for name in parts}
    refuse(df, keys, *names.values())
    grouped = df.groupBy(*keys).agg(*[agg.alias(names[name]) for name, agg in parts.items()])
    return grouped.select(*keys, extract({name: grouped[n] for name, n in names.items()}).alias(out))
