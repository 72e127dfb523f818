"""Rows of Arrow batches brought together by key inside a task.

What ``combine_by_key`` and the expression reduce do before their exchange:
a task gathers a window of its rows, puts equal keys side by side and hands
each key's values on as one run.  Nothing leaves the task, so a run need not
hold all values of a key; the step after the exchange brings runs together.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# A window of a task's rows ends at either bound.
WINDOW_ROWS = 131_072
WINDOW_BYTES = 32 << 20


def hashable(v):
    """A dictionary key that is equal where Spark's grouping is: all NaNs are
    one key, and so are both zeros; arrays, structs and maps go by content."""
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    if isinstance(v, dict):
        return ("map", *sorted(((hashable(k), hashable(x)) for k, x in v.items()), key=repr))
    if isinstance(v, (list, tuple)):
        return ("list", *(hashable(x) for x in v))
    return v


def windows(batches: Iterable[pa.RecordBatch], rows: int = WINDOW_ROWS, size: int = WINDOW_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive batches joined until a window holds ``rows`` rows or ``size`` bytes."""
    held: list[pa.RecordBatch] = []
    n = b = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n, b = n + batch.num_rows, b + batch.nbytes
        if n >= rows or b >= size:
            yield pa.concat_batches(held)
            held, n, b = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def _codes(column: pa.Array) -> tuple[np.ndarray, int]:
    """Equal numbers for equal values.  Values that Spark holds equal may get
    two numbers (both zeros do); different values never share one."""
    try:
        d = column.dictionary_encode(null_encoding="encode")
        return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(d.dictionary)
    except (pa.ArrowNotImplementedError, pa.ArrowTypeError):
        seen: dict = {}
        return np.array([seen.setdefault(hashable(v), len(seen)) for v in column.to_pylist()], np.int64), len(seen)


def _numbers(columns: list[pa.Array]) -> np.ndarray:
    if not columns:
        raise ValueError("no key columns")
    codes, _ = _codes(columns[0])
    for c in columns[1:]:
        more, n = _codes(c)
        codes = np.unique(codes * n + more, return_inverse=True)[1]
    return codes


def changes(columns: list[pa.Array]) -> np.ndarray:
    """Where a row's key isn't that of the row before it; the first row is one."""
    codes = _numbers(columns)
    return np.flatnonzero(np.r_[True, np.diff(codes) != 0]) if len(codes) else codes


def runs(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): row numbers with equal keys side by side, and where each
    run of them starts; without key columns there is one run."""
    codes = _numbers(columns)
    order = np.argsort(codes, kind="stable")
    if not len(order):
        return order, order
    return order, np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0])
