"""Groups read as streams (A2, G3): user code in constant memory.

``group_by_key`` and ``cogroup`` make one row of a group, which must fit a
row.  Here user code reads a group's rows as an iterator of Arrow batches of
bounded size, so a group may be larger than memory; for a cogroup one side is
held, the other streams past it.  Rows come in the order of ``order`` within
their group: one exchange on the keys, one sort of each partition by keys and
order, no list.  A window over this layout marks the first row of a group, so
groups are exactly Spark's, and one Python call reads a task's whole partition,
however many groups it has.  A group is read by one task, as the code sees it whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string
from pyspark.sql.window import Window

from pairflow.operators.skew import as_list, refuse

# Rows of a batch that user code sees, and of a batch of its output.
BATCH_ROWS = 4096


def _schema(schema) -> StructType:
    return schema if isinstance(schema, StructType) else _parse_datatype_string(schema)


def _batches_of(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Output tuples as batches of at most ``BATCH_ROWS`` rows."""
    rows = iter(rows)
    while part := list(islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _groups(batches: Iterable[pa.RecordBatch], nk: int, rows: int) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """(key, batches) of each group of a partition.  The first ``nk`` columns are
    the key, the last marks a group's first row.  What a group's reader leaves is
    skipped before the next group."""

    def pieces():
        number = 0
        for batch in batches:
            last = batch.num_columns - 1
            marks = np.flatnonzero(batch.column(last).to_numpy(zero_copy_only=False)).tolist()
            body = batch.select(list(range(last)))
            if not marks or marks[0]:
                marks.insert(0, 0)
                number -= 1  # these rows go on with the group before
            for a, b in zip(marks, [*marks[1:], batch.num_rows]):
                number += 1
                for start in range(a, b, rows):
                    yield number, body.slice(start, min(rows, b - start))

    for _, own in groupby(pieces(), key=lambda x: x[0]):
        own = (piece for _, piece in own)
        first = next(own)
        yield tuple(first.column(i)[0].as_py() for i in range(nk)), chain([first], own)


def _by_group(rows: DataFrame, keys: list[str], order: list, each, schema: StructType, batch_rows: int) -> DataFrame:
    """``each(key, batches)`` yields the output rows of a group."""
    nk, arrow = len(keys), to_arrow_schema(schema)
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(0)]))
    marked = rows.select("*", F.lag(F.lit(False), 1, True).over(window).alias("_new"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _groups(batches, nk, batch_rows)
        yield from _batches_of((row for key, own in groups for row in each(key, own)), arrow)

    return marked.mapInArrow(run, schema)


def group_stream(
    df: DataFrame,
    keys,
    values,
    fn: Callable[[tuple, Iterator[pa.RecordBatch]], Iterable[tuple]],
    schema,
    order=None,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """groupByKey with user code: ``fn(key, batches)`` yields output rows.

    ``batches`` are record batches of the ``values`` columns with at most
    ``batch_rows`` rows each, in the order of ``order`` (columns or column
    expressions over ``keys`` and ``values``).  The iterator is read while
    ``fn`` asks for it; what ``fn`` leaves is skipped.  Null keys are one group.
    """
    keys, values = as_list(keys), as_list(values)
    refuse(df, keys, "_new")
    nk = len(keys)

    def each(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterable[tuple]:
        return fn(key, (b.select(list(range(nk, b.num_columns))) for b in batches))

    return _by_group(df.select(*keys, *values), keys, as_list(order), each, _schema(schema), batch_rows)


def cogroup_stream(
    held: DataFrame,
    streamed: DataFrame,
    keys,
    held_values,
    streamed_values,
    fn: Callable[[tuple, list, Iterator[pa.RecordBatch]], Iterable[tuple]],
    schema,
    order=None,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """cogroup with user code that streams one side: ``fn(key, held, batches)``.

    ``held`` is the list of the key's held values (a value, or a tuple of
    several); ``batches`` are record batches of the other side's values, at
    most ``batch_rows`` rows each, in the order of ``order``.  A key of either
    side is one call; a missing side is an empty list or no batch.  Only the
    held side must fit a worker's memory.

    Both sides go through one exchange as tagged rows, the held side's first
    within each group.
    """
    keys = as_list(keys)
    a, b = as_list(held_values), as_list(streamed_values)
    refuse(held, keys, "_side", "_held", "_row", "_new")
    h = held.select(*keys, F.lit(0).alias("_side"), F.struct(*a).alias("_held"))
    s = streamed.select(*keys, F.lit(1).alias("_side"), F.struct(*b).alias("_row"))
    rows = h.withColumn("_row", F.lit(None).cast(s.schema["_row"].dataType)).unionByName(
        s.withColumn("_held", F.lit(None).cast(h.schema["_held"].dataType))
    )
    nk, single = len(keys), len(a) == 1

    def each(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterable[tuple]:
        whole: list = []
        first: list = []
        for batch in batches:  # the held rows, up to the first batch that has a streamed row
            n = pc.sum(pc.equal(batch.column(nk), 0)).as_py()
            for v in batch.column(nk + 1).slice(0, n).to_pylist():
                whole.append(next(iter(v.values())) if single else tuple(v.values()))
            if n < batch.num_rows:
                first.append(batch.slice(n))
                break
        own = (pa.RecordBatch.from_struct_array(x.column(nk + 2)) for x in chain(first, batches))
        return fn(key, whole, own)

    tagged = ["_side", *[F.col(f"_row.{c}") for c in as_list(order)]]
    return _by_group(rows.select(*keys, "_side", "_held", "_row"), keys, tagged, each, _schema(schema), batch_rows)
