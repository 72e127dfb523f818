"""cogroup (G1, G2, G4) and cogroup with user code (G3).

One tagged union and one ``groupBy``: a single exchange, one row for a key
seen on either side, a missing side is ``[]`` (never null), null keys are one
group and null values survive (each value is wrapped in a struct).  If one
side has keys too large for a list, ``cogroup_split`` splits that side, and
every chunk carries the whole list of the other.  ``cogroup_grid`` splits any
of n sides: a key's rows are the product of its chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import functions as F

from pairflow.operators.grouping import group_by_key
from pairflow.operators.joins import LEAST, join
from pairflow.operators.skew import Split, as_list, refuse


# Output rows handed on at a time.
APPLY_SLICE_ROWS = 10_000


def cogroup_many(sides: Sequence[tuple[DataFrame, list[str] | str]], keys, outs: Sequence[str], sort: bool = False) -> DataFrame:
    """Cogroup n inputs: ``keys..., outs[0], ..., outs[n-1]``, one row per key.

    ``sides`` pairs each DataFrame with its value column(s); every side must
    have the ``keys`` columns with the same types.
    """
    keys = as_list(keys)
    tags = [f"_t{i}" for i in range(len(sides))]
    refuse(sides[0][0], keys, "_w", *tags)
    wrapped = [df.select(*keys, F.struct(*as_list(vals)).alias("_w")) for df, vals in sides]
    types = [s.schema["_w"].dataType for s in wrapped]
    parts = [
        s.select(*keys, *[(F.col("_w") if j == i else F.lit(None).cast(types[j])).alias(t) for j, t in enumerate(tags)])
        for i, s in enumerate(wrapped)
    ]
    union = reduce(lambda a, b: a.unionByName(b), parts)
    grouped = union.groupBy(*keys).agg(*[F.collect_list(t).alias(t) for t in tags])
    lists = []
    for t, out, (_, vals) in zip(tags, outs, sides):
        vals = as_list(vals)
        lst = F.transform(F.col(t), _field(vals[0])) if len(vals) == 1 else F.col(t)
        lists.append((F.sort_array(lst) if sort else lst).alias(out))
    return grouped.select(*keys, *lists)


def cogroup(
    left: DataFrame, right: DataFrame, keys, left_values, right_values, outs: tuple[str, str] = ("vs", "ws"), sort: bool = False
) -> DataFrame:
    """cogroup of two keyed DataFrames: ``keys..., vs, ws``, one row per key."""
    return cogroup_many([(left, left_values), (right, right_values)], keys, outs, sort=sort)


def cogroup_split(
    left: DataFrame,
    right: DataFrame,
    keys,
    left_values,
    right_values,
    split: Split,
    side: str = "left",
    outs: tuple[str, str] = ("vs", "ws"),
    sort: bool = False,
) -> DataFrame:
    """cogroup whose ``side`` is split: ``keys..., chunk, vs, ws``.

    Each chunk of the split side comes with the key's whole list of the other
    side, so every pair of values meets in exactly one row.  A key that only
    the other side has is one row with a null chunk.  The other side's lists
    must fit a row.
    """
    if side not in ("left", "right"):
        raise ValueError("side must be left or right")
    keys = as_list(keys)
    cut, whole = ((left, left_values), (right, right_values)) if side == "left" else ((right, right_values), (left, left_values))
    a = group_by_key(cut[0], keys, cut[1], out="_a", sort=sort, split=split)
    b = group_by_key(whole[0], keys, whole[1], out="_b", sort=sort)
    b = b.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_b")
    same = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys])
    rows = a.join(b, same, "left").select(*keys, "chunk", "_a", F.coalesce("_b", F.array().cast(b.schema["_b"].dataType)).alias("_b"))
    alone = b.join(a.select(*keys).distinct(), same, "left_anti")
    alone = alone.select(*[F.col(f"_k_{k}").alias(k) for k in keys], F.lit(None).cast("string").alias("chunk"), F.array().cast(a.schema["_a"].dataType).alias("_a"), "_b")
    x, y = ("_a", "_b") if side == "left" else ("_b", "_a")
    return rows.unionByName(alone).select(*keys, "chunk", F.col(x).alias(outs[0]), F.col(y).alias(outs[1]))


def cogroup_grid(sides: Sequence[tuple], keys, outs: Sequence[str], sort: bool = False) -> DataFrame:
    """Cogroup n inputs of which several may be hot: ``keys..., chunk_0, out_0, ...``.

    ``sides`` has (DataFrame, value columns, ``Split`` or None).  Every side comes
    in chunks of bounded size (without a ``Split`` a key is one chunk), and a key
    has one row per combination of its sides' chunks, so each tuple of values
    meets in exactly one row and no row holds more than a chunk of each side.  A
    side that lacks the key has a null chunk and ``[]``.  Null keys are one group.

    The sides' chunks meet in inner joins only, both sides of which AQE splits
    for a hot key: each side first gets a row for every key that it lacks.
    """
    keys = as_list(keys)
    refuse(sides[0][0], keys, *[f"chunk_{i}" for i in range(len(sides))], *[o.lower() for o in outs])
    chunked = []
    for i, ((df, values, split), out) in enumerate(zip(sides, outs)):
        g = group_by_key(df, keys, values, out=out, sort=sort, split=split)
        chunked.append(g.select(*keys, (F.col("chunk") if split else F.lit("0")).alias(f"chunk_{i}"), out))
    # Always true, but it asks for the list, so the keys come from the side's own
    # exchange instead of another one without values.
    held = [g.where(F.xxhash64(F.size(out)) >= LEAST).select(*keys) for g, out in zip(chunked, outs)]
    every = reduce(lambda a, b: a.unionByName(b), held).distinct()
    grid = None
    for g, out in zip(chunked, outs):
        kind = g.schema[out].dataType
        g = join(every, g, keys, "left", null_safe=True).withColumn(out, F.coalesce(out, F.array().cast(kind)))
        grid = g if grid is None else join(grid, g, keys, "inner", null_safe=True)
    return grid


def cogroup_apply(
    cogrouped: DataFrame,
    keys,
    lists: tuple[str, str],
    fn: Callable[[tuple, list, list], Iterable[tuple]],
    schema,
    per_chunk: bool = False,
) -> DataFrame:
    """Run user code over each cogroup row: ``fn(key, vs, ws)`` yields output rows.

    Rows arrive as Arrow record batches in ``mapInArrow`` and reach ``fn`` as
    plain Python values.  The rows of ``cogroup_split`` are refused unless
    ``per_chunk`` says that ``fn`` works chunk by chunk: each pair of values is
    then seen once, but a list of the split side never whole.
    """
    if "chunk" in cogrouped.columns and "chunk" not in as_list(keys) and not per_chunk:
        raise ValueError("the lists are split; say per_chunk=True for a function of each chunk")
    keys = as_list(keys)
    a, b = lists
    out_schema = _struct(schema)
    arrow_schema = to_arrow_schema(out_schema)
    nk = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(nk + 2)]
            rows = (row for rec in zip(*cols) for row in fn(tuple(rec[:nk]), rec[nk] or [], rec[nk + 1] or []))
            while part := list(islice(rows, APPLY_SLICE_ROWS)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), type=f.type) for c, f in zip(zip(*part), arrow_schema)], schema=arrow_schema
                )

    return cogrouped.select(*keys, a, b).mapInArrow(run, out_schema)


def _field(name: str):
    return lambda x: x[name]


def _struct(schema):
    from pyspark.sql.types import StructType, _parse_datatype_string

    return schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
