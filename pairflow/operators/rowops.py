"""Per-row operators (P1-P5, P8): flat_map, map, filter, key/value, pairing, transform.

Each returns a DataFrame whose plan Catalyst can see through: built-in
expressions stay inside whole-stage codegen.  The ``*_pandas`` forms take
opaque Python and run it on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flat_map(df: DataFrame, expr: Column, out: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """0..n output rows per input row from an array-valued expression."""
    return df.select(*keep, F.explode(expr).alias(out))


# Input rows handed to an opaque flatMap function at a time: a row may fan
# out into thousands of rows, so the output of one call stays bounded.
FLAT_MAP_SLICE_ROWS = 1024


def flat_map_pandas(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Opaque Python flatMap: ``fn`` maps a slice of an Arrow batch to 0..n rows per input row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), FLAT_MAP_SLICE_ROWS):
                out = fn(pdf.iloc[start : start + FLAT_MAP_SLICE_ROWS])
                if out is not None and len(out):
                    yield out

    return df.mapInPandas(run, schema)


def map_rows(df: DataFrame, *exprs) -> DataFrame:
    """Exactly one output row per input row."""
    return df.select(*exprs)


def map_pandas(col, fn: Callable[[pd.Series], pd.Series], return_type) -> Column:
    """Opaque Python map over a column, vectorised over Arrow batches."""
    return F.pandas_udf(fn, return_type)(col)


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Keep rows where the predicate is true; a null predicate drops the row."""
    return df.where(predicate)


def key_value(df: DataFrame, key, value, key_name: str = "key", value_name: str = "value") -> DataFrame:
    """toKV: any pair of expressions as two named columns."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    return df.select(k.alias(key_name), v.alias(value_name))


def pair_with(df: DataFrame, col: str, value: int = 1, out: str = "one", dtype: str = "bigint") -> DataFrame:
    """map((_, 1L)): each element paired with a constant."""
    return df.select(col, F.lit(value).cast(dtype).alias(out))


def apply_transform(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """applyTransform: plug any DataFrame-to-DataFrame step into a chain."""
    return df.transform(fn)
