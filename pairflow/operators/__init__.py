"""Collection-style operators over DataFrames."""

from pairflow.operators.checks import assert_same_multiset, checked, multiset_diff, multiset_digest
from pairflow.operators.cogroup import cogroup, cogroup_apply, cogroup_grid, cogroup_many, cogroup_split
from pairflow.operators.combine import aggregate_by_key, combine_by_key
from pairflow.operators.counting import count_by_value
from pairflow.operators.grouping import group_by_key, group_then_fold, reduce_by_key, reduce_by_key_pandas
from pairflow.operators.joins import join
from pairflow.operators.partitions import map_partitions, map_workers, observed
from pairflow.operators.rowops import (
    apply_transform,
    filter_rows,
    flat_map,
    flat_map_pandas,
    key_value,
    map_pandas,
    map_rows,
    pair_with,
)
from pairflow.operators.semigroups import sum_by_key
from pairflow.operators.skew import Split
from pairflow.operators.streams import cogroup_stream, group_stream
from pairflow.operators.tables import table_function

__all__ = [
    "Split",
    "aggregate_by_key",
    "apply_transform",
    "assert_same_multiset",
    "checked",
    "cogroup",
    "cogroup_apply",
    "cogroup_grid",
    "cogroup_many",
    "cogroup_split",
    "cogroup_stream",
    "combine_by_key",
    "count_by_value",
    "filter_rows",
    "flat_map",
    "flat_map_pandas",
    "group_by_key",
    "group_stream",
    "group_then_fold",
    "join",
    "key_value",
    "map_pandas",
    "map_partitions",
    "map_rows",
    "map_workers",
    "multiset_diff",
    "multiset_digest",
    "observed",
    "pair_with",
    "reduce_by_key",
    "reduce_by_key_pandas",
    "sum_by_key",
    "table_function",
]
