"""Table functions (P1, U1): user objects with ``eval`` and ``terminate`` over a partitioned table.

The table form of a function object with state: Spark makes one object per
partition of the table argument, calls ``eval`` with every row of it in order,
then ``terminate``; either may yield any number of output rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.functions import udtf

from pairflow.operators.skew import as_list


def table_function(df: DataFrame, handler: type, schema, by, order=None) -> DataFrame:
    """Run ``handler`` over ``df`` partitioned by the columns ``by``.

    A partition is all rows with equal ``by`` (nulls are one partition), in one
    task, read row by row: the object's own state is all that is held.  ``order``
    sorts the rows of a partition.  One exchange on ``by``.  Partition by columns
    no value of which has too many rows for one task, and aggregate the output.
    """
    argument = df.asTable().partitionBy(*as_list(by))
    if order:
        argument = argument.orderBy(*as_list(order))
    return udtf(handler, returnType=schema)(argument)
