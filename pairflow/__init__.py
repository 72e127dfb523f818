"""pairflow: collection-style, keyed data processing on Spark DataFrames."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that Spark ships to Python workers (mapInPandas, mapInArrow,
# applyInArrow, pandas UDFs) are pickled with their code, so workers need no
# installed copy of this package, whatever folder the driver started in.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from pairflow.functions import format_row, tokens, words
from pairflow.operators import *  # noqa: F401,F403
from pairflow.operators import __all__ as _ops
from pairflow.sources import rows_to_df, table

__all__ = ["format_row", "rows_to_df", "table", "tokens", "words", *_ops]
