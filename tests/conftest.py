import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pairflow.session import local_session  # noqa: E402
from pairflow.sources import rows_to_df  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

# The reference programs' input lines, keyed input and expected outputs.
LINES = [
    "Du",
    "Du hast",
    "Du hast mich",
    "Du hast mich",
    "Du hast mich gefragt",
    "Du hast mich gefragt",
    "Du hast mich gefragt und ich hab nichts gesagt",
]
MEANINGS = [("du", "you"), ("hast", "hate"), ("hast", "have"), ("mich", "me")]
WORD_COUNT = ["du 7", "hast 6", "mich 5", "gefragt 3", "und 1", "ich 1", "hab 1", "nichts 1", "gesagt 1"]
JOINED = ["du 7 you", "hast 6 have", "hast 6 hate", "mich 5 me"]


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="pairflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lines(spark):
    return rows_to_df(spark, [(x,) for x in LINES], "line string not null")


@pytest.fixture(scope="session")
def meanings(spark):
    return rows_to_df(spark, MEANINGS, "word string not null, meaning string not null")


def bag(df):
    """Rows as a sorted list of tuples (multiset comparison)."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
