"""Scalar functions used by the word-count programs (F1-F4, F7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
# a word is a maximal run of Unicode letters; text is lower-cased first;
# formatted output joins fields with one space.
WORD_DELIMITER = r"[^\p{L}]+"
FIELD_SEPARATOR = " "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Lower-case, then split on runs of non-letters (may hold '' at the ends)."""
    return F.split(F.lower(_col(text)), WORD_DELIMITER)


def words(df: DataFrame, text: str = "text", out: str = "word", keep: tuple[str, ...] = ()) -> DataFrame:
    """flatMap(tokenise) + filter(nonEmpty): one row per word occurrence.

    A null text yields no rows.  The whole text is tokenised.
    """
    return (
        df.select(*keep, F.explode(tokens(text)).alias(out))
        .where(F.col(out) != "")
    )


def format_row(*cols, sep: str = FIELD_SEPARATOR) -> Column:
    """String concatenation as the host language does it: a null prints as 'null'."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("null")) for c in cols]
    return F.concat_ws(sep, *parts)
