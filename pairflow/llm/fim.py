"""Fill-in-the-middle documents with content-defined chunk memoization.

A document is cut at two line borders that a hash of its id draws, and its
parts are put in another order behind sentinels.  Finding the borders takes the
number of lines and the places of two of them:

* A rolling hash over the last ``WINDOW`` bytes ends a chunk where its top bits
  are zero, so equal passages give equal chunks wherever they stand.
* A chunk's boundary summary (where its lines end, in code points; its code
  points; whether its last line is open) is kept in a cache by content: a hit
  compares the chunk's bytes, so it is exact.
* Adding up the summaries of a document's chunks counts its lines and tells
  which chunk holds the k-th border; that chunk's summary has the place.

The cache is a worker's memory of at most ``CACHE`` bytes and saves time only.
The text itself never leaves the JVM: parts are cut and joined by Spark's
string functions.

Defined results: a null text is empty; an empty text, or one that holds a
sentinel, stays plain; texts of any length are read whole, hashed in strips of
``STRIP`` bytes; repeated rows and ties each give a row of their own; a null id
draws from the empty string; an empty table gives no rows.  Only the id and
text columns are read, so extra columns can't clash.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairflow.llm.base import per_process, strings

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = 7, 100, 50
WINDOW, LEAST, MOST, BITS = 32, 64, 16_384, 10  # a chunk has about 2^BITS bytes, LEAST to MOST
STRIP = 1 << 20
CACHE = 32 << 20


def _gear() -> np.ndarray:
    """A 32-bit number per byte value, by the splitmix rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the gears of the last ``WINDOW`` bytes, each
    shifted by its distance: windows of 1, 2, 4, ... bytes, each from two halves."""
    h = GEAR[data]
    size = 1
    while size < WINDOW:
        h[size:] += h[:-size] << np.uint32(size)  # the right side is complete before it is added
        size *= 2
    return h


def chunks(data: np.ndarray) -> list:
    """Ends of the content-defined chunks of a text's bytes."""
    ends, start = [], 0
    for a in range(0, len(data), STRIP):
        before = min(a, WINDOW - 1)
        h = rolling(data[a - before : a + STRIP])[before:]
        for e in (np.flatnonzero(h >> np.uint32(32 - BITS) == 0) + (a + 1)).tolist():
            while e - start > MOST:
                start += MOST
                ends.append(start)
            if e - start >= LEAST:
                start = e
                ends.append(e)
    while len(data) - start > MOST:
        start += MOST
        ends.append(start)
    if start < len(data):
        ends.append(len(data))
    return ends


class Memo:
    """Boundary summaries of chunks by their content."""

    def __init__(self, most: int = CACHE):
        self.most, self.size, self.held = most, 0, {}
        self.hits = self.misses = 0

    def summary(self, chunk: bytes) -> tuple:
        """(code points up to the end of each closed line, code points, last line open)."""
        found = self.held.get(chunk)  # equal hash, then equal bytes
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        data = np.frombuffer(chunk, np.uint8)
        points = np.cumsum((data & 0xC0) != 0x80)
        found = (points[data == 10].tolist(), int(points[-1]), chunk[-1] != 10)
        if self.size > self.most:
            self.held.clear()
            self.size = 0
        self.held[chunk] = found
        self.size += 2 * len(chunk) + 200
        return found


def borders(text: str, memo: Memo) -> tuple:
    """(number of lines, function from k to the code points of the first k lines)."""
    raw = text.encode("utf-8", "surrogatepass")
    data, start, parts = np.frombuffer(raw, np.uint8), 0, []
    for end in chunks(data):
        parts.append(memo.summary(raw[start:end]))
        start = end
    lines = [0, *np.cumsum([len(p[0]) for p in parts]).tolist()] if parts else [0]
    points = [0, *np.cumsum([p[1] for p in parts]).tolist()] if parts else [0]
    n = lines[-1] + (1 if parts and parts[-1][2] else 0)

    def place(k: int) -> int:
        if k == 0:
            return 0
        if k > lines[-1]:  # the open last line
            return points[-1]
        i = int(np.searchsorted(lines, k)) - 1
        return points[i] + parts[i][0][k - lines[i] - 1]

    return n, place


def draws(id_col: str, seed: int = SEED) -> list:
    """Four unsigned numbers of 32 bits from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    memo = per_process("fim", Memo)
    for texts, h1, h2 in batches:
        rows = []
        for text, a, b in zip(strings(texts), h1.tolist(), h2.tolist()):
            n, place = borders(text, memo)
            low, high = sorted((a % (n + 1), b % (n + 1)))
            rows.append((n, place(low), place(high) - place(low)))
        yield pd.DataFrame(rows, columns=["n", "prefix_chars", "middle_chars"])


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every document:
    ``rate`` of a hundred are cut, ``spm`` of a hundred of these put the suffix first."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    h = draws(id_col, seed)
    cuts = F.pandas_udf(_cuts, "n long, prefix_chars long, middle_chars long")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), cuts(text, h[0], h[1]).alias("c"), h[2].alias("h3"), h[3].alias("h4"))
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm")
    rows = rows.select("id", "text", "c.*", form.alias("form"))
    cut = lambda a, b: F.substr("text", a, b)
    prefix = cut(F.lit(1), F.col("prefix_chars"))
    middle = cut(F.col("prefix_chars") + 1, F.col("middle_chars"))
    suffix = F.substr("text", F.col("prefix_chars") + F.col("middle_chars") + 1)
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm_ = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm_)
    only = lambda c: F.when(F.col("form") != "plain", F.col(c)).alias(c)
    return rows.select("id", "n", "form", only("prefix_chars"), only("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form.  No part holds a sentinel and no
    sentinel overlaps itself or another, so each first occurrence is the real one."""
    size = len(PREFIX)
    last = F.locate(MIDDLE, output)
    middle = F.substr(output, last + size)
    second = lambda mark: F.locate(mark, output)

    def first(mark):  # between the opening sentinel and the second
        return F.substr(output, F.lit(size + 1), second(mark) - size - 1)

    def then(mark):  # between the second sentinel and the middle's
        return F.substr(output, second(mark) + size, last - second(mark) - size)

    psm = F.concat(first(SUFFIX), middle, then(SUFFIX))
    spm = F.concat(then(PREFIX), middle, first(PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
