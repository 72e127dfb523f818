"""Best-fit packing into sequences of several permitted lengths.

Each task packs the documents of its own input split in blocks of at most
``BLOCK`` documents: no shuffle, bounded memory, and no hot key, as no key
decides where a row goes.  Bins therefore depend on how the input is split,
and a split's last bins may stay emptier.  A sequence of L tokens costs
L + L * L / ``EVEN``: work per token and work per pair of tokens.  Within a
block, pieces go longest first into the fullest open bin that has room.  If
none has, all permitted lengths are compared: each is filled in thought with
the longest of the block's remaining pieces that still fit, as far as these
exceed the room that open bins will take first, and cut to what it would hold.
The length that costs least per token held is opened.  At the end of the block
every bin is cut down to the smallest permitted length that holds its contents.
The block is also packed with the longest length opened every time; the cheaper
of both packings is kept.  A document longer than the largest length is cut
into full pieces and a rest; no token is lost.

Defined results: a null or empty text is one piece of one token (its end
mark); repeated rows are packed each on its own; ties go to the earlier
document; an empty table gives an empty result.
"""

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

BLOCK = 65_536
EVEN = 24_576  # length at which work per pair equals work per token
LENGTHS = (512, 1024, 2048, 4096, 8192)


def price(length: int) -> float:
    return length + length * length / EVEN


def fitted(pieces: list, lengths: list, ahead: bool) -> tuple:
    """(bin, offset) of each piece and the final length of each bin.  Opens the
    cheapest length by looking ahead, or else the longest."""
    order = sorted(range(len(pieces)), key=lambda i: (-pieces[i], i))
    falling = [-pieces[i] for i in order]
    smallest = min(pieces, default=0)
    left = sum(pieces)  # tokens still to place
    spare = 0  # room of open bins, where any piece may fit
    room: list = []  # (room, bin) of these bins, sorted
    used: list = []
    where = [(0, 0)] * len(pieces)

    def filled(space: int, at: int) -> int:
        """Tokens that the pieces from place ``at`` on, longest first, would put into ``space``."""
        rest = space
        while rest >= smallest and (at := bisect.bisect_left(falling, -rest, at)) < len(falling):
            rest += falling[at]
            at += 1
        return space - rest

    for at, i in enumerate(order):
        n = pieces[i]
        left -= n
        fits = bisect.bisect_left(room, (n, -1))
        if fits < len(room):
            space, b = room.pop(fits)
            spare -= space
        else:
            free = max(0, left - spare)

            def per_token(c):
                held = n + (min(filled(c - n, at + 1), free) if free else 0)
                return price(lengths[bisect.bisect_left(lengths, held)]) / held, c

            space = min((c for c in lengths if c >= n), key=per_token) if ahead else lengths[-1]
            b = len(used)
            used.append(0)
        where[i] = (b, used[b])
        used[b] += n
        if space - n >= smallest:
            bisect.insort(room, (space - n, b))
            spare += space - n
    return where, [lengths[bisect.bisect_left(lengths, u)] for u in used]


def best_fit(pieces: list, lengths: tuple) -> tuple:
    """``pieces``: sizes, each at most max(lengths).  Returns (bin, offset) of
    each and the final length of each bin."""
    plans = [fitted(pieces, sorted(set(lengths)), ahead) for ahead in (True, False)]
    return min(plans, key=lambda plan: sum(map(price, plan[1])))


def pack(
    docs: DataFrame, lengths: tuple = LENGTHS, n_tokens=None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, piece, start, n_tokens, bin_id, bin_offset, bin_length.

    ``n_tokens`` is a column expression for a document's length in tokens;
    by default its words between ASCII white space and one end mark.
    """
    if not lengths or min(lengths) < 1:
        raise ValueError("lengths must be positive")
    if n_tokens is None:
        text = F.coalesce(F.col(text_col), F.lit(""))
        n_tokens = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")) + 1
    id_type = docs.schema[id_col].dataType
    schema = StructType(
        [StructField(id_col, id_type), StructField("piece", LongType()), StructField("start", LongType())]
        + [StructField("n_tokens", LongType()), StructField("bin_id", StringType())]
        + [StructField("bin_offset", LongType()), StructField("bin_length", LongType())]
    )
    longest = max(lengths)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0

        def packed(ids, sizes):
            out, of = [], []
            for k, n in enumerate(sizes):
                for piece, start in enumerate(range(0, n, longest)):
                    of.append((k, piece, start))
                    out.append(min(longest, n - start))
            where, final = best_fit(out, lengths)
            cols = [
                ids.take(pa.array([k for k, _, _ in of], pa.int64())),
                pa.array([p for _, p, _ in of], pa.int64()),
                pa.array([s for _, _, s in of], pa.int64()),
                pa.array(out, pa.int64()),
                pa.array([f"{part}-{block}-{b}" for b, _ in where], pa.string()),
                pa.array([o for _, o in where], pa.int64()),
                pa.array([final[b] for b, _ in where], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])

        held, n = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                held.append(batch.slice(start, BLOCK))
                n += held[-1].num_rows
                if n >= BLOCK:
                    t = pa.Table.from_batches(held).combine_chunks()
                    yield packed(t.column(0).combine_chunks(), t.column(1).to_pylist())
                    held, n, block = [], 0, block + 1
        if n:
            t = pa.Table.from_batches(held).combine_chunks()
            yield packed(t.column(0).combine_chunks(), t.column(1).to_pylist())

    return docs.select(F.col(id_col).alias("_id"), n_tokens.cast("long").alias("_n")).mapInArrow(rows, schema)
