"""Inverted lists of the corpus, one shard for each stretch of a task's input.

A shard holds at most ``DOCS`` documents and about ``CHARS`` characters.  For
each of its distinct words there is one row: the shard's documents with that
word (numbers within the shard, ascending), how often, and their lengths, packed
in one binary value: the first bytes of all ``RECORD``s, then the second ones and
so on, which compress well on their way.  The compact form has lists in place of
records: no lengths, first the documents that hold the word more than once, and
counts for those only.  The
empty word stands for the end of the text: its row lists every document of the
shard once, with its length and id, as lists; with ``order`` also the shard's texts
(numbers of their words, packed by ``running.planes``) and its words.  Words are what stands between ASCII white space with
A-Z lower-cased, as UTF-8 bytes.  Null counts as the empty text.
"""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, ShortType, StructField, StructType

from pairflow.llm.running import planes

DOCS = 8192
CHARS = 16_000_000
FIRST = 256  # words of a shard by which its documents are put in order
END = b""
RECORD = np.dtype([("doc", "<u2"), ("tf", "<u4"), ("len", "<u4")])


def words_of(text) -> list:
    return text.encode("utf-8", "replace").lower().split() if text else []


def _places(offsets: np.ndarray) -> tuple:
    """Where the first byte of each posting stands in its list, and the list's size."""
    sizes = np.diff(offsets)
    n = np.repeat(sizes, sizes)
    return np.arange(len(n)) + np.repeat(offsets[:-1], sizes) * (RECORD.itemsize - 1), n


def pack(records: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bytes of all lists; list i has the records from offsets[i] to offsets[i + 1]."""
    raw = records.view(np.uint8).reshape(-1, RECORD.itemsize)
    out = np.empty(raw.size, np.uint8)
    at, n = _places(offsets)
    for b in range(RECORD.itemsize):
        out[at] = raw[:, b]
        at += n
    return out


def unpack(packed: bytes, offsets: np.ndarray) -> np.ndarray:
    """The records that ``pack`` was given."""
    raw = np.frombuffer(packed, np.uint8)
    out = np.empty((len(raw) // RECORD.itemsize, RECORD.itemsize), np.uint8)
    at, n = _places(offsets)
    for b in range(RECORD.itemsize):
        out[:, b] = raw[at]
        at += n
    return out.view(RECORD).ravel()


def _cuts(size: int, alone: int) -> list:
    """Stretches of at most 65,536 words, one of which is ``alone`` (-1: none) by itself."""
    cuts = sorted({0, size, *range(0, size, 65_536), *((alone, alone + 1) if alone >= 0 else ())})
    return list(zip(cuts, cuts[1:]))


def build(docs: DataFrame, id_col: str, text_col: str, group: Column | None = None, groups: int = 0, compact: bool = False, order: bool = False) -> DataFrame:
    """(shard, term, packed, docs, tfs, lens, sums, ids, marks, sizes): ``sums[g]``
    counts the word in documents whose ``group`` is g (-1: none); ``ids``, ``marks``
    (the groups) and ``sizes`` (UTF-8 bytes) are filled on the rows of the empty
    word only, as are ``seq`` and ``vocab``, which ``order`` adds."""
    ints = ArrayType(IntegerType())
    schema = StructType(
        [StructField("shard", LongType()), StructField("term", BinaryType()), StructField("packed", BinaryType())]
        + [StructField("docs", ArrayType(ShortType())), StructField("tfs", ints), StructField("lens", ints)]
        + [StructField("sums", ArrayType(LongType()))]
        + [StructField("ids", ArrayType(docs.schema[id_col].dataType)), StructField("marks", ints), StructField("sizes", ints)]
        + [StructField(name, BinaryType()) for name in ("seq", "vocab") if order]
    )

    def lists(values, offsets, kind):
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0

        def shard(ids, texts, marks, sizes):
            code: dict = defaultdict()
            code.default_factory = code.__len__
            tokens, lens = [], []
            n = len(texts)
            for i in range(n):
                own = words_of(texts[i])
                texts[i] = None  # the text is not needed any more
                own.append(END)
                lens.append(len(own))
                tokens.append(np.fromiter(map(code.__getitem__, own), np.int32, len(own)))
            lens = np.asarray(lens, np.int64)
            key = np.empty(lens.sum(), np.int64)
            at = 0
            for i, own in enumerate(tokens):
                key[at : at + len(own)] = own
                key[at : at + len(own)] *= n
                key[at : at + len(own)] += i
                at += len(own)
            seq = planes(np.concatenate(tokens)) if order else None
            del tokens
            key.sort()
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            tf = np.diff(np.r_[first, len(key)])
            key = key[first]
            term, doc = key // n, key % n
            del key, first
            starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
            offsets = np.r_[starts, len(term)]
            places = np.r_[0, np.cumsum(tf > 1)]
            several = places[offsets]
            if compact:  # of each word, documents that hold it more than once stand first
                at = np.arange(len(term)) - places[:-1] + np.repeat(several[1:], np.diff(offsets))
                many = np.flatnonzero(tf > 1)
                at[many] = places[many] + np.repeat(starts - several[:-1], np.diff(several))
                doc[at], tf[at] = doc.copy(), tf.copy()
                del at, many
            del places
            counts = tf[tf > 1]
            if not compact:
                records = np.empty(len(doc), RECORD)
                records["doc"], records["tf"], records["len"] = doc, tf, lens[doc]
            sums = np.zeros((len(starts), groups), np.int64)
            if groups:
                mark = marks[doc]
                own = mark >= 0
                sums = np.bincount(term[own] * groups + mark[own], tf[own], sums.size).astype(np.int64).reshape(sums.shape)
            end, words = code[END], list(code)
            code.clear()
            at = np.zeros(len(starts) + 1, np.int64)
            at[end + 1 :] = n
            for a, b in _cuts(len(words), end if compact else -1):
                lo, hi = offsets[a], offsets[b]
                held = a <= end < b  # the row of the empty word is among these
                own_ids, own_marks, own_lens, own_sizes = (ids, marks, lens, sizes) if held else (ids.slice(0, 0), marks[:0], lens[:0], sizes[:0])
                once = at[a : b + 1] - at[a]
                if compact:
                    packed = pa.nulls(b - a, pa.binary())
                    own_docs = lists(doc[lo:hi], offsets[a : b + 1] - lo, pa.int16())
                    own_tfs = lists(counts[several[a] : several[b]], several[a : b + 1] - several[a], pa.int32())
                else:
                    places = np.ascontiguousarray((offsets[a : b + 1] - lo) * RECORD.itemsize, np.int32)
                    packed = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(places), pa.py_buffer(pack(records[lo:hi], offsets[a : b + 1] - lo))])
                    own_docs = lists(np.arange(n if held else 0), once, pa.int16())
                    own_tfs = lists(counts[:0], once * 0, pa.int32())
                end_only = [
                    lists(own_lens, once, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(once, pa.int32()), own_ids),
                    lists(own_marks, once, pa.int32()),
                    lists(own_sizes, once, pa.int32()),
                ]
                if compact and not held:  # null costs less than an empty list in every row
                    end_only = [pa.nulls(b - a, x.type) for x in end_only]
                cols = [
                    pa.array(np.full(b - a, part << 32 | number, np.int64)),
                    pa.array(words[a:b], pa.binary()),
                    packed,
                    own_docs,
                    own_tfs,
                    end_only[0],
                    lists(sums[a:b].ravel(), np.arange(b - a + 1) * groups, pa.int64()),
                    *end_only[1:],
                ]
                if order:
                    for value in (seq, b" ".join(words)):
                        cols.append(pa.array([value if j == end else None for j in range(a, b)], pa.binary()) if held else pa.nulls(b - a, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])

        ids, texts, marks, sizes, size = [], [], [], [], 0

        def flush():
            nonlocal ids, texts, marks, sizes, size, number
            if texts:
                yield from shard(pa.concat_arrays(ids), texts, np.asarray(marks, np.int64), np.asarray(sizes, np.int64))
                ids, texts, marks, sizes, size, number = [], [], [], [], 0, number + 1

        for batch in batches:
            own = batch.column(0).take(pa.array(np.arange(batch.num_rows)))  # a copy, which does not hold the batch's texts
            for i, (t, g) in enumerate(zip(batch.column(1), batch.column(2).to_pylist())):
                ids.append(own.slice(i, 1))
                texts.append(t.as_py())
                marks.append(g)
                sizes.append(t.as_buffer().size if t.is_valid else 0)
                size += len(texts[-1] or "")
                if len(texts) >= DOCS or size >= CHARS:
                    yield from flush()
        yield from flush()

    mark = F.lit(-1) if group is None else group
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), mark.cast("int").alias("_g")).mapInArrow(run, schema)


def members(index: DataFrame) -> DataFrame:
    """(shard, doc, id, len, mark, size): the documents of every shard."""
    rows = index.where(F.col("term") == F.lit(END)).select("shard", F.explode(F.arrays_zip("docs", "ids", "lens", "marks", "sizes")).alias("d"))
    return rows.select("shard", F.col("d.docs").alias("doc"), F.col("d.ids").alias("id"), F.col("d.lens").alias("len"), F.col("d.marks").alias("mark"), F.col("d.sizes").alias("size"))


def shards(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(shard, terms, held, docs, tfs, lens, ids), one row per shard: its words in
    ascending order, how many postings each has, then all postings one list after
    another (documents as 2 bytes, counts as 4), and per document its length, end
    mark included, and its id.  Documents of a shard that have the same most
    frequent word (of the shard's first words, so mostly function words) stand
    together: this gathers languages in blocks, which bounds per block live on.
    Nothing is shuffled: a task writes its own shards."""
    ints = ArrayType(IntegerType())
    schema = StructType(
        [StructField("shard", LongType()), StructField("terms", ArrayType(BinaryType())), StructField("held", ints)]
        + [StructField("docs", BinaryType()), StructField("tfs", BinaryType()), StructField("lens", ints)]
        + [StructField("ids", ArrayType(docs.schema[id_col].dataType))]
    )

    def row(number: int, ids: pa.Array, texts: list) -> pa.RecordBatch:
        code: dict = defaultdict()
        code.default_factory = code.__len__
        tokens, n = [], len(texts)
        for i in range(n):
            own = words_of(texts[i])
            texts[i] = None  # the text is not needed any more
            tokens.append(np.fromiter(map(code.__getitem__, own), np.int32, len(own)))
        top = [np.bincount(t[t < FIRST], minlength=1).argmax() for t in tokens]
        order = np.argsort(np.asarray(top), kind="stable")
        tokens, ids = [tokens[i] for i in order], ids.take(pa.array(order))
        words = sorted(code)
        place = np.empty(len(words), np.int64)
        place[[code[w] for w in words]] = np.arange(len(words))
        code.clear()
        lens = np.array([len(t) for t in tokens], np.int32)
        key = place[np.concatenate(tokens)] * n if lens.sum() else np.zeros(0, np.int64)
        del tokens
        key += np.repeat(np.arange(n), lens)
        key.sort()
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        tf = np.diff(np.r_[first, len(key)])
        key = key[first]
        held = np.bincount(key // n, minlength=len(words)) if n else np.zeros(0)
        whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        cols = [
            pa.array([number], pa.int64()),
            whole(pa.array(words, pa.binary())),
            whole(pa.array(held, pa.int32())),
            pa.array([(key % n).astype(np.uint16).tobytes()], pa.binary()),
            pa.array([tf.astype(np.uint32).tobytes()], pa.binary()),
            whole(pa.array(lens + 1, pa.int32())),
            whole(ids),
        ]
        return pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId() << 32, 0
        ids, texts, size = [], [], 0
        for batch in batches:
            own = batch.column(0).take(pa.array(np.arange(batch.num_rows)))  # a copy, which does not hold the batch's texts
            for i, t in enumerate(batch.column(1)):
                ids.append(own.slice(i, 1))
                texts.append(t.as_py())
                size += len(texts[-1] or "")
                if len(texts) >= DOCS or size >= CHARS:
                    yield row(part | number, pa.concat_arrays(ids), texts)
                    ids, texts, size, number = [], [], 0, number + 1
        if texts:
            yield row(part | number, pa.concat_arrays(ids), texts)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).mapInArrow(run, schema)
