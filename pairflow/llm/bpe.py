"""Byte-level BPE over whole columns of text, and its inverse.

A text is split by the tokenizer's pattern; distinct matches are encoded
together.  Matches of like length form a padded matrix of token ids.  Each
round every row merges its leftmost pair of least rank, closes the gap, and
looks up the two pairs that changed in a hash table of all mergeable pairs;
finished rows leave the matrix.  Matches of over ``LONG`` bytes, whose rounds
would cost the square of their length, take the same merges from a heap.

Ids travel packed, as little-endian unsigned 32-bit integers in one binary
value.  Defined results: null is encoded as the empty text; empty gives no
ids; repeated rows each get their row; an id that the vocabulary lacks raises.
"""

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from pairflow.llm.base import per_process, slices, strings

LONG = 192
NONE = np.int64(1 << 40)
SLICE = 500_000  # characters encoded at once
CACHE = 200_000
CACHE_BYTES = 16_000_000
WIDTHS = (2, 4, 6, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, LONG)


def read_ranks(path: str) -> dict:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Ranks:
    """A rank file: tokens, the ids of single bytes, and the pair table."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.tokens = {r: t for t, r in ranks.items()}
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte < 0).any():
            raise ValueError("the ranks lack single bytes")
        pairs = {}
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        self.pairs = pairs
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        keys, values = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64)
        at = self.slot(keys)
        while len(keys):  # all that find a free slot take it, one for each slot; the rest go one further
            free = self.keys[at] < 0
            _, first = np.unique(at[free], return_index=True)
            chosen = np.flatnonzero(free)[first]
            self.keys[at[chosen]], self.values[at[chosen]] = keys[chosen], values[chosen]
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NONE if it can't merge (padding is -1)."""
        keys = np.where((a < 0) | (b < 0), -2, (a << 32) | b)
        at = self.slot(keys)
        got = self.keys[at]
        out = np.where(got == keys, self.values[at], NONE)
        open_ = np.flatnonzero((got != keys) & (got >= 0) & (keys >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            got = self.keys[at[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (got >= 0)]
        return out

    def rows(self, words: list, width: int) -> list:
        """Packed ids of each of ``words``, none longer than ``width`` bytes."""
        n = np.array([len(w) for w in words])
        ids = np.full((len(words), width + 1), -1, np.int64)
        mask = np.arange(width + 1) < n[:, None]
        ids[mask] = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        rank = self.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), width)
        out: list = [None] * len(words)
        who = np.arange(len(words))
        cols = np.arange(width + 1)
        while len(who):
            j = rank.argmin(axis=1)
            least = rank[np.arange(len(who)), j]
            done = least >= NONE
            if done.any():
                kept = ids[done]
                packed = kept.astype("<u4")
                size = (kept >= 0).sum(axis=1)
                for k, row, m in zip(who[done].tolist(), packed, size.tolist()):
                    out[k] = row[:m].tobytes()
                go = ~done
                ids, rank, who, j, least = ids[go], rank[go], who[go], j[go], least[go]
                if not len(who):
                    break
            r = np.arange(len(who))
            ids[r, j] = least
            after = np.minimum(cols + (cols > j[:, None]), width)  # close the gap behind the merged pair
            tail = np.take_along_axis(ids, after, axis=1)
            tail[:, -1] = -1
            ids = tail
            rank = np.take_along_axis(rank, after[:, :-1].clip(max=width - 1), axis=1)
            rank[:, -1] = NONE
            before = np.maximum(j - 1, 0)
            left = self.find(ids[r, before], ids[r, before + 1])
            rank[r, before] = np.where(j > 0, left, rank[r, before])
            has = j + 1 <= width
            rank[r[has], j[has]] = self.find(ids[r[has], j[has]], ids[r[has], j[has] + 1])
        return out

    def long(self, word: bytes) -> bytes:
        """The same merges for a very long match: a linked list and a heap."""
        ids = self.byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        get = self.pairs.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = nxt[i] if alive[i] else n
            if k >= n or ids[i] != a or ids[k] != b:
                continue
            ids[i], alive[k] = r, False
            nxt[i] = nxt[k]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (q := get(r << 32 | ids[nxt[i]])) is not None:
                    heapq.heappush(heap, (q, i, r, ids[nxt[i]]))
            if prv[i] >= 0 and (q := get(ids[prv[i]] << 32 | r)) is not None:
                heapq.heappush(heap, (q, prv[i], ids[prv[i]], r))
        return np.array([x for x, y in zip(ids, alive) if y], "<u4").tobytes()

    def encode_words(self, words: list) -> dict:
        out = {w: self.long(w) for w in words if len(w) > LONG}
        low = 0
        for width in WIDTHS:
            bucket = [w for w in words if low < len(w) <= width]
            step = max(1, 400_000 // width)
            for a in range(0, len(bucket), step):
                part = bucket[a : a + step]
                out.update(zip(part, self.rows(part, width)))
            low = width
        return out


class Encoder:
    """Encodes texts one after another; matches met before come from a cache of
    at most ``CACHE`` matches and ``CACHE_BYTES`` bytes, which only saves time."""

    def __init__(self, path: str, pattern: str):
        self.ranks = per_process(("bpe", path), lambda: Ranks(path))
        self.split = regex.compile(pattern).findall
        self.known: dict = {}
        self.held = 0

    def __call__(self, texts: list) -> list:
        """Packed ids of each of ``texts``."""
        out = []
        for a, b in slices(texts, SLICE):
            words = [self.split(t) for t in texts[a:b]]
            if len(self.known) > CACHE or self.held > CACHE_BYTES:
                self.known, self.held = {}, 0
            known = self.known
            new = list({w for doc in words for w in doc if w not in known})
            raw = [w.encode("utf-8", "replace") for w in new]
            ids = self.ranks.encode_words(raw)
            known.update((w, ids[r]) for w, r in zip(new, raw))
            self.held += sum(len(r) + len(i) for r, i in ids.items())
            out += [b"".join(map(known.__getitem__, doc)) for doc in words]
        return out


def decoded(tokens: dict, ids) -> bytes:
    """The bytes of one value of packed ids."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def encode(text: Column, path: str, pattern: str) -> Column:
    """Packed ids of each text, without special tokens."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(path, pattern)
        for series in batches:
            yield pd.Series(encoder(strings(series)), dtype=object)

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes that packed ids stand for."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = per_process(("bpe tokens", path), lambda: {r: t for t, r in read_ranks(path).items()})
        for series in batches:
            yield pd.Series([decoded(tokens, x) for x in series], dtype=object)

    return run(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """(ids, decoded) of each text: ``encode``, then ``decode`` of its ids, by
    one worker process with one table of ranks instead of two."""

    @F.pandas_udf("ids binary, decoded binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path, pattern)
        tokens = encoder.ranks.tokens
        for series in batches:
            texts = strings(series)
            del series
            for a, b in slices(texts, 4 * SLICE):
                ids = encoder(texts[a:b])
                yield pd.DataFrame({"ids": ids, "decoded": [decoded(tokens, x) for x in ids]}, dtype=object)

    return run(text)
