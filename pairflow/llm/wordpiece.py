"""Token counts: greedy longest-match word pieces, counted in linear time.

A trie of the vocabulary gets failure links in the manner of a matching
automaton.  When no edge continues, the failure link of a node gives the node
that stands for what is left after the longest pieces have been popped, and a
precomputed number says how many pieces those were.  A word is thus counted in
one pass over its bytes; no piece is ever built.

Defined results: a null or empty text has no words and no pieces; a word that
the vocabulary can't spell is one piece and one unknown; repeated rows each get
their row; an empty table gives an empty result.
"""

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairflow.llm.base import per_process, strings

CACHE_WORDS = 500_000  # memory bound of a worker's word cache; it only saves time


class Automaton:
    """``first``: pieces that may begin a word; ``rest``: pieces that may go on.

    Nodes 0 and 1 are the roots of the two sets.  ``fail[v]``: the node left
    after popping, -1 if the string at v can't be spelled; ``pops[v]``: pieces
    popped on the way.
    """

    def __init__(self, first, rest):
        self.next, final = [{}, {}], [False, False]
        for root, pieces in ((0, first), (1, rest)):
            for piece in pieces:
                v = root
                for b in piece:
                    w = self.next[v].get(b)
                    if w is None:
                        w = self.next[v][b] = len(self.next)
                        self.next.append({})
                        final.append(False)
                    v = w
                final[v] = final[v] or v > 1
        self.fail, self.pops = [-1] * len(final), [0] * len(final)
        queue = deque([0, 1])
        while queue:
            v = queue.popleft()
            for b, w in self.next[v].items():
                if final[w]:
                    self.fail[w], self.pops[w] = 1, 1
                else:
                    z, n = self.fail[v], self.pops[v]
                    while z >= 0 and b not in self.next[z]:
                        n += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[w], self.pops[w] = self.next[z][b], n
                queue.append(w)

    def count(self, word: bytes) -> int:
        """Pieces of ``word``; -1 if it can't be spelled."""
        nxt, fail, pops = self.next, self.fail, self.pops
        v = n = 0
        for b in word:
            while b not in nxt[v]:
                n += pops[v]
                v = fail[v]
                if v < 0:
                    return -1
            v = nxt[v][b]
        while v > 1:  # the end matches no edge
            n += pops[v]
            v = fail[v]
            if v < 0:
                return -1
        return n if v == 1 else 0


def read_pieces(path: str):
    """Byte pieces of a rank file: those that begin with a space begin a word."""
    import base64

    with open(path, "rb") as f:
        pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    return [p for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1] != b" "]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_pieces, n_unknown, n_bytes.

    Words are what stands between ASCII white space in the lower-cased text
    (A-Z only); each is matched as a space and its UTF-8 bytes.  ``path`` is a
    rank file that every worker can read.
    """

    @F.pandas_udf("n_words long, n_pieces long, n_unknown long, n_bytes long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = per_process(("wordpiece", path), lambda: Automaton(*read_pieces(path)))
        known: dict = {}
        for texts in batches:
            rows = []
            for text in strings(texts):
                raw = text.encode("utf-8", "replace")
                words = raw.lower().split()
                pieces = unknown = 0
                for w in words:
                    n = known.get(w)
                    if n is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        n = known[w] = automaton.count(b" " + w)
                    if n < 0:
                        unknown += 1
                        pieces += 1
                    else:
                        pieces += n
                rows.append((len(words), pieces, unknown, len(raw)))
            yield pd.DataFrame(rows, columns=["n_words", "n_pieces", "n_unknown", "n_bytes"])

    return docs.select(F.col(id_col).alias("_id"), count(F.col(text_col)).alias("_c")).select(
        F.col("_id").alias(id_col), "_c.*"
    )
