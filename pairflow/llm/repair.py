"""Conversation repair: the cheapest edits that make turns alternate, by
Hirschberg's divide and conquer.

A repaired conversation is empty or an optional system turn followed by pairs
of a user and an assistant turn.  That is an automaton of four states (start,
after system, after user, after assistant); an edit of a turn or an insertion
moves between them at a cost:

    K keep            0          D delete   4 (blank and duplicate turns: always)
    R change role     3          I insert   3 (an empty turn, anywhere)
    a truncated turn that isn't deleted costs 3 more

The audit is the edits' letters in order: of the cheapest audits the least in
ASCII order.  Costs of the four states run forward from a stretch's start and
backward from its end; they meet in the middle, and the best crossing there
splits the stretch in two.  Forward vectors also rank the four states' least
audits against each other.  Audits of equally many turns that end in a turn's
edit are never prefixes of one another, so of several optimal crossings the one
with the least rank is the audit-least.  A stretch of one turn has its letters
in a table.  Memory is a byte per turn, and letters.

Turns are read twice, each time as a stream in the order of (turn, digest),
null turns first: without texts, to find the audits, and with them, to apply
these.  The first occurrence of a role and text comes from an aggregate, not
from a set in memory, so a conversation that holds a third of all rows takes one
task's time (its audit is one string, its hash one sequence) but no memory
beyond its audit.

Defined results: nulls in role and text are one space; a null conversation is
one of its own; turns with equal number come by digest, copies adjacent; a role
that isn't system, user or assistant by its first letter can't be kept; an
empty or very long text is a text like any other; a conversation without turns
has an empty audit and repair; an empty table gives no rows.  Only the named
columns are read.
"""

import hashlib
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairflow.operators.streams import cogroup_stream, group_stream

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # what an insertion or a change of role makes
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"  # any other is number 3
DELETE_ONLY = 8  # class of a turn that must go; else 2 * initial + truncated
CHANGE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
TAIL = ((0, ""), (6, "II"), (3, "I"), (0, ""))  # from a state after the last turn to an accepting one
LEGAL = {(0, 1), (1, 2), (2, 1)}


def _steps(kind: int) -> list:
    """(from, to, cost, letters) of a turn's class: the best way from state to
    state with the insertions before it."""
    best: dict = {}
    for q in range(4):
        p, cost, letters = q, 0, ""
        for _ in range(3):
            ways = [(p, DELETE, "D")]
            if kind != DELETE_ONLY:
                initial, more = kind >> 1, TRUNCATED * (kind & 1)
                kept = {(0, START): SYSTEM, (1, START): USER, (1, SYSTEM): USER, (1, ASSISTANT): USER, (2, USER): ASSISTANT}
                if (initial, p) in kept:
                    ways.append((kept[initial, p], more, "K"))
                ways.append((NEXT[p], CHANGE + more, "R"))
            for to, c, letter in ways:
                way = (cost + c, letters + letter)
                best[q, to] = min(best.get((q, to), way), way)
            p, cost, letters = NEXT[p], cost + INSERT, letters + "I"
    return [(q, to, *way) for (q, to), way in best.items()]


STEPS = [_steps(kind) for kind in range(9)]
LETTERS = [{(q, to): letters for q, to, _, letters in steps} for steps in STEPS]
INF = 1 << 60


@lru_cache(maxsize=65_536)
def _ahead(costs: tuple, ranks: tuple, kind: int) -> tuple:
    """Costs (least one taken out) and ranks after a turn; few vectors occur."""
    best: dict = {}
    for q, to, c, letters in STEPS[kind]:
        if costs[q] < INF:
            way = (costs[q] + c, ranks[q], letters)
            best[to] = min(best.get(to, way), way)
    least = min(w[0] for w in best.values())
    order = sorted(best, key=lambda to: best[to][1:])
    ranks = tuple(order.index(to) if to in best else 4 for to in range(4))
    return tuple(best[to][0] - least if to in best else INF for to in range(4)), ranks, least


@lru_cache(maxsize=65_536)
def _behind(costs: tuple, kind: int) -> tuple:
    best = [INF] * 4
    for q, to, c, _ in STEPS[kind]:
        best[q] = min(best[q], costs[to] + c)
    least = min(best)
    return tuple(b - least if b < INF else INF for b in best)


def forward(kinds: bytes, a: int, b: int, start: int) -> tuple:
    """Costs over their least, ranks and that least after turns a to b."""
    costs, ranks, base = tuple(0 if q == start else INF for q in range(4)), (0, 0, 0, 0), 0
    for i in range(a, b):
        costs, ranks, more = _ahead(costs, ranks, kinds[i])
        base += more
    return costs, ranks, base


def backward(kinds: bytes, a: int, b: int, end: int) -> tuple:
    """Costs from each state before turn a to ``end`` after turn b, over their least."""
    costs = tuple(0 if q == end else INF for q in range(4))
    for i in range(b - 1, a - 1, -1):
        costs = _behind(costs, kinds[i])
    return costs


def best_audit(kinds: bytes) -> tuple:
    """(cost, audit) of a conversation's turn classes."""
    if not kinds:
        return 0, ""
    costs, ranks, base = forward(kinds, 0, len(kinds), START)
    total, _, final = min((costs[q] + TAIL[q][0], ranks[q], q) for q in range(4) if costs[q] < INF)
    out, stack = [], [(0, len(kinds), START, final)]
    while stack:  # stretches, the leftmost on top
        a, b, start, end = stack.pop()
        if b - a == 1:
            out.append(LETTERS[kinds[a]][start, end])
            continue
        mid = (a + b) // 2
        ahead, ranks, _ = forward(kinds, a, mid, start)
        behind = backward(kinds, mid, b, end)
        _, _, q = min((ahead[q] + behind[q], ranks[q], q) for q in range(4) if ahead[q] < INF and behind[q] < INF)
        stack += [(mid, b, q, end), (a, mid, start, q)]
    return base + total, "".join(out) + TAIL[final][1]


def edited(audit: str, turns):
    """Apply an audit to (role, text) turns: the repaired ones, one by one."""
    state = START
    turns = iter(turns)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield ROLE[state], ""
            continue
        role, text = next(turns)
        if letter == "K":
            state = 1 + INITIALS.index(role[0])
            yield role, text
        elif letter == "R":
            state = NEXT[state]
            yield ROLE[state], text


def turns_of(df: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """(conv, turn, role, text, present, digest) without nulls in role and text."""
    clean = [F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), *clean, (F.col(present) if present else F.lit(True)).alias("present"))
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)))


SPACE = r"\x20\x09-\x0D"
STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _examined(key: tuple, batches):
    """One conversation's turns, without texts: its counts, cost and audit."""
    kinds, low, high, distinct = bytearray(), None, None, 0
    faults, illegal, before, last = [0, 0, 0], 0, None, None
    for batch in batches:
        for turn, digest, initial, blank, open_, later, present in zip(*[c.to_pylist() for c in batch.columns]):
            if not present:
                continue
            fault = 1 if blank else 2 if later or (turn, digest) == before else 3 if open_ else 0
            if fault:
                faults[fault - 1] += 1
            kinds.append(DELETE_ONLY if fault in (1, 2) else 2 * initial + (fault == 3))
            if turn is not None:
                distinct += turn != high
                low, high = turn if low is None else low, turn
            if last is not None and (last, initial) not in LEGAL:
                illegal += 1
            before, last = (turn, digest), initial
    cost, audit = best_audit(bytes(kinds))
    yield key[0], 0 if low is None else high - low + 1 - distinct, *faults, illegal, cost, audit


def audits(turns: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every
    conversation of ``turns_of``; rows that aren't present only name theirs."""
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    place = F.struct(F.col("turn").isNotNull(), "turn")
    small = turns.select(
        "conv",
        "turn",
        "digest",
        number.alias("initial"),
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("open"),
        place.alias("place"),
        "present",
    )
    first = small.where("present").groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.min("place").alias("first"))
    small = small.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    small = small.withColumn("later", F.coalesce(F.col("place") > F.col("first"), F.lit(False)))
    kind = turns.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, {', '.join(f'{c} long' for c in STATS)}, audit string"
    return group_stream(small, "conv", ["turn", "digest", "initial", "blank", "open", "later", "present"], _examined, schema, order=["turn", "digest"])


def _texts(batches):
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def _applied(turns: DataFrame, found: DataFrame, fn, schema: str) -> DataFrame:
    held = [c for c in found.columns if c != "conv"]
    rows = turns.where("present")
    return cogroup_stream(found, rows, "conv", held, ["role", "text", "turn", "digest"], fn, schema, order=["turn", "digest"])


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, at, role, text): the turns of the repaired conversations."""

    def fn(key: tuple, held: list, batches):
        for at, (role, text) in enumerate(edited(held[0], _texts(batches))):
            yield key[0], at, role, text

    kind = turns.schema["conv"].dataType.simpleString()
    return _applied(turns, found.select("conv", "audit"), fn, f"conv {kind}, at long, role string, text string")


def digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with the SHA-256 of each repaired conversation, its turns as
    ``role:text`` lines; turns pass one by one."""

    def fn(key: tuple, held: list, batches):
        stats = held[0]
        h, between = hashlib.sha256(), b""
        for role, text in edited(stats[-1], _texts(batches)):
            h.update(between + f"{role}:{text}".encode())
            between = b"\n"
        yield (key[0], *stats, h.hexdigest())

    kind = turns.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, {', '.join(f'{c} long' for c in STATS)}, audit string, repaired_sha256 string"
    return _applied(turns, found.select("conv", *STATS, "audit"), fn, schema)


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, present): rows with faults drawn from a checksum
    of conversation and turn; dropped rows stay, not present."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), name(role).alias("role"), name(text).alias("text"), (F.crc32(F.concat(name(conv), F.lit(":"), name(turn))) % 20).alias("k"))
    text_ = F.when(F.col("k") == 1, F.lit("")).when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv", "turn", F.when(F.col("k") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text_.alias("text"), "k")
    copies = F.array_repeat(F.col("k") != 0, F.when(F.col("k") == 3, 2).otherwise(1))
    return rows.select("conv", "turn", "role", "text", F.explode(copies).alias("present"))
