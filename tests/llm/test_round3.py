"""Conversation repair, fill-in-the-middle and sharding against brute force and on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairflow.llm import fim, repair, sharding
from pairflow.llm.base import documents
from pairflow.llm.queries import op11_conversation_repair, op12_fill_in_middle, op13_sharding
from pairflow.sources import rows_to_df

SMALL = "/root/testdata/sf0.001"
ACCEPTED = re.compile(r"(s?(ua)+)?")


# ---------------------------------------------------------------- conversation repair


def all_edits(turns):
    """(cost, audit, repaired) of every edit script with at most two insertions in a row."""
    inserts = [p for n in range(3) for p in itertools.product(("user", "assistant"), repeat=n)]

    def ways(turn):
        role, text, fault = turn
        yield 4, "D", []
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            yield more, "K", [(role, text)]
            for r in ("user", "assistant"):
                yield 3 + more, "R", [(r, text)]

    slots = [[(3 * len(p), "I" * len(p), [(r, "") for r in p]) for p in inserts]]
    for turn in turns:
        slots += [list(ways(turn)), slots[0]]
    for script in itertools.product(*slots):
        rows = [r for _, _, out in script for r in out]
        if ACCEPTED.fullmatch("".join(r[0] for r, _ in rows)):
            yield sum(c for c, _, _ in script), "".join(a for _, a, _ in script), rows


def examined(rows):
    """Faults of (role, text) rows in order, by the contract."""
    seen, out = set(), []
    for role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def kinds_of(turns):
    numbers = {"s": 0, "u": 1, "a": 2}
    return bytes(repair.DELETE_ONLY if f in ("blank", "duplicate") else 2 * numbers.get(r[:1], 3) + (f == "truncated") for r, _, f in turns)


def test_best_audit_is_the_least_of_all_edit_scripts():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["Hi.", "Well?", "So it", " \n", "And"])) for _ in range(rng.randint(0, 3))]
        turns = examined(rows)
        cost, audit, out = min(all_edits(turns), key=lambda x: x[:2])
        assert repair.best_audit(kinds_of(turns)) == (cost, audit), rows
        assert list(repair.edited(audit, rows)) == out


def whole_table(kinds):
    """The same by a table of (cost, audit) per state and turn, audits and all."""
    best = {repair.START: (0, "")}
    for k in kinds:
        after: dict = {}
        for q, to, c, letters in repair.STEPS[k]:
            if q in best:
                way = (best[q][0] + c, best[q][1] + letters)
                after[to] = min(after.get(to, way), way)
        best = after
    return min((c + repair.TAIL[q][0], a + repair.TAIL[q][1]) for q, (c, a) in best.items())


def test_long_conversations_equal_the_whole_table():
    rng = random.Random(6)
    for n in [1, 2, 7, 64, 401]:
        for _ in range(20):
            kinds = bytes(rng.choice([0, 2, 2, 2, 3, 4, 4, 4, 5, 6, 8]) for _ in range(n))
            assert repair.best_audit(kinds) == whole_table(kinds)


def by_hand(rows):
    """The contract's answer for the (turn, role, text) rows of one conversation after damage, in order."""
    turns = examined([(r, t) for _, r, t in rows])
    cost, audit = whole_table(kinds_of(turns))
    numbers = [t for t, _, _ in rows if t is not None]
    roles = [r[:1] for _, r, _ in rows]
    counts = Counter(f for _, _, f in turns)
    fixed = "\n".join(f"{r}:{t}" for r, t in repair.edited(audit, [(r, t) for _, r, t in rows]))
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        counts["blank"],
        counts["duplicate"],
        counts["truncated"],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
        cost,
        audit,
        hashlib.sha256(fixed.encode()).hexdigest(),
    )


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def digest_order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest())


def answers(rows):
    hurt = damage(rows)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted([r[1:] for r in hurt if r[0] == conv], key=digest_order)
        out[conv] = by_hand(own)
    return out


def repaired_by_spark(df):
    turns = repair.turns_of(repair.damaged(df), "conv", "turn", "role", "text", "present")
    return {r[0]: tuple(r)[1:] for r in repair.digests(turns, repair.audits(turns)).collect()}


def test_op11_equals_brute_force(spark):
    got = {r[0]: tuple(r)[1:] for r in op11_conversation_repair(spark, SMALL).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == answers(rows) and len(got) == len({r[0] for r in rows})
    assert len({a[6] for a in got.values()}) > 5


def test_op11_on_awkward_rows(spark):
    rows = [
        (None, 1, "user", "a?"), (None, 2, "assistant", "b."), (None, None, None, None),
        (1, None, "user", "x."), (1, None, "user", "x."), (1, 3, "assistant", "y" * 300_000 + "."),
        (2, 5, "", ""), (2, 5, "System", "q."), (2, 9, "user", "\x0b\t"), (3, 4, "user", "same."), (3, 4, "user", "same."), (3, 4, "user", "same."),
        *[(4, t, ["user", "assistant"][t % 2], f"{t % 7}.") for t in range(200)],
    ]
    df = rows_to_df(spark, rows, "conv_id long, turn long, role string, text string").withColumn("digest", F.lit(1)).repartition(3)
    assert repaired_by_spark(df) == answers(rows)
    assert repaired_by_spark(df.limit(0)) == {}


def test_op11_conversation_whose_rows_are_all_dropped(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = rows_to_df(spark, [(conv, 0, "user", "a.")], "conv_id long, turn long, role string, text string")
    assert repaired_by_spark(df) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_turns_alternate(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    turns = repair.turns_of(repair.damaged(df), "conv", "turn", "role", "text", "present")
    fixed = repair.repaired(turns, repair.audits(turns))
    for r in fixed.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("at", F.substring("role", 1, 1).alias("i")))).alias("x")).collect():
        assert ACCEPTED.fullmatch("".join(x["i"] for x in r["x"]))


# ---------------------------------------------------------------- fill in the middle


def fim_by_hand(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    plain = not text or any(x in text for x in ("<P>", "<S>", "<M>"))
    form = "plain" if plain else "spm" if h4 % 100 < 50 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, n, form, None if plain else len(p), None if plain else len(m), sha(out), sha(text))


def test_op12_equals_brute_force(spark):
    got = sorted(tuple(r) for r in op12_fill_in_middle(spark, SMALL).collect())
    want = sorted(fim_by_hand(r.doc_id, r.text) for r in documents(spark, SMALL).collect())
    assert got == want


def test_op12_on_awkward_rows(spark):
    texts = [None, "", "\n", "\n\n\n", "a", "a\n", "<M>\nx\n", "ü\n<\nP>é", "<\nS>x\n<", "x" * 2_200_000 + "\n" + "y\n" * 90_000, "\U0001f600\nß\n" * 5000, "\r\n a\r\n"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a\nb\nc"), (3, "\n\n\n")]
    df = rows_to_df(spark, rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("form", F.lit("x"))
    out = fim.transform(df)
    got = out.select("id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256), F.sha2(fim.restored(F.col("output"), F.col("form")), 256))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((fim_by_hand(*r) for r in rows), key=repr)
    assert fim.transform(df.limit(0)).count() == 0


def test_chunks_follow_content_and_strips_change_nothing(monkeypatch):
    rng = random.Random(3)
    passage = "".join(rng.choice("abc def\n") for _ in range(20_000)).encode()
    parts = []
    for lead in (b"", b"some other words before", bytes(rng.randrange(256) for _ in range(5000))):
        data = lead + passage
        ends = fim.chunks(fim.np.frombuffer(data, fim.np.uint8))
        assert ends[-1] == len(data) and all(b - a <= fim.MOST for a, b in zip([0, *ends], ends))
        parts.append({data[a:b] for a, b in zip([0, *ends], ends)})
    shared = parts[0] & parts[1] & parts[2]
    assert sum(map(len, shared)) > 0.8 * len(passage)
    whole = fim.chunks(fim.np.frombuffer(passage, fim.np.uint8))
    monkeypatch.setattr(fim, "STRIP", 777)
    assert fim.chunks(fim.np.frombuffer(passage, fim.np.uint8)) == whole
    slow = [sum(int(fim.GEAR[passage[i - j]]) << j for j in range(min(i + 1, 32))) % 2**32 for i in range(200)]
    assert fim.rolling(fim.np.frombuffer(passage[:200], fim.np.uint8)).tolist() == slow


def test_memo_hits_on_copies_and_stays_within_its_bytes():
    memo = fim.Memo(most=50_000)
    text = "".join(random.Random(1).choice("ab\n ") for _ in range(20_000))
    first = fim.borders(text, memo)
    misses = memo.misses
    again = fim.borders(text, memo)
    assert memo.misses == misses and memo.hits >= misses and first[0] == again[0]
    for i in range(20):
        fim.borders(f"{i}" * 3 + text[i * 97 :][::-1], memo)
        assert memo.size <= 50_000 + 2 * fim.MOST + 200


# ---------------------------------------------------------------- sharding


def assert_law(rows, n, shards):
    assert len(rows) == n
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(shards)) and max(sizes.values(), default=0) - min([sizes[s] for s in range(shards)]) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


@pytest.mark.parametrize("bucket", [sharding.BUCKET, 3000])
def test_shards_keep_the_law_of_rows(spark, bucket):
    docs = documents(spark, SMALL)
    rows = sharding.assign(docs, bucket=bucket).collect()
    assert_law(rows, docs.count(), 24)
    want = {r.doc_id: (len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()}
    assert {r.id: (r.size, r.crc) for r in rows} == want


def test_op13_is_whole_seeded_and_shuffled(spark):
    a = sorted(map(tuple, op13_sharding(spark, SMALL).collect()))
    assert a == sorted(map(tuple, op13_sharding(spark, SMALL).collect()))
    docs = documents(spark, SMALL)
    other = sorted((r.id, r.shard, r.slot) for r in sharding.assign(docs, seed=7).collect())
    assert other != [(r[0], r[4], r[5]) for r in a]
    order = [r[0] for r in sorted(a, key=lambda r: (r[5], r[4]))]
    rises = sum(x < y for x, y in zip(order, order[1:])) / len(order)
    assert 0.4 < rises < 0.6 and {r[3] for r in a} == {"rows"} and {r[6] for r in a} == {None}


def test_hot_ids_and_copies_fill_no_bucket(spark):
    df = spark.range(0, 6000, 1, 6).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").alias("text"))
    shuffled = sharding.shuffled(df, bucket=6000 * sharding.ROW // 12)
    sizes = sorted(r["count"] for r in shuffled.groupBy("bucket").count().collect())
    assert sum(sizes) == 6000 and len(sizes) >= 10 and sizes[-1] < 1500
    assert_law(sharding.assign(df, shards=7).collect(), 6000, 7)


def test_sharding_on_awkward_rows_and_written_shards(spark, tmp_path):
    rows = [(None, None, 1), (None, None, 1), (1, "", 2), (1, "", 2), (2, "x" * 2_000_000, 3), (3, "ü", 4)]
    df = rows_to_df(spark, rows, "doc_id long, text string, bucket int").withColumn("slot", F.lit("own"))
    assert_law(sharding.assign(df, shards=4).collect(), 6, 4)
    assert sharding.assign(df.limit(0)).count() == 0
    path = str(tmp_path / "shards")
    sharding.write(df, path, shards=4)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select("doc_id", "text", "bucket").collect()), key=repr) == sorted(rows, key=repr)
    assert_law(back.collect(), 6, 4)


def test_sharding_uses_no_python_workers(spark):
    from pairflow.plans import plan_text

    assert "Python" not in plan_text(sharding.assign(documents(spark, SMALL))) and "Arrow" not in plan_text(sharding.shuffled(documents(spark, SMALL)))
