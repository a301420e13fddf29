"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tamiz.llm import catalog, dialogue_repair
from tamiz.llm.dialogue_repair import damaged, repair, repaired

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(turns):
    """(cost, audit, repaired rows): every edit at every place, the first audit of the cheapest."""
    def better(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way
            return True
        return False

    def insert(table):
        open_ = list(table)
        while open_:
            state = open_.pop(0)
            cost, audit, rows = table[state]
            for to, role in (("u", "user"), ("a", "assistant")):
                if to in NEXT[state] and better(table, to, (cost + 2, audit + "I", rows + [(role, "")])):
                    open_.append(to)

    now = {"": (0, "", [])}
    for role, text, fault in turns:
        insert(now)
        after = {}
        extra = fault == "truncated"
        for state, (cost, audit, rows) in now.items():
            better(after, state, (cost + 3, audit + "D", rows))
            if fault in ("blank", "duplicate"):
                continue
            if role[:1] in NEXT[state]:
                better(after, role[:1], (cost + extra, audit + "K", rows + [(role, text)]))
            for to, name in (("u", "user"), ("a", "assistant")):
                if to in NEXT[state]:
                    better(after, to, (cost + 2 + extra, audit + "R", rows + [(name, text)]))
        now = after
    insert(now)
    return min(now[s] for s in ("", "a") if s in now)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = LAST.search(text)
        fault = "blank" if not last else "duplicate" if (role, text) in seen else None if last[1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(turns):
    """Rows (turn, role, text) in order, as a result row without its id."""
    full = faults([(" " if r is None else r, " " if t is None else t) for _, r, t in turns])
    numbers = [n for n, _, _ in turns if n is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[:1] for r, _, _ in full]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, rows = cheapest(full)
    text = "\n".join(f"{r}:{t}" for r, t in rows)
    kinds = [f for _, _, f in full]
    return (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def table_of(result):
    return {r["conv_id"]: tuple(r)[1:] for r in result.collect()}


def test_query(spark):
    groups = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        groups[r["conv_id"]].append((r["turn"], r["role"], r["text"]))
    want = {}
    for conv, turns in groups.items():
        rows = []
        for turn, role, text in sorted(turns):
            kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        want[conv] = brute(rows)
    assert table_of(catalog.op13_dialogue(spark, SF)) == want


def made(seed, n):
    dice = random.Random(seed)
    texts = ["Yes.", "No", "", " ", "Why?", "So it is.", "x! \n"]
    return [(i, dice.choice(["user", "assistant", "system", "tool", "user", "assistant", ""]), dice.choice(texts) + dice.choice(["", f"{i}.", f"{i}"]))
            for i in range(n)]


def test_halves_meet_at_the_first_of_equals():
    for seed in range(400):
        turns = faults([(r, t) for _, r, t in made(seed, seed % 12)])
        symbols = ["x" if f in ("blank", "duplicate") else (r[:1] if r[:1] in "sua" and r else "o") for r, _, f in turns]
        symbols = [s.upper() if f == "truncated" else s for s, (_, _, f) in zip(symbols, turns)]
        cost, audit, _ = cheapest(turns)
        assert dialogue_repair.solve("".join(symbols), [1] * len(symbols)) == (cost, audit)


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_chunks_of_long_conversations(spark, chunk):
    convs = {c: made(c, n) for c, n in ((1, 57), (2, 4), (3, 23), (None, 12))}
    df = spark.createDataFrame([(c, *t) for c, turns in convs.items() for t in turns], SCHEMA).repartition(5)
    assert table_of(repair(df, chunk=chunk)) == {c: brute(turns) for c, turns in convs.items()}


def test_repeated_rows_fold(spark):
    rows = [(1, 0, "user", "Hi."), *[(1, 1, "assistant", "Hello.")] * 300, (1, 2, "user", "Bye."), *[(1, 3, "assistant", " ")] * 200]
    got = table_of(repair(spark.createDataFrame(rows, SCHEMA), chunk=2))
    assert got == {1: brute([r[1:] for r in rows])}


def test_odd_rows(spark):
    long = "word " * 400_000 + "end."
    rows = [(None, None, None, None), (1, None, "user", "A."), (1, None, "user", "A."), (2, 5, "system", "S."), (2, -1, "user", long),
            (3, None, "assistant", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {None: brute([(None, None, None)]), 1: brute([(None, "user", "A.")] * 2), 2: brute([(-1, "user", long), (5, "system", "S.")]),
            3: brute([(None, "assistant", None)]), 9: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    ids = spark.createDataFrame([(i,) for i in want], "conv_id long")
    clash = df.selectExpr("*", "1 AS conv", "2 AS kind", "3 AS a", "4 AS part", "5 AS m", "6 AS audit")
    assert table_of(repair(df, ids)) == want == table_of(repair(clash, ids))
    assert repair(df.limit(0)).count() == 0 and damaged(df.limit(0)).count() == 0
    assert damaged(df).count() <= 2 * len(rows)


def test_repaired_rows(spark):
    convs = {c: made(c, 15) for c in range(6)}
    df = spark.createDataFrame([(c, *t) for c, turns in convs.items() for t in turns], SCHEMA)
    got = defaultdict(list)
    for r in sorted(repaired(df, chunk=4).collect()):
        got[r["conv_id"]].append((r["role"], r["text"]))
    assert got == {c: w for c, turns in convs.items() if (w := cheapest(faults([(r, t) for _, r, t in turns]))[2])}
