"""Conversation structure repair: the cheapest edits that make the turns alternate.

A repaired conversation is empty or an optional system turn and pairs of user and assistant turns. Four states
(nothing yet, after system, user, assistant) tell what may follow, so edits are paths through rows and states.
The path is found by divide and conquer in linear space: cost vectors of the four states run forward from the
start and backward from the end and meet in the middle; of the states of least total cost the one whose edits come first
in the alphabet is the crossing, and both halves are solved alike.

Conversations of any length are cut into chunks of bounded size. A longer one's chunks give cost tables from state
to state; the vectors run over these and fix the crossings between chunks, and each chunk is then solved
by itself.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tamiz.llm.common import small_batches, stored, to_arrow

#: Symbols of a conversation that are solved at once.
CHUNK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANKS = " \t\n\x0b\f\r"
LEGAL = frozenset({("s", "u"), ("u", "a"), ("a", "u")})
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
#: The state that an inserted or renamed turn leads to.
FORCED = (USER, USER, ASSISTANT, USER)
#: What a kept turn of a role leads to, by state.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {USER: "user", ASSISTANT: "assistant"}


def _inserted(state: int) -> list[tuple[int, int, str]]:
    """State, cost and edits after no, one and two insertions."""
    out = [(state, 0, "")]
    for _ in range(2):
        last, cost, edits = out[-1]
        out.append((FORCED[last], cost + INSERT, edits + "I"))
    return out


def _moves(symbol: str) -> list[tuple[int, int, int, str]]:
    """From, to, cost and edits of every way past one turn; between two states the cheapest, first in the alphabet.

    Symbols: the role's initial (``o`` for any other), in upper case if truncated; ``x`` must be deleted.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for state in range(4):
        for now, cost, edits in _inserted(state):
            ways = [(now, DELETE, "D")]
            if symbol != "x":
                extra = TRUNCATED if symbol.isupper() else 0
                ways.append((FORCED[now], REROLE + extra, "R"))
                to = KEPT.get(symbol.lower(), {}).get(now)
                if to is not None:
                    ways.append((to, KEEP + extra, "K"))
            for to, price, edit in ways:
                way = (cost + price, edits + edit)
                if (state, to) not in best or way < best[state, to]:
                    best[state, to] = way
    return [(a, b, *way) for (a, b), way in best.items()]


MOVES = {symbol: _moves(symbol) for symbol in "xsuaoSUAO"}
WAYS = {(symbol, a, b): (cost, edits) for symbol, moves in MOVES.items() for a, b, cost, edits in moves}
#: Cost and edits from each state to an end of the conversation.
ENDS = [min((cost, edits) for now, cost, edits in _inserted(state) if now in (START, ASSISTANT)) for state in range(4)]


def forward(symbols: str, runs: list[int], lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Costs from ``start`` to each state past turn ``hi - 1``, and the alphabetical rank of their first cheapest edits.

    Edits that end past the same turn are never the beginning of one another, so ranks tell their order however they go on.
    A run is a turn that must be deleted so many times.
    """
    costs, ranks = [NEVER] * 4, [0] * 4
    costs[start] = 0
    for i in range(lo, hi):
        symbol, more = symbols[i], DELETE * (runs[i] - 1)
        best: list = [None] * 4
        for a, b, cost, edits in MOVES[symbol]:
            if costs[a] < NEVER:
                way = (costs[a] + cost + more, ranks[a], edits)
                if best[b] is None or way < best[b]:
                    best[b] = way
        order = sorted(b for b in range(4) if best[b])
        order.sort(key=lambda b: best[b][1:])
        costs = [w[0] if w else NEVER for w in best]
        ranks = [order.index(b) if best[b] else 0 for b in range(4)]
    return costs, ranks


def backward(symbols: str, runs: list[int], lo: int, hi: int, costs: list[int]) -> list[int]:
    """Costs from each state before turn ``lo`` on, given those past turn ``hi - 1``."""
    for i in range(hi - 1, lo - 1, -1):
        more = DELETE * (runs[i] - 1)
        now = [NEVER] * 4
        for a, b, cost, _ in MOVES[symbols[i]]:
            total = costs[b] + cost + more
            if total < now[a]:
                now[a] = total
        costs = now
    return costs


def crossing(costs: list[int], ranks: list[int], rest: list[int]) -> int:
    """The state of least total cost, the alphabetically first of equals."""
    return min((b for b in range(4) if costs[b] < NEVER), key=lambda b: (costs[b] + rest[b], ranks[b]))


def path(symbols: str, runs: list[int], lo: int, hi: int, start: int, end: int) -> str:
    """The first of the cheapest edits from state ``start`` to state ``end``, past the turns from ``lo`` to ``hi``."""
    if hi - lo == 1:
        return WAYS[symbols[lo], start, end][1] + "D" * (runs[lo] - 1)
    middle = (lo + hi) // 2
    rest = backward(symbols, runs, middle, hi, [0 if b == end else NEVER for b in range(4)])
    meet = crossing(*forward(symbols, runs, lo, middle, start), rest)
    return path(symbols, runs, lo, middle, start, meet) + path(symbols, runs, middle, hi, meet, end)


@functools.lru_cache(maxsize=1 << 14)
def _solve(symbols: str, runs: tuple[int, ...], start: int, end: int | None) -> tuple[int, str]:
    n = len(symbols)
    costs, ranks = forward(symbols, runs, 0, n, start)
    tail = [cost if end is None else 0 if b == end else NEVER for b, (cost, _) in enumerate(ENDS)]
    last = crossing(costs, ranks, tail)
    edits = path(symbols, runs, 0, n, start, last) if n else ""
    return costs[last] + tail[last], edits + (ENDS[last][1] if end is None else "")


def solve(symbols: str, runs: list[int], start: int = START, end: int | None = None) -> tuple[int, str]:
    """Cost and edits of a chunk. Without ``end`` it is the conversation's last and may end where a conversation may."""
    return _solve(symbols, tuple(runs), start, end)


def _schema(**types) -> StructType:
    """Columns by name, of types or their SQL names."""
    return StructType.fromDDL(", ".join(f"`{n}` {t if isinstance(t, str) else t.simpleString()}" for n, t in types.items()))


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with faults put in by a hash of their conversation and number; columns conv_id, turn, role, text.

    Of twenty hash values 0 drops the turn, 1 empties it, 2 takes its ends of sentences, 3 repeats it, 4 makes it the user's.
    """
    def plain(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain(conv_id), F.lit(":"), plain(turn)).cast("binary")) % 20
    new = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(plain(text), "[.!?]", "")).otherwise(plain(text))
    return rows.filter(kind != 0).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(plain(role)).alias("role"), new.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def _turns(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, a, b: turns with a 128-bit name of their text."""
    words = F.coalesce(F.col(text), F.lit(" "))
    return rows.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                       words.alias("text"), F.xxhash64(words).alias("a"), F.xxhash64(F.lit(1), words).alias("b"))


#: The order of a conversation's turns; those of one number stand by role and text.
ORDER = ("turn", "role", "a", "b")


def _entries(turns: DataFrame) -> DataFrame:
    """conv, turn, role, a, b, m, blank, truncated, first: distinct turns without their texts.

    Equal rows fold before they are sent. ``first`` if no earlier turn of the conversation has its role and text.
    """
    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = turns.select("conv", *ORDER, (ended == "").alias("blank"), (~ended.rlike(r"[.!?]\z")).alias("truncated"))
    folded = light.groupBy("conv", *ORDER).agg(F.count("*").alias("m"), F.first("blank").alias("blank"),
                                               F.first("truncated").alias("truncated"))
    seen = folded.groupBy("conv", "role", "a", "b").agg(F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("open"))
    seen = seen.withColumnsRenamed({"conv": "c", "role": "r", "a": "x", "b": "y"})
    joined = folded.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("a") == F.col("x"))
                         & (F.col("b") == F.col("y")))
    first = F.when(F.col("open"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("least"))
    return joined.select("conv", *ORDER, "m", "blank", "truncated", first.alias("first"))


COUNTS = ("blank", "duplicate", "truncated", "illegal", "n_turns")


class _Chunk:
    """A chunk as it is filled turn by turn."""

    def __init__(self, conv):
        self.conv, self.symbols, self.runs = conv, [], []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first = self.last = self.low = self.high = None

    def add(self, turn, initial: str, m: int, blank: bool, truncated: bool, first: bool) -> None:
        counts = self.counts
        if self.last is None:
            self.first = initial
        elif (self.last, initial) not in LEGAL:
            counts["illegal"] += 1
        counts["illegal"] += m - 1
        self.last = initial
        if turn is not None and turn != self.high:
            counts["n_turns"] += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        gone = m
        if blank:
            counts["blank"] += m
        elif first:
            symbol = initial if initial in KEPT else "o"
            self.symbols.append(symbol.upper() if truncated else symbol)
            self.runs.append(1)
            counts["truncated"] += truncated
            gone = m - 1
            counts["duplicate"] += gone
        else:
            counts["duplicate"] += m
        if gone:
            if self.symbols and self.symbols[-1] == "x":
                self.runs[-1] += gone
            else:
                self.symbols.append("x")
                self.runs.append(gone)


def _chunks(entries: DataFrame, chunk: int) -> DataFrame:
    """Entries in order as chunks: conv, part, seq, symbols, runs, counts, first and last initial, least and greatest turn.

    Order comes from ranges, so a conversation of any size is spread over as many tasks as its turns fill.
    """
    kinds = {c: entries.schema[c].dataType for c in ("conv", "turn")}
    schema = _schema(conv=kinds["conv"], part="int", seq="int", symbols="string", runs="array<bigint>",
                     **dict.fromkeys(COUNTS, "bigint"), first="string", last="string", low=kinds["turn"], high=kinds["turn"])
    arrow = pa.schema([(f.name, to_arrow(f.dataType)) for f in schema])

    def batch_of(part: int, done: list[tuple[int, _Chunk]]) -> pa.RecordBatch:
        rows = [(c.conv, part, seq, "".join(c.symbols), c.runs, *c.counts.values(), c.first, c.last, c.low, c.high) for seq, c in done]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, now, done, held = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "initial", "m", "blank", "truncated", "first")]
            for conv, turn, *rest in zip(*columns):
                if now is None or now.conv != conv or len(now.symbols) >= chunk:
                    if now is not None:
                        done.append((seq, now))
                        seq, held = seq + 1, held + len(now.symbols)
                    now = _Chunk(conv)
                    if held > 100_000:
                        yield batch_of(part, done)
                        done, held = [], 0
                now.add(turn, *rest)
        if now is not None:
            done.append((seq, now))
            yield batch_of(part, done)

    ordered = entries.repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER)
    return ordered.select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "m", "blank", "truncated", "first").mapInArrow(run, schema)


def _table(symbols: str, runs: list[int]) -> tuple[list[int], list[int]]:
    """Costs from each state to each, and the ranks of the edits to them, over a chunk."""
    costs, ranks = [], []
    for start in range(4):
        c, r = forward(symbols, runs, 0, len(symbols), start)
        costs += c
        ranks += r
    return costs, ranks


def chain(tables: list[tuple[list[int], list[int]]]) -> list[tuple[int, int | None]]:
    """Start and end state of each chunk of a conversation from the tables of all; the last one's end is open."""
    rest = [[cost for cost, _ in ENDS]]
    for costs, _ in reversed(tables[1:]):
        rest.append([min(costs[4 * a + b] + rest[-1][b] for b in range(4)) for a in range(4)])
    rest.reverse()
    costs, ranks = [0, NEVER, NEVER, NEVER], [0] * 4
    ends = []
    for (table, order), left in zip(tables, rest):
        best: list = [None] * 4
        for a in range(4):
            for b in range(4):
                if costs[a] < NEVER and table[4 * a + b] < NEVER:
                    way = (costs[a] + table[4 * a + b], ranks[a], order[4 * a + b])
                    best[b] = way if best[b] is None else min(best[b], way)
        sequence = sorted((b for b in range(4) if best[b]), key=lambda b: best[b][1:])
        costs = [w[0] if w else NEVER for w in best]
        ranks = [sequence.index(b) if best[b] else 0 for b in range(4)]
        ends.append(crossing(costs, ranks, left))
    return list(zip([START, *ends[:-1]], [*ends[:-1], None]))


def _crossings(chunks: DataFrame) -> DataFrame | None:
    """conv, part, seq, start, end for the chunks of conversations that have several; None if none has."""
    several = stored(chunks.groupBy("conv").count().filter("count > 1").select(F.col("conv").alias("c")), "long-conversations")
    if several.isEmpty():
        return None
    kind = chunks.schema["conv"].dataType
    some = chunks.join(several, F.col("conv").eqNullSafe(F.col("c")), "left_semi").select("conv", "part", "seq", "symbols", "runs")

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_table(s, r) for s, r in zip(batch.column("symbols").to_pylist(), batch.column("runs").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.int64()))],
                names=["conv", "part", "seq", "costs", "ranks"])

    def cross(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("seq", "ascending")])
        states = chain(list(zip(table.column("costs").to_pylist(), table.column("ranks").to_pylist())))
        return pa.table([*[table.column(c) for c in ("conv", "part", "seq")], pa.array([s for s, _ in states], pa.int32()),
                         pa.array([e for _, e in states], pa.int32())], names=["conv", "part", "seq", "start", "end"])

    wide = _schema(conv=kind, part="int", seq="int", costs="array<bigint>", ranks="array<bigint>")
    out = _schema(conv=kind, part="int", seq="int", start="int", end="int")
    # One row of 32 numbers stands for up to CHUNK turns.
    return some.mapInArrow(tables, wide).groupBy("conv").applyInArrow(cross, out)


def _solved(chunks: DataFrame) -> DataFrame:
    """Chunks with ``cost`` and ``audit``."""
    states = _crossings(chunks)
    if states is None:
        joined = chunks.withColumns({"start": F.lit(START), "end": F.lit(None).cast("int")})
    else:
        named = states.select("part", "seq", "start", "end")  # a chunk is known by its task and number
        joined = chunks.join(named, ["part", "seq"], "left").withColumn("start", F.coalesce("start", F.lit(START)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [solve(*row) for row in zip(*[batch.column(c).to_pylist() for c in ("symbols", "runs", "start", "end")])]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.string())], names=[*kept, "cost", "audit"])

    kept = [c for c in chunks.columns if c not in ("symbols", "runs")]
    schema = _schema(**{c: joined.schema[c].dataType for c in kept}, cost="bigint", audit="string")
    return joined.mapInArrow(run, schema)


class _Repair:
    """One conversation as its chunks and then its turns come by in order."""

    def __init__(self, conv):
        self.conv, self.audit, self.cost = conv, "", 0
        self.counts = dict.fromkeys(COUNTS, 0)
        self.last = self.low = self.high = None
        self.pieces: list[str] = []
        self.at, self.state = 0, START
        self.hash, self.place = hashlib.sha256(), 0

    def add_chunk(self, chunk: dict) -> None:
        for c in COUNTS:
            self.counts[c] += chunk[c]
        if self.last is not None and (self.last, chunk["first"]) not in LEGAL:
            self.counts["illegal"] += 1
        if chunk["low"] is not None:
            self.counts["n_turns"] -= self.high == chunk["low"]
            self.low = chunk["low"] if self.low is None else self.low
            self.high = chunk["high"]
        self.last = chunk["last"]
        self.cost += chunk["cost"]
        self.pieces.append(chunk["audit"])

    def _put(self, role: str, text: str) -> tuple[int, str, str]:
        self.hash.update((("\n" if self.place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.place += 1
        return self.place, role, text

    def _forced(self) -> str:
        self.state = FORCED[self.state]
        return NAMES[self.state]

    def _insertions(self) -> Iterator[tuple[int, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put(self._forced(), "")

    def add_turn(self, role: str, text: str) -> Iterator[tuple[int, str, str]]:
        """Rows of the repaired conversation up to this turn."""
        if self.pieces:
            self.audit, self.pieces = "".join(self.pieces), []
        yield from self._insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._put(self._forced(), text)
        elif edit == "K":
            self.state = KEPT[role[:1]][self.state]
            yield self._put(role, text)

    def end(self) -> Iterator[tuple[int, str, str]]:
        yield from self._insertions()

    def report(self) -> tuple:
        c = self.counts
        gaps = 0 if self.low is None else self.high - self.low + 1 - c["n_turns"]
        return (self.conv, gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], self.cost, self.audit, self.hash.hexdigest())


def _replay(rows: DataFrame, ids: DataFrame | None, names: tuple[str, str, str, str], chunk: int, as_rows: bool) -> DataFrame:
    conv_id, turn, role, text = names
    turns = _turns(rows, *names)
    chunks = _solved(stored(_chunks(stored(_entries(turns), "turns"), chunk), "chunks"))
    ids = (rows if ids is None else ids).select(F.col(conv_id).alias("conv")).distinct().withColumn("kind", F.lit(0))
    together = (ids.unionByName(chunks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
                .unionByName(turns.withColumn("kind", F.lit(2)), allowMissingColumns=True))
    ordered = together.repartition("conv").sortWithinPartitions("conv", "kind", "part", "seq", *ORDER)
    kind = turns.schema["conv"].dataType
    if as_rows:
        schema = _schema(**{conv_id: kind, "place": "bigint", role: "string", text: "string"})
    else:
        numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        schema = _schema(**{conv_id: kind}, **dict.fromkeys(numbers, "bigint"), audit="string", repaired_sha256="string")
    arrow = pa.schema([(f.name, to_arrow(f.dataType)) for f in schema])

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, held = None, [], 0

        def closed(done: _Repair) -> list[tuple]:
            rest = [(done.conv, *row) for row in done.end()]
            return rest if as_rows else [done.report()]

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or now.conv != row["conv"]:
                    if now is not None:
                        out += closed(now)
                    now = _Repair(row["conv"])
                if row["kind"] == 1:
                    now.add_chunk(row)
                elif row["kind"] == 2:
                    for made in now.add_turn(row["role"], row["text"]):
                        if as_rows:
                            out.append((now.conv, *made))
                            held += len(made[2])
                if len(out) >= 1000 or held > 1 << 22:
                    yield batch_of(out)
                    out, held = [], 0
        if now is not None:
            out += closed(now)
        if out:
            yield batch_of(out)

    needed = ["conv", "kind", *COUNTS, "first", "last", "low", "high", "cost", "audit", "role", "text"]
    return ordered.select(needed).mapInArrow(run, schema)


def repair(rows: DataFrame, ids: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """A row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``ids`` may name conversations that have no rows; they get zeros, an empty audit and the hash of an empty text. A NULL
    conversation is one of its own; a NULL role or text is one space; NULL turns come first. Turns of one number stand
    by role and then by a hash of their text. Repeated rows are adjacent duplicates. Roles that begin with none of s, u and a
    can only be renamed or deleted. Other columns play no part, and an empty table gives no rows. Conversations of
    any length are solved in pieces of ``chunk`` turns; texts are sent once, and only the hash of a conversation's
    repaired text, which is sequential, runs over them in one task, row by row.
    """
    small_batches(rows.sparkSession)
    return _replay(rows, ids, (conv_id, turn, role, text), chunk, False)


def repaired(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             chunk: int = CHUNK) -> DataFrame:
    """The rows of the repaired conversations: conv_id, ``place`` from 1, role and text. Cases are as in :func:`repair`."""
    small_batches(rows.sparkSession)
    return _replay(rows, None, (conv_id, turn, role, text), chunk, True)
