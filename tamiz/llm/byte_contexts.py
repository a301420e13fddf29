"""Contexts of the last bytes of the running text, for prediction by partial matching.

A gram is a context of ``order`` bytes and the symbol that follows it, packed into one integer: the nearest
byte of the context stands highest, then the farther ones, the symbol lowest. Sorted grams thus
hold the contexts of every shorter length in runs. Before a text stand START bytes, after it
stands TEXT_END; neither occurs in UTF-8. The words of a line are parted by one space, the lines
by one line end, and contexts run across both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from tamiz.llm.common import stored

#: Bytes of the longest context; grams of up to six bytes and a symbol are positive integers.
ORDER = 6
#: Bytes that choose the branch: contexts up to one less have bounded tables handed to all tasks.
BRANCH = 3
START, TEXT_END, SYMBOLS = 0xFE, 0xFF, 256
#: Most frequent grams whose scores every task holds; all others are joined.
SHARED_GRAMS = 1 << 21
#: Bytes taken apart at once, grams held by a task before it folds them, distinct ones before it sends them on, and
#: grams coded at once. Folding takes some 60 bytes for each gram held.
TAKEN, COUNTED, SENT, CODED = 1 << 20, 3 << 20, 9 << 18, 200_000
#: Bytes of text after which a task sends its grams, however few: their counts stay below 2 ** 32.
COUNTED_BYTES = 1 << 30
#: Grams looked up at once: what they touch stays in a core's cache.
LOOKED_UP = 1 << 15
#: Bytes of text whose grams go to one task, about.
PART_BYTES = 1 << 24
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def running_text(lines: list[list[bytes]], order: int) -> bytes:
    return bytes([START]) * order + b"\n".join(map(b" ".join, lines)) + bytes([TEXT_END])


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of running texts one after the other, and where each text's begin."""
    data = b"".join(texts)
    # Eight bytes from each place on, the first lowest: the context stands as it should, above it the symbol.
    packed = np.ndarray(len(data) - order, "<i8", data + bytes(8), 0, 1).copy()
    symbol = (packed >> (8 * order)) & 0xFF
    packed &= (1 << (8 * order)) - 1
    packed <<= 8
    packed |= symbol
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) - order
    starts = np.concatenate([[0], np.cumsum(lengths)])
    # Between two texts lie the START bytes of the second.
    kept = np.ones(len(packed), bool)
    kept[((starts[1:-1] + np.arange(len(texts) - 1) * order)[:, None] + np.arange(order)).ravel()] = False
    return packed[kept], starts


def parts_of(docs: DataFrame, text: str) -> int:
    """Tasks that grams are dealt to: their rows follow the text, so each has about as many however long it all is."""
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(1, -(-size // PART_BYTES))


class Held:
    """Grams that a task counts before it sends them: sorted pieces, folded into one when they are many.

    A piece's counts are unsigned integers, the count in the documents to learn from low and that in all high, 32 bits each.
    """

    LEARNED = np.uint64(1 | 1 << 32)
    OTHER = np.uint64(1 << 32)

    def __init__(self, order: int):
        self.order = order
        self.pieces: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0
        self.waiting: dict[bool, list[bytes]] = {True: [], False: []}
        self.waits = {True: 0, False: 0}

    def add(self, body: bytes, learn: bool) -> Iterator[pa.RecordBatch]:
        """Take a running text, a long one in parts; rows to send, if it is time."""
        for at in range(0, len(body) - self.order, TAKEN):
            part = body[at:at + TAKEN + self.order]
            self.waiting[learn].append(part)
            self.waits[learn] += len(part)
            if self.waits[learn] > TAKEN:
                self._take(learn)
                if sum(map(len, self.pieces)) > COUNTED:
                    self._fold()
                if len(self.pieces[0]) > SENT or self.size > COUNTED_BYTES:
                    yield from self.send()

    def send(self) -> Iterator[pa.RecordBatch]:
        """Rows of all that is held; then nothing is."""
        self._take(True)
        self._take(False)
        if not self.pieces:
            return
        self._fold()
        gram, counts = self.pieces.pop(), self.counts.pop()
        self.size = 0
        for at in range(0, len(gram), 100_000):
            some, count = gram[at:at + 100_000], counts[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array((count & np.uint64(0xFFFFFFFF)).view(np.int64)),
                                              pa.array((count >> np.uint64(32)).view(np.int64))], names=["gram", "n", "seen"])

    def _take(self, learn: bool) -> None:
        if self.waiting[learn]:
            gram, seen = np.unique(grams(self.waiting[learn], self.order)[0], return_counts=True)
            self.pieces.append(gram)
            self.counts.append(seen.astype(np.uint64) * (self.LEARNED if learn else self.OTHER))
            self.size += self.waits[learn]
            self.waiting[learn], self.waits[learn] = [], 0

    def _fold(self) -> None:
        # Each list is let go as soon as it is one array: this is the most that a task holds.
        gram = np.concatenate(self.pieces)
        self.pieces.clear()
        # Pieces are sorted, so this merges them.
        by = np.argsort(gram, kind="stable")
        gram = gram[by]
        counts = np.concatenate(self.counts)
        self.counts.clear()
        counts = counts[by]
        del by
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        self.counts.append(np.add.reduceat(counts, first))
        del counts
        self.pieces.append(gram[first])


def count_grams(docs: DataFrame, text: str, learned: Column, lines_of, order: int, parts: int) -> DataFrame:
    """branch, gram, n, seen: every gram, with its count in the documents to learn from and in all.

    A task folds its grams before it sends them, so they are dealt at once and counted where they arrive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(order)
        for batch in batches:
            for value, learn in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist()):
                yield from held.add(running_text(lines_of(value.as_py()), order), learn)
        yield from held.send()

    return (docs.select(F.col(text).alias("text"), learned.alias("learn"))
            .mapInArrow(run, "gram long, n long, seen long").repartition(parts, "gram")
            .groupBy("gram").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
            .select(F.shiftright("gram", 8 * (order + 1 - BRANCH)).alias("branch"), "gram", "n", "seen"))


class Shorter:
    """Counts of contexts of two bytes, one and none."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        """``codes``: sorted grams of two bytes and a symbol."""
        self.codes, self.counts = codes, counts
        two, symbol = codes >> 8, codes & 0xFF
        one = two >> 8
        self.n1 = np.bincount(one << 8 | symbol, counts, 1 << 16).reshape(256, 256)
        self.n0 = self.n1.sum(axis=0)
        self.total2, self.kinds2 = np.bincount(two, counts, 1 << 16), np.bincount(two, minlength=1 << 16)
        self.total1, self.kinds1 = self.n1.sum(axis=1), (self.n1 > 0).sum(axis=1)
        self.total0, self.kinds0 = float(self.n0.sum()), int((self.n0 > 0).sum())
        # What the symbols of a context weigh in the next shorter one.
        self.ruled2 = np.bincount(two, self.n1[one, symbol], 1 << 16)
        self.ruled1 = ((self.n1 > 0) * self.n0[None, :]).sum(axis=1)

    def count2(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(wanted.shape)
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return np.where(self.codes[at] == wanted, self.counts[at], 0.0)


def shorter_counts(counted: DataFrame, order: int) -> Shorter:
    """At most 2 ** 24 grams reach the driver, whatever the collection."""
    code = F.shiftright(F.col("gram"), 8 * (order - 1)).bitwiseAND(F.lit(0xFFFF)) * 256 + F.col("gram").bitwiseAND(F.lit(0xFF))
    rows = counted.filter("n > 0").groupBy(code.alias("code")).agg(F.sum("n").alias("n")).orderBy("code").toArrow()
    return Shorter(rows.column("code").to_numpy(), rows.column("n").to_numpy().astype(np.float64))


def gram_logs(gram: np.ndarray, n: np.ndarray, low: Shorter, order: int = ORDER, tables: list[np.ndarray] = (),
              unit: np.ndarray | int = 0) -> np.ndarray:
    """log10 probability of the symbol of each gram after its context; whole units, sorted by gram.

    A context that was learned codes a symbol seen there ``n`` times as ``(2n - 1) / 2N`` and an escape as
    ``d / 2N``: N symbols, d distinct, both without the symbols that the longer context has ruled out.

    Units are branches, of BRANCH bytes, and have no ``tables``; or those of so many more bytes as there are tables. A table
    has, for a unit (``unit`` tells that of each gram) and symbol, the count in the unit's one context of that length,
    BRANCH bytes and up.
    """
    logs = np.zeros(len(gram))
    waiting = np.ones(len(gram), bool)
    symbol = gram & 0xFF

    def code(count: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> None:
        some = waiting & (total > 0)
        hit = some & (count > 0)
        logs[hit] += np.log10((2 * count[hit] - 1) / (2 * total[hit]))
        lost = some & (count == 0) & (kinds > 0)
        logs[lost] += np.log10(kinds[lost] / (2 * total[lost]))
        waiting[hit] = False

    longer = None
    for depth in range(order, BRANCH + len(tables) - 1, -1):
        context = gram >> (8 * (order - depth + 1))
        owner = np.cumsum(np.concatenate([[0], (context[1:] != context[:-1]).astype(np.int64)]))
        if depth == order:
            first = cell = np.arange(len(gram))
            seen = n
        else:
            cells, first, cell = np.unique(owner << 8 | symbol, return_index=True, return_inverse=True)
            seen = np.bincount(cell, n, len(cells))
        total = np.bincount(owner, n)
        kinds = np.bincount(owner[first[seen > 0]], minlength=len(total))
        count = seen[cell]
        ruled, gone = _ruled(longer, count)
        code(count, total[owner] - ruled, kinds[owner] - gone)
        longer = owner, first[seen > 0], kinds
    known = None
    for table in reversed(tables):
        count = table[unit, symbol]
        ruled, gone = _ruled(longer, count) if known is None else _ruled_by(known, table, unit)
        code(count, table.sum(axis=1)[unit] - ruled, (table > 0).sum(axis=1)[unit] - gone)
        known = table
    context = (gram >> (8 * (order - 1))) & 0xFFFF
    count = low.count2(context << 8 | symbol)
    if known is None:
        ruled, gone = _ruled(longer, count)
    else:
        _, one_of = np.unique(unit, return_index=True)
        shorter = np.zeros(known.shape)
        every = np.unique(unit)
        shorter[every] = low.count2(context[one_of][:, None] << 8 | np.arange(256)[None, :])
        ruled, gone = _ruled_by(known, shorter, unit)
    code(count, low.total2[context] - ruled, low.kinds2[context] - gone)
    one = context >> 8
    code(low.n1[one, symbol], low.total1[one] - low.ruled2[context], low.kinds1[one] - low.kinds2[context])
    code(low.n0[symbol], low.total0 - low.ruled1[one], low.kinds0 - low.kinds1[one])
    return logs - waiting * np.log10(max(1, SYMBOLS - low.kinds0))


def _ruled(longer: tuple | None, count: np.ndarray) -> tuple:
    """Weight here and number of the symbols that each gram's longer context has."""
    if longer is None:
        return 0.0, 0
    owner, learned, kinds = longer
    return np.bincount(owner[learned], count[learned], len(kinds))[owner], kinds[owner]


def _ruled_by(longer: np.ndarray, table: np.ndarray, unit: np.ndarray) -> tuple:
    """The same where each unit has one longer context, of which a table tells."""
    return (table * (longer > 0)).sum(axis=1)[unit], (longer > 0).sum(axis=1)[unit]


#: Grams that a unit may hold before it is split by one more byte.
UNIT_GRAMS = 1 << 20
#: Split units that are coded at once: each has tables of 2 KB.
UNITS = 4096


def split_units(counted: DataFrame, order: int, most: int = UNIT_GRAMS) -> tuple[DataFrame, DataFrame | None]:
    """``counted`` with ``unit`` and ``level``, and the tables of split units: unit, level, depth, symbol, n.

    A unit is the grams that share their ``level`` nearest bytes. One of more than ``most`` grams is split by the next
    byte, up to one byte less than the order: then it has at most 2 ** 16 grams. A split unit's context is shared by its
    parts, so each part gets the counts after it: 256 rows at most.
    """
    width = 8 * (order + 1)
    rows = counted.withColumns({"level": F.lit(BRANCH), "unit": F.col("branch")})
    tables = None
    for level in range(BRANCH, order - 1):
        sizes = rows.filter(F.col("level") == level).groupBy("unit").count().filter(F.col("count") > most)
        large = stored(sizes.select(F.col("unit").alias("large")), "large-units")
        if large.isEmpty():
            break
        joined = rows.join(large, (F.col("unit") == F.col("large")) & (F.col("level") == level), "left")
        deeper = F.shiftright("gram", width - 8 * (level + 1))
        rows = stored(joined.withColumn("split", F.col("large").isNotNull()).withColumns({
            "unit": F.when(F.col("split"), deeper).otherwise(F.col("unit")),
            "level": F.when(F.col("split"), level + 1).otherwise(F.col("level"))}).drop("large"), "units")
        counts = rows.filter("split AND n > 0").groupBy(F.shiftright("unit", 8).alias("of"), F.col("gram").bitwiseAND(F.lit(0xFF)).alias("symbol")).agg(
            F.sum("n").alias("n"))
        parts = rows.filter("split").select("unit", F.shiftright("unit", 8).alias("of")).distinct()
        here = parts.join(counts, "of").select("unit", F.lit(level + 1).alias("level"), F.lit(level).alias("depth"), "symbol", "n")
        if tables is not None:
            # Parts of parts also need what their whole needed.
            above = tables.filter(F.col("level") == level).select(F.col("unit").alias("of"), "depth", "symbol", "n")
            here = here.unionByName(parts.join(above, "of").select("unit", F.lit(level + 1).alias("level"), "depth", "symbol", "n"))
            gone = tables.join(large, (F.col("unit") == F.col("large")) & (F.col("level") == level), "left_anti")
            here = gone.unionByName(here)
        tables = stored(here, "unit-tables")
        rows = rows.drop("split")
    return rows, tables


def scored_grams(counted: DataFrame, order: int, most: int = UNIT_GRAMS, parts: int = 1) -> DataFrame:
    """gram, seen, log10p. A task holds one unit at a time, and some small ones together."""
    shared = counted.sparkSession.sparkContext.broadcast(shorter_counts(counted, order))
    rows, tables = split_units(counted, order, most)

    def plain(columns: list[np.ndarray]) -> pa.RecordBatch:
        gram, n, seen = columns
        logs = gram_logs(gram, n.astype(np.float64), shared.value, order)
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(seen), pa.array(logs)], names=["gram", "seen", "log10p"])

    def split(columns: list[np.ndarray]) -> pa.RecordBatch:
        gram, n, seen, unit, level, depth = columns
        out = np.zeros(len(gram))
        for at in np.unique(level).tolist():
            told = np.flatnonzero((level == at) & (depth < 0))
            here = np.flatnonzero((level == at) & (depth == 0))
            every = np.unique(unit[here])
            for first in range(0, len(every), len(every) if at == BRANCH else UNITS):
                some = every[first:first + (len(every) if at == BRANCH else UNITS)]
                part = here[(unit[here] >= some[0]) & (unit[here] <= some[-1])]
                counts = []
                for d in range(BRANCH, at):
                    of = told[(depth[told] == d - order) & (unit[told] >= some[0]) & (unit[told] <= some[-1])]
                    counts.append(np.zeros((len(some), 256)))
                    counts[-1][np.searchsorted(some, unit[of]), gram[of]] = n[of]
                out[part] = gram_logs(gram[part], n[part].astype(np.float64), shared.value, order, counts, np.searchsorted(some, unit[part]))
        grams = depth == 0
        return pa.RecordBatch.from_arrays([pa.array(gram[grams]), pa.array(seen[grams]), pa.array(out[grams])], names=["gram", "seen", "log10p"])

    def coded(names: tuple[str, ...], key, code):
        """A task: rows are put together once, when what is held ends with a whole unit and is long enough."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[list[np.ndarray]] = []
            size, last = 0, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = [batch.column(c).to_numpy() for c in names]
                unit = key(columns)
                other = np.flatnonzero(unit != unit[-1])
                cut = int(other[-1]) + 1 if len(other) else 0
                if held and (cut or unit[0] != last) and size + cut >= CODED:
                    if cut:
                        held.append([c[:cut] for c in columns])
                        columns = [c[cut:] for c in columns]
                    yield code([np.concatenate(x) for x in zip(*held)])
                    held, size = [], 0
                held.append(columns)
                size, last = size + len(columns[0]), unit[-1]
            if held:
                yield code([np.concatenate(x) for x in zip(*held)])

        return run

    schema = "gram long, seen long, log10p double"
    if tables is None:
        near = 8 * (order + 1 - BRANCH)
        return (counted.repartition(parts, "branch").sortWithinPartitions("gram").select("gram", "n", "seen")
                .mapInArrow(coded(("gram", "n", "seen"), lambda columns: columns[0] >> near, plain), schema))
    names = ("gram", "n", "seen", "unit", "level", "depth")
    # A unit's tables come before its grams.
    together = rows.withColumn("depth", F.lit(0)).select(*names).unionByName(tables.select(
        F.col("symbol").alias("gram"), "n", F.lit(0).cast("long").alias("seen"), "unit", "level", (F.col("depth") - order).alias("depth")))
    return (together.repartition(parts, "unit").sortWithinPartitions("level", "unit", "depth", "gram")
            .mapInArrow(coded(names, lambda columns: columns[3] * 8 + columns[4], split), schema))


def slots(gram: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((gram.astype(np.uint64) * MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)


def slot_bits(size: int) -> int:
    return max(4, size.bit_length())


class Shared:
    """The rows of a table by slot, which become one in the tasks they are sent to: the driver needs none."""

    def __init__(self, gram: np.ndarray, log10p: np.ndarray):
        """``gram``: the most frequent first, as the first of a slot is found at once."""
        by_slot = np.argsort(slots(gram, slot_bits(len(gram))), kind="stable")
        self.rows = gram[by_slot], log10p[by_slot]

    def __reduce__(self) -> tuple:
        return Table, self.rows


class Table:
    """Scores of the most frequent grams, found by hash: a bounded table handed to every task.

    A row is a gram and the bits of its score. The first row of a slot stands at its place, others in a list by slot.
    """

    def __init__(self, gram: np.ndarray, log10p: np.ndarray):
        """Rows by slot."""
        self.bits = slot_bits(len(gram))
        slot = slots(gram, self.bits)
        leads = np.diff(slot, prepend=-1) != 0
        counts = np.bincount(slot[~leads] + 1, minlength=(1 << self.bits) + 1)
        self.first = np.cumsum(counts, dtype=np.int32)
        del counts
        self.others = np.stack([gram[~leads], log10p[~leads].view(np.int64)], 1)
        self.leading = np.zeros((1 << self.bits, 2), np.int64)
        self.leading[:, 0] = -1
        place = slot[leads]
        self.leading[place, 0], self.leading[place, 1] = gram[leads], log10p[leads].view(np.int64)

    def find(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of each gram, 0 if it isn't held, and whether it is held."""
        logs, held = np.zeros(len(gram)), np.zeros(len(gram), bool)
        for start in range(0, len(gram), LOOKED_UP):
            part = slice(start, start + LOOKED_UP)
            self._find(gram[part], logs[part], held[part])
        return logs, held

    def _find(self, gram: np.ndarray, logs: np.ndarray, held: np.ndarray) -> None:
        slot = slots(gram, self.bits)
        row = self.leading.take(slot, axis=0)
        same = row[:, 0] == gram
        held[:] = same
        logs[:] = np.where(same, row[:, 1].view(np.float64), 0.0)
        rows = np.flatnonzero(~same)
        at, end, wanted = self.first[slot[rows]], self.first[slot[rows] + 1], gram[rows]
        more = at < end
        while more.any():
            rows, at, end, wanted = rows[more], at[more], end[more], wanted[more]
            row = self.others[at]
            same = row[:, 0] == wanted
            logs[rows[same]], held[rows[same]] = row[same, 1].view(np.float64), True
            at += 1
            more = ~same & (at < end)


def frequent(scored: DataFrame, most: int) -> Shared:
    """The grams seen most often, at most ``most``: as many whole classes of frequency as fit."""
    size = F.floor(F.log2(F.col("seen").cast("double")) * 4).cast("int")
    classes = sorted(((r["size"], r["count"]) for r in scored.groupBy(size.alias("size")).count().collect()), reverse=True)
    least, left = None, most
    for at, n in classes:
        if n > left:
            break
        least, left = at, left - n
    if least is None:
        return Shared(np.empty(0, np.int64), np.empty(0))
    rows = scored.filter(size >= least).select("gram", "log10p", size.cast("short").alias("size")).toArrow()
    by = np.argsort(-rows.column("size").to_numpy(), kind="stable")
    return Shared(rows.column("gram").to_numpy()[by], rows.column("log10p").to_numpy()[by])


def text_logs(texts: list[bytes], table: Table, order: int) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """For each running text the score of the grams in ``table``, and all other grams with their counts."""
    held: list[bytes] = []
    size = 0
    for i, body in enumerate(texts):
        held.append(body)
        size += len(body)
        if size > TAKEN or i + 1 == len(texts):
            gram, starts = grams(held, order)
            logs, found = table.find(gram)
            sums = np.add.reduceat(logs, starts[:-1])
            missing = np.flatnonzero(~found)
            cuts = np.searchsorted(missing, starts)
            for k, total in enumerate(sums.tolist()):
                yield total, *np.unique(gram[missing[cuts[k]:cuts[k + 1]]], return_counts=True)
            held, size = [], 0
