"""The byte model of op4_ppm against a plain version, and contexts that cross spaces and line ends."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tamiz.llm import byte_contexts, ppm


def plain_scores(made, order):
    body = {i: bytes([byte_contexts.START]) * order + b"\n".join(b" ".join(x) for x in ppm.lines_of(t)) + b"\xff" for i, t in made}
    seen = defaultdict(Counter)
    for i, b in body.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for at in range(order, len(b)):
                for k in range(order + 1):
                    seen[b[at - k:at]][b[at]] += 1
    out = {}
    for i, b in body.items():
        out[i] = 0.0
        for at in range(order, len(b)):
            gone = set()
            for k in range(order, -1, -1):
                here = {s: n for s, n in seen[b[at - k:at]].items() if s not in gone}
                if b[at] in here:
                    out[i] += math.log10((2 * here[b[at]] - 1) / (2 * sum(here.values())))
                    break
                if here:
                    out[i] += math.log10(len(here) / (2 * sum(here.values())))
                gone |= set(here)
            else:
                out[i] -= math.log10(256 - len(gone))
    return out


@pytest.mark.parametrize("order,shared,unit", [(6, 1 << 21, 1 << 20), (6, 40, 2), (6, 0, 12), (5, 40, 3), (4, 0, 1), (3, 1 << 21, 1)])
def test_scores_are_those_of_plain_ppm(spark, order, shared, unit):
    """Also with units split as finely as can be, and some of them."""
    made = [(i, " ".join(f"w{(i * j) % 11} é\n" if j % 5 else f"Tail{i % 4}" for j in range(1, 25))) for i in range(30)] + [(99, None)]
    got = {r["doc_id"]: r["score"] for r in ppm.score(spark.createDataFrame(made, "doc_id long, text string"), order=order,
                                                      shared_words=5, shared_grams=shared, unit_grams=unit).collect()}
    assert got == pytest.approx(plain_scores(made, order))


def test_order_of_words_counts(spark):
    line = "one two three four five six seven"
    made = [(i, line) for i in range(40)] + [(1000 + i, "seven four one six two five three") for i in range(7)]
    made = [(i, t) for i, t in made if i < 1000 or zlib.crc32(str(i).encode()) % 7 == 2] + [
        (5000 + i, line + " end") for i in range(30) if zlib.crc32(str(5000 + i).encode()) % 7 == 2]
    got = {r["doc_id"]: r for r in ppm.score(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    shuffled = [r["score"] for i, r in got.items() if 1000 <= i < 5000]
    assert shuffled and all(s < 2 * got[0]["score"] and s < r["score"] for s in shuffled for i, r in got.items() if i >= 5000)


def test_byte_model_is_a_distribution():
    texts = [byte_contexts.running_text([[b"abcabd", b"abce"], [b"bcd"]], 5)] * 2 + [byte_contexts.running_text([[b"zz"]], 5)]
    learned, n = np.unique(byte_contexts.grams(texts, 5)[0], return_counts=True)
    code = ((learned >> 32) & 0xFFFF) << 8 | (learned & 0xFF)
    codes, where = np.unique(code, return_inverse=True)
    low = byte_contexts.Shorter(codes, np.bincount(where, n).astype(float))
    for context in sorted(set((learned >> 8).tolist())) + [0x7A7A7A7A7A, 0x6263007A7A]:
        every = context << 8 | np.arange(256)
        grams = np.union1d(learned, every)
        counts = np.zeros(len(grams))
        counts[np.searchsorted(grams, learned)] = n
        logs = byte_contexts.gram_logs(grams, counts, low, 5)[np.searchsorted(grams, every)]
        assert (10 ** logs).sum() == pytest.approx(1)


def test_long_words_do_not_reach_the_driver(spark, monkeypatch):
    """Words above SHARED_BYTES are joined, with the same scores."""
    from pyspark.sql.classic.dataframe import DataFrame

    collected = []
    plain = DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda df: collected.append(plain(df)) or collected[-1])
    long = "x" * 5000
    a, b = [i for i in range(20) if zlib.crc32(str(i).encode()) % 7 != 2][:2]
    got = ppm.score(spark.createDataFrame([(a, f"{long} a"), (b, f"{long} b")], "doc_id long, text string")).collect()
    words = [w for t in collected if "word" in t.column_names for w in t.column("word").to_pylist()]
    assert words and max(map(len, words)) <= ppm.SHARED_BYTES
    assert [r["n_known"] for r in got] == [3, 3]


def test_grams_are_context_and_symbol():
    import numpy as np

    from tamiz.llm import byte_contexts

    for order in (3, 4, 5, 6):
        texts = [byte_contexts.running_text([w.split() for w in t.split(b"\n")], order) for t in (b"", b"a", b"ab \xc3\xbf\ncd", b"", b"xyz" * 9)]
        plain = [[int.from_bytes(t[i - order:i][::-1] + t[i:i + 1], "big") for i in range(order, len(t))] for t in texts]
        gram, starts = byte_contexts.grams(texts, order)
        assert gram.tolist() == sum(plain, []) and np.diff(starts).tolist() == [len(x) for x in plain]


def test_words_of_the_vocabulary_are_those_of_the_lines():
    from tamiz.llm.ppm import lines_of, lower_bytes

    for text in ("", None, "A\x0bb\n\n c\r\nÉ d\x0c\x1ce\u2028f", "x".encode()):
        assert lower_bytes(text).split() == sum(lines_of(text), [])


class Batches:
    """Stands for a table: keeps what its tasks would run."""

    def __getattr__(self, name):
        return lambda *args, **kw: setattr(self, "run", args[0]) or self if name == "mapInArrow" else self


def tasks_rows(make, texts, learned):
    """Rows that one task sends, a column of arrays each."""
    import pyarrow as pa

    docs = Batches()
    make(docs)
    table = pa.table({"text": pa.array(texts, pa.binary()), "learn": pa.array(learned)})
    del texts
    return [b.columns for b in docs.run(iter(table.to_batches(max_chunksize=1000)))]


def count(docs):
    from pyspark.sql import functions as F

    byte_contexts.count_grams(docs, "text", F.lit(True), ppm.lines_of, 6, 1)


def random_text(rng, size):
    return rng.choice(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz    \n", np.uint8), size).tobytes()


def test_grams_of_a_task_are_counted_in_little_memory(spark):
    """Nearly 6 million distinct grams: 409 MB at most before, then 205."""
    import tracemalloc

    rng = np.random.default_rng(4)
    texts = [random_text(rng, 60_000) for _ in range(100)]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        rows = sum(len(c[0]) for c in tasks_rows(count, texts, [i % 7 != 2 for i in range(100)]))
        peak = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert rows > 5_000_000
    # The rows themselves stand in Arrow's own memory.
    assert peak < 250e6


@pytest.mark.parametrize("taken,counted,sent,least", [(1 << 20, 3 << 20, 1 << 21, 1 << 30), (500, 3000, 2000, 1 << 30), (100, 700, 1 << 21, 900), (64, 1, 1, 1)])
def test_grams_sent_add_up(spark, monkeypatch, taken, counted, sent, least):
    """However often a task folds and sends, and with texts longer than what it takes apart at once."""
    for name, value in (("TAKEN", taken), ("COUNTED", counted), ("SENT", sent), ("COUNTED_BYTES", least)):
        monkeypatch.setattr(byte_contexts, name, value, raising=False)
    rng = np.random.default_rng(5)
    texts = [b"ab ab\n" * int(n) + random_text(rng, int(n)) for n in rng.integers(0, 3000, 40)] + [b"", None]
    learned = [i % 3 != 1 for i in range(len(texts))]
    got = defaultdict(lambda: [0, 0])
    for gram, n, seen in tasks_rows(count, texts, learned):
        for g, x, y in zip(*(c.to_pylist() for c in (gram, n, seen))):
            got[g][0] += x
            got[g][1] += y
    plain = defaultdict(lambda: [0, 0])
    for text, learn in zip(texts, learned):
        for g in byte_contexts.grams([byte_contexts.running_text(ppm.lines_of(text), 6)], 6)[0].tolist():
            plain[g][0] += learn
            plain[g][1] += 1
    assert got == plain


def test_texts_held_out_cost_their_own_words_only(spark):
    """Each went through all words that the task had counted."""
    import time

    from pyspark.sql import functions as F

    texts = [b" ".join(b"w%d" % i for i in range(250_000))] + [b"w%d new%d" % (i, i) for i in range(4000)]
    began = time.thread_time()
    rows = tasks_rows(lambda docs: ppm.vocabulary(docs, "text", F.lit(True)), texts, [True] + [False] * 4000)
    assert time.thread_time() - began < 4
    got = {w: c for words, counts in rows for w, c in zip(words.to_pylist(), counts.to_pylist())}
    assert got == {b"w%d" % i: 1 for i in range(250_000)} | {b"new%d" % i: 0 for i in range(4000)} | {b"": 1}


@pytest.mark.parametrize("size", [0, 1, 7, 5000])
def test_table_finds_its_grams_only(size):
    """Its rows alone are sent, and it is made of them where they arrive."""
    import pickle

    rng = np.random.default_rng(size)
    every = rng.permutation(np.unique(rng.integers(0, 1 << 56, 3 * size + 50)))
    gram, logs = every[:size], -rng.random(size)
    sent = pickle.dumps(byte_contexts.Shared(gram, logs))
    assert len(sent) < 16 * size + 2000
    table = pickle.loads(sent)
    # 20 bytes a slot, of which there are at most two for a gram, and some rows beside them.
    assert table.leading.nbytes + table.first.nbytes + table.others.nbytes < 50 * size + 500
    found, held = table.find(every)
    assert held.tolist() == [True] * size + [False] * (len(every) - size)
    assert found[:size].tolist() == logs.tolist() and not found[size:].any()
