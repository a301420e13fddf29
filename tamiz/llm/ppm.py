"""LM scoring: prediction by partial matching over the bytes of the running text.

Every symbol of a text, its words in lower case parted by spaces and line ends, and its end, is predicted from
the bytes before it, whatever words and lines they belong to: ``byte_contexts.ORDER`` of them, else one
fewer, and so on down to none, and at last all symbols alike. A symbol not seen in a context is coded
as an escape and looked up in the next shorter context with the symbols already ruled out excluded.

Grams (context and symbol) are counted as rows and dealt to tasks by the three nearest bytes of the context,
so that each task holds all shorter contexts of its grams down to these three bytes; tables of
contexts shorter than that are bounded and handed to all tasks. A text's score is the sum over its grams: the
most frequent ones stand in a bounded table, the others are joined. A branch of very many grams is split by further bytes,
its parts sharing the counts of its context.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from tamiz.llm import byte_contexts
from tamiz.llm.common import fold, small_batches, stored

#: Most frequent words whose scores every task holds; all other words are joined.
SHARED_WORDS = 200_000
#: Longest word that is shared, in bytes: an unspaced text may be one word.
SHARED_BYTES = 64
#: Distinct words that a task counts before it sends them on.
COUNTED = 300_000
#: The end of a text is counted as the empty word.
END = b""


def lower_bytes(text: str | bytes | None) -> bytes:
    return (text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")).lower()


def lines_of(text: str | bytes | None) -> list[list[bytes]]:
    """Words of each line that has one, in lower case (A-Z)."""
    return [words for line in lower_bytes(text).split(b"\n") if (words := line.split())]


def vocabulary(docs: DataFrame, text: str, learned: Column) -> DataFrame:
    """word, c: every word of the documents and the end, with its count in the documents to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value, learn in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist()):
                # A line end parts words like any white space.
                words = lower_bytes(value.as_py()).split()
                words.append(END)
                if learn:
                    counts.update(words)
                else:
                    for word in set(words):
                        counts.setdefault(word, 0)
                if len(counts) > COUNTED:
                    yield _counted(counts)
                    counts = Counter()
        if counts:
            yield _counted(counts)

    return (docs.select(F.col(text).alias("text"), learned.alias("learn")).mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("c")))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(counts.values(), pa.int64())],
                                      names=["word", "n"])


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = 7, held: int = 2,
          order: int = byte_contexts.ORDER, shared_words: int = SHARED_WORDS,
          shared_grams: int = byte_contexts.SHARED_GRAMS, unit_grams: int = byte_contexts.UNIT_GRAMS) -> DataFrame:
    """A row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the text in lower case and its end. ``score`` is the model's log10 probability
    of the running text; ``base_score`` that of add-one word frequencies. Both learn from the
    documents outside fold ``held`` of ``modulus``; these documents' own text counts when they are scored
    themselves. A NULL text is empty: its end is its only token. Repeated rows count and are scored
    each. Texts and words of any length are coded whole. An empty table gives no rows, and other columns play no part.
    ``order`` is from 3 to 6 bytes; none of the other numbers changes a score.
    """
    if not byte_contexts.BRANCH <= order <= 6:
        raise ValueError("order must be from 3 to 6")
    small_batches(docs.sparkSession)
    outside = fold(doc_id, modulus) != held
    words = stored(vocabulary(docs, text, outside), "vocabulary")
    tokens, kinds = words.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    tokens, kinds = tokens or 0, kinds or 0
    parts = byte_contexts.parts_of(docs, text)
    counted = stored(byte_contexts.count_grams(docs, text, outside, lines_of, order, parts), "grams")
    scored = stored(byte_contexts.scored_grams(counted, order, unit_grams, parts), "scored-grams")
    common = words.filter(F.octet_length("word") <= SHARED_BYTES).orderBy(F.desc("c"), "word").limit(shared_words).toArrow()
    # A word was learned if this is above 0.
    table = {w: float(np.log10(c + 1)) for w, c in zip(common.column("word").to_pylist(), common.column("c").to_pylist())}
    end = words.filter(F.col("word") == F.lit(END)).first()
    table[END] = float(np.log10(end["c"] + 1)) if end else 0.0
    shared = docs.sparkSession.sparkContext.broadcast((table, byte_contexts.frequent(scored, shared_grams)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words, known_grams = shared.value
        for batch in batches:
            out: list[list] = [[], [], [], []]
            texts = []
            for value in batch.column(2).cast(pa.binary()):
                base = known_words[END]
                n, known, rare = 1, int(base > 0), []
                lines = lines_of(value.as_py())
                for line in lines:
                    for word in line:
                        log = known_words.get(word)
                        if log is None:
                            rare.append(word)
                        else:
                            known += log > 0
                            base += log
                    n += len(line)
                texts.append(byte_contexts.running_text(lines, order))
                for column, v in zip(out, (n, known, base, rare)):
                    column.append(v)
            logs, grams, times = [], [], []
            for total, gram, n in byte_contexts.text_logs(texts, known_grams, order):
                logs.append(total)
                grams.append(gram)
                times.append(n)
            offsets = np.concatenate([[0], np.cumsum([len(g) for g in grams], dtype=np.int64)]).astype(np.int32)
            flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (grams, times)]
            pairs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in flat], names=["g", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(o, k) for o, k in zip(
                    [*out, logs], (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.float64()))],
                 pa.ListArray.from_arrays(pa.array(offsets), pairs)],
                names=["doc_id", "held_out", "n_tokens", "known", "base", "rare", "ppm", "grams"])

    kind = docs.schema[doc_id].dataType.simpleString()
    half = stored(docs.select(F.col(doc_id).alias("doc_id"), (~outside).alias("held_out"), F.col(text).alias("text"))
                  .mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, "
                                   "rare array<binary>, ppm double, grams array<struct<g: bigint, n: bigint>>")
                  .withColumn("row", F.monotonically_increasing_id()), "half-scored")
    words_more = half.select("row", F.explode("rare").alias("word")).join(words, "word").groupBy("row").agg(
        F.count(F.when(F.col("c") > 0, 1)).alias("known2"), F.sum(F.log10(F.col("c") + 1)).alias("base2")).withColumnRenamed("row", "of2")
    grams_more = (half.select("row", F.explode("grams").alias("x")).select("row", F.col("x.g").alias("gram"), F.col("x.n").alias("times"))
                  .join(scored.select("gram", "log10p"), "gram").groupBy("row")
                  .agg(F.sum(F.col("times") * F.col("log10p")).alias("ppm2")).withColumnRenamed("row", "of3"))
    zero, nought = F.lit(0), F.lit(0.0)
    floor = float(np.log10(tokens + 1.0 * (kinds + 1)))
    return (half.drop("rare", "grams").join(words_more, F.col("row") == F.col("of2"), "left")
            .join(grams_more, F.col("row") == F.col("of3"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known2", zero)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", nought) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("ppm") + F.coalesce("ppm2", nought)).alias("score")))
