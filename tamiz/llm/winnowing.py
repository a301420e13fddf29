"""Document fingerprints by winnowing.

Hashes of all runs of ``GRAM`` characters are rolled along the text; of every ``WINDOW`` neighbouring
hashes the least is kept with its position, the rightmost of equal ones. Two texts that share
a passage of ``GRAM + WINDOW - 1`` characters share a kept hash. Runs have the same length in all texts, so any two
fingerprints can be compared; for texts under ``SHORT`` characters only the window shrinks, and they keep more of their
hashes. A text under ``GRAM`` characters is one run by itself: it is like its exact copies and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tamiz.llm.common import append_columns, mix64, small_batches

GRAM = 20
WINDOW = 40
SHORT = 160
BASE = 0x9E3779B97F4A7C15


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """32-bit hash of each run of ``gram`` characters; a shorter text is one run, an empty one none.

    The polynomial of a run is put together from those of runs of powers of two.
    """
    n = len(points)
    if not n:
        return np.empty(0, np.uint64)
    width = min(gram, n)
    with np.errstate(over="ignore"):
        power, base = points.astype(np.uint64) + np.uint64(1), np.uint64(BASE)
        out, done, step = None, 0, 1
        rest = width
        while rest:
            if rest & 1:
                if out is None:
                    out = power[done:]
                else:
                    size = min(len(out), len(power) - done)
                    out = out[:size] * base + power[done:done + size]
                done += step
            rest >>= 1
            if rest:
                power = power[:-step] * base + power[step:]
                base = base * base
                step *= 2
        return mix64(out[:n - width + 1]) >> np.uint64(32)


def winnow(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions, in order of position.

    A hash and its distance from the end make one number, so the least is the rightmost of the least;
    minima of windows are put together from those of windows of powers of two.
    """
    if len(points) < SHORT:
        window = max(1, window * len(points) // SHORT)
    hashes = gram_hashes(points, gram)
    n = len(hashes)
    if not n:
        return hashes, np.empty(0, np.int64)
    least = (hashes << np.uint64(32)) | np.arange(n - 1, -1, -1, dtype=np.uint64)
    width, step = min(window, n), 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if width > step:
        least = np.minimum(least[:len(least) - (width - step)], least[width - step:])
    keep = np.concatenate([[True], least[1:] != least[:-1]])
    kept = least[keep]
    return kept >> np.uint64(32), (n - 1 - (kept & np.uint64(0xFFFFFFFF)).astype(np.int64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of two sets of hashes; two empty ones are alike, an empty and another one not."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    return 2 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def written(hashes: np.ndarray) -> str:
    """Hashes in order of position, eight hexadecimal digits each."""
    return hashes.astype(">u4").tobytes().hex()


FIELDS = StructType([StructField("fingerprint", ArrayType(StructType([
    StructField("hash", LongType()), StructField("pos", IntegerType())])))])


def fingerprints(docs: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``fingerprint``, an array of (hash, pos) in order of position; empty for NULL or empty texts.

    One pass without a shuffle; equal texts get equal fingerprints. A column of that name is replaced.
    """

    def compute(texts: list) -> list[list]:
        out = []
        for value in texts:
            hashes, at = winnow(code_points(value), gram, window)
            out.append([{"hash": h, "pos": p} for h, p in zip(hashes.tolist(), at.tolist())])
        return [out]

    return append_columns(docs, text, FIELDS, compute)


def edit(text: str, following: str) -> str:
    """The last third of ``text``, rounded down, replaced by as many first characters of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def with_next(docs: DataFrame, doc_id: str, text: str, rows_per_range: int, most_ranges: int) -> DataFrame:
    """Rows (range, tail, doc_id, text): in the order of range, tail and descending id the next row is the next document.

    Ids are cut into ranges at their quantiles, and a range is a task. The first document of a range stands once more behind
    the range above it, the very first one behind the last range, both marked ``tail``. Only cuts and
    first ids reach the driver, at most ``most_ranges`` of them; each text is shuffled once. Documents
    with equal ids follow each other in the order of a hash of their text, NULL ids come last.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"))
    n = base.count()
    ranges = max(1, min(most_ranges, n // rows_per_range))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = np.unique(np.array(base.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] or [] if shares else [], np.int64))

    def place(ids: pa.Array) -> pa.Array:
        values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = len(cuts) - np.searchsorted(cuts, values, "left")
        at[ids.is_null().to_numpy(zero_copy_only=False)] = len(cuts) + 1
        return pa.array(at.astype(np.int32))

    placed = base.withColumn("range", F.arrow_udf(place, "int")(F.col("doc_id").cast("long")))
    heads = placed.groupBy("range").agg(F.max(F.struct("doc_id", F.bitwise_not("h").alias("h"))).alias("first")).select(
        "range", "first.doc_id", F.bitwise_not("first.h").alias("h")).orderBy("range").collect()
    before = [heads[i - 1]["range"] for i in range(len(heads))]
    marks = docs.sparkSession.createDataFrame(
        [(r["range"], r["doc_id"], r["h"], to) for r, to in zip(heads, before)],
        StructType([StructField("at", IntegerType()), StructField("id", docs.schema[doc_id].dataType),
                    StructField("hash", LongType()), StructField("to", IntegerType())]))
    marked = placed.join(F.broadcast(marks), (F.col("range") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("id"))
                         & (F.col("h") == F.col("hash")), "left")
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("tail"))
    again = F.struct(F.col("to").alias("range"), F.lit(True).alias("tail"))
    places = F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, again))
    return (marked.select(F.explode(places).alias("place"), "doc_id", "text", "h")
            .select("place.range", "place.tail", "doc_id", "text", "h").repartitionById(len(cuts) + 2, "range")
            .sortWithinPartitions("range", "tail", F.col("doc_id").desc_nulls_last(), "h"))


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM,
                      window: int = WINDOW, rows_per_range: int = 5_000, most_ranges: int = 65_536) -> DataFrame:
    """A row for each row of ``docs``: its fingerprint, that of its edited text, and how alike they are.

    The edited text ends like the next document, in descending order of the (integer) ids, begins; the
    first document follows the last. Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (kept hashes in order of position), near_edited, near_next. A NULL text is
    empty. Repeated rows follow each other and are compared. A lone document follows itself. Long texts are
    compared whole, an empty table gives no rows, and other columns play no part. A task holds two documents at a
    time however long its range.
    """

    small_batches(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for tail, key, value in zip(batch.column("tail").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text")):
                body = value.as_py() or ""
                kept = winnow(code_points(body), gram, window)[0]
                if held:
                    edited = edit(held[1], body)
                    new = winnow(code_points(edited), gram, window)[0]
                    row = (held[0], len(held[1]), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                           written(held[2]), written(new), likeness(held[2], new), likeness(held[2], kept))
                    for column, v in zip(out, row):
                        column.append(v)
                held = None if tail else (key, body, kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field("doc_id").type), pa.array(out[1], pa.int64()),
                 *[pa.array(o, pa.string()) for o in out[2:5]], *[pa.array(o, pa.float64()) for o in out[5:]]],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return with_next(docs, doc_id, text, rows_per_range, most_ranges).select("tail", "doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
