"""Helpers that the text operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from tamiz.session import work_path

WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Texts are large rows: tasks of this session get at most BATCH_ROWS of them at once from now on."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; an id that is NULL counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def append_columns(df: DataFrame, source: str, fields: StructType,
                   compute: Callable[[list], list[list]]) -> DataFrame:
    """``df`` with new columns computed from the values of one column, batch by batch.

    ``compute`` gets the values of a batch and returns one list for each field. A column of
    ``df`` with the name of a new one is replaced.
    """
    small_batches(df.sparkSession)
    names = {f.name for f in fields}
    # The source may itself be replaced: it travels under a name of its own.
    carried = df.withColumn("__source", F.col(source)).drop(*names)
    out = StructType([f for f in carried.schema if f.name != "__source"] + list(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index("__source")
            new = compute(batch.column(at).to_pylist())
            old = [c for i, c in enumerate(batch.columns) if i != at]
            kept = [n for n in batch.schema.names if n != "__source"]
            yield pa.RecordBatch.from_arrays(
                old + [pa.array(v, type=to_arrow(f.dataType)) for v, f in zip(new, fields)],
                names=kept + [f.name for f in fields])

    return carried.mapInArrow(run, out)


def to_arrow(data_type) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(data_type)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with equal ``key`` from rows that arrive sorted by it, whole across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(key))
        codes = values.dictionary_encode()
        index = codes.indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(index[1:] != index[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            value = values[start].as_py()
            if held and value != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = value
    if held:
        yield pa.Table.from_batches(held)


def lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists without NULL."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    offsets = array.offsets.to_numpy()
    values = array.values.to_numpy(zero_copy_only=False)
    return values[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def ceil_div(a: int, b: int) -> int:
    return math.ceil(a / b)


class Bloom:
    """A Bloom filter of fixed size over 64-bit hashes: tells rows that a join would surely lose.

    It never says no to a key that was put in. Its size does not follow the data, so it may be handed
    to every task; with very many keys it says yes to all and the join alone decides.
    """

    BITS = 1 << 26
    HASHES = 4

    def __init__(self, keys: DataFrame, column: str):
        spots = F.explode(F.array(*[F.pmod(F.xxhash64(column, F.lit(i)), F.lit(self.BITS)) for i in range(self.HASHES)]))
        words = (keys.select(spots.alias("spot")).select((F.col("spot") / 64).cast("int").alias("word"),
                                                         (F.col("spot") % 64).cast("int").alias("bit"))
                 .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow())
        table = np.zeros(self.BITS // 64, np.uint64)
        table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
        self._table = keys.sparkSession.sparkContext.broadcast(table)

    def may_hold(self, column: Column) -> Column:
        """Whether a value may be among the keys."""
        shared = self._table

        def look(*spots: pa.Array) -> pa.Array:
            found = None
            for spot in spots:
                at = spot.to_numpy(zero_copy_only=False)
                bit = (shared.value[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)
                found = bit if found is None else found & bit
            return pa.array(found.astype(bool))

        spots = [F.pmod(F.xxhash64(column, F.lit(i)), F.lit(self.BITS)) for i in range(self.HASHES)]
        return F.arrow_udf(look, "boolean")(*spots)
