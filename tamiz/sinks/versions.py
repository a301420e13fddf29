"""Versions of a table in one folder: readers see the last whole one, whatever happens to a write.

A version's rows go to a slot of their own, which no reader is sent to; then one row in one file, the pointer, names
the slot. The file appears whole, so it is the commit. A write that dies before it leaves the former version in place,
and the next write starts from there. One job writes to a folder at a time; any number read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slots that take turns: a version stays readable until so many less one have followed it.
SLOTS = 4
POINTER = "version bigint, slot int, ddl string"


def newest(spark: SparkSession, root: str) -> tuple[int, int, T.StructType] | None:
    """Number, slot and schema of the last whole version; None if there is none."""
    try:
        rows = spark.read.schema(POINTER).parquet(f"{root}/pointer").filter("version is not null")
        found = rows.agg(F.max(F.struct("version", "slot", "ddl")).alias("last")).first()["last"]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return None if found is None else (found["version"], found["slot"], T.StructType.fromDDL(found["ddl"]))


def slot_path(root: str, slot: int) -> str:
    return f"{root}/rows/slot={slot}"


def write_version(df: DataFrame, root: str) -> int:
    """Write ``df`` as the next version and commit it. ``df`` may itself read the version before. Returns its number."""
    spark = df.sparkSession
    before = newest(spark, root)
    number = 1 if before is None else before[0] + 1
    slot = number % SLOTS
    df.write.mode("overwrite").parquet(slot_path(root, slot))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    pointer = spark.createDataFrame([(number, slot, ddl)], POINTER)
    pointer.coalesce(1).write.mode("overwrite").parquet(f"{root}/pointer/at={slot}")
    return number


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the last whole version."""
    found = newest(spark, root)
    if found is None:
        raise FileNotFoundError(f"no version below {root}")
    _, slot, schema = found
    return spark.read.schema(schema).parquet(slot_path(root, slot))
