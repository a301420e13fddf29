"""Distinct policies as bitmaps: exact counts that add up over months, sources, quarters and years.

Every policy gets a number, dense and for good; a bitmap has the policies of a group in a bucket of 32,768 numbers. Bitmaps
of groups merge with ``bitmap_or_agg``, so any coarser group is counted from stored bitmaps without the movements.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import work_path

KEY = "policy_number"


def numbered(keys: DataFrame, known: DataFrame | None = None, key: str = KEY) -> DataFrame:
    """(key, number): the distinct keys of ``keys`` that ``known`` lacks, numbered on from its last number, from 0.

    NULL keys get none. Keys are put in ranges, each is numbered by itself from where the ranges before it end, so no task
    sorts all; only the sizes of the ranges reach the driver. The result is stored, since its numbers must not change.
    """
    spark = keys.sparkSession
    new = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    first = 0
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    path = work_path(spark, "ranges")
    new.repartitionByRange(key).withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranges = spark.read.parquet(path)
    starts, at = [], first
    for part, size in sorted((r["part"], r["count"]) for r in ranges.groupBy("part").count().collect()):
        starts.append((part, at))
        at += size
    offsets = spark.createDataFrame(starts, "part int, start bigint")
    order = Window.partitionBy("part").orderBy(key)
    return ranges.join(offsets, "part").select(key, (F.col("start") + F.row_number().over(order) - 1).alias("number"))


def bitmaps(df: DataFrame, numbers: DataFrame, by: Sequence[str], key: str = KEY) -> DataFrame:
    """(by, bucket, bitmap): the keys of each group of ``df``.

    Rows fold to one for each group and key before they meet the numbers, so a hot key is one row a task.
    """
    found = df.filter(F.col(key).isNotNull()).select(*by, key).distinct().join(numbers, key)
    position = F.bitmap_bit_position("number")
    return found.groupBy(*by, F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(position).alias("bitmap"))


def count_distinct_of(maps: DataFrame, by: Sequence[Column | str], name: str = "polizas") -> DataFrame:
    """Distinct keys of coarser groups, from bitmaps alone."""
    names = [F.col(b) if isinstance(b, str) else b for b in by]
    merged = maps.groupBy(*names, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    kept = [c for c in merged.columns if c not in ("bucket", "bitmap")]
    return merged.groupBy(*kept).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


def calendar_counts(maps: DataFrame, period: str = "accountable_period") -> DataFrame:
    """nivel, desde, polizas: distinct policies over all sources of every month, quarter and year, by its first period.

    Malformed periods are months of their own and belong to no quarter or year.
    """
    p = F.col(period)
    month = p % 100
    real = p.between(100001, 999912) & month.between(1, 12)
    levels = F.array(
        F.struct(F.lit("mes").alias("nivel"), p.alias("desde")),
        F.struct(F.lit("trimestre").alias("nivel"), F.when(real, p - (month - 1) % 3).alias("desde")),
        F.struct(F.lit("año").alias("nivel"), F.when(real, p - month + 1).alias("desde")))
    wide = maps.select(F.explode(levels).alias("l"), "bucket", "bitmap").select("l.nivel", "l.desde", "bucket", "bitmap").filter("desde is not null")
    return count_distinct_of(wide, ["nivel", "desde"])
