"""A quality cube kept by merging: what each load adds is stored, and the cube is made from that.

Rule counters add up, day masks merge with ``bit_or`` and repeated keys need one number for each key. So a late load is read
alone, however large the fact is: its counters and masks are a few rows, and its keys are merged into a table bucketed by
key, whose rows are not sent again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.periods import period_date
from tamiz.mappings import with_label
from tamiz.model import KEY_FIELD
from tamiz.operators import availability as av
from tamiz.operators import counts
from tamiz.operators.uniqueness import repeated_keys
from tamiz.operators.universe import universe
from tamiz.plans.cube import CUBE_COLUMNS, with_calc_ts
from tamiz.rules import Rule, default_rules

#: What a load leaves behind, each in a folder of its own.
COUNTERS, PRODUCT_DAYS, MONTH_DAYS = "counters", "product_days", "month_days"
#: Masks by product and month together, from which a load's two kinds of masks are made.
DAYS = "days"
BUCKETS = 64


def add_load(load: DataFrame, load_id: str, path: str, *, rules: Sequence[Rule] | None = None) -> None:
    """Store the counters and day masks of a load below ``path``. A load that comes again takes its own place.

    ``load`` holds rows that no other load has. Only it is read: its measured rows for the counters, all of them once for both masks.
    """
    rules = default_rules() if rules is None else rules
    spark = load.sparkSession
    joint = f"{path}/{DAYS}/load={load_id}"
    av.joint_masks(load).write.mode("overwrite").parquet(joint)
    days = spark.read.parquet(joint)
    parts = {COUNTERS: counts.rule_counts(universe(load), rules), PRODUCT_DAYS: av.product_masks_of(days), MONTH_DAYS: av.month_masks_of(days)}
    for name, part in parts.items():
        part.write.mode("overwrite").parquet(f"{path}/{name}/load={load_id}")


def _stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}").drop("load")


def merged_counters(spark: SparkSession, path: str) -> DataFrame:
    """The rule counters of all loads together, one row a period."""
    parts = _stored(spark, path, COUNTERS)
    return parts.groupBy("accountable_period").agg(*[F.sum(c).alias(c) for c in parts.columns if c != "accountable_period"])


def merged_masks(spark: SparkSession, path: str, name: str) -> DataFrame:
    parts = _stored(spark, path, name)
    return parts.groupBy(*[c for c in parts.columns if c != "_mask"]).agg(F.bit_or("_mask").alias("_mask"))


def key_counts(df: DataFrame, key: str = KEY_FIELD, by: str = "accountable_period") -> DataFrame:
    """by, key, absent, rows: rows of each period and key of ``df``. A NULL key is 0 and ``absent``, a NULL period the least integer:
    buckets and joins need plain values."""
    return (universe(df).groupBy(by, key).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.coalesce(by, F.lit(-2147483648)).alias(by), F.coalesce(F.col(key), F.lit(0)).alias(key), F.col(key).isNull().alias("absent"), "rows"))


def store_keys(counted: DataFrame, table: str, *, key: str = KEY_FIELD, by: str = "accountable_period", buckets: int = BUCKETS) -> None:
    """Write key counts as a table bucketed by all that tells them apart."""
    columns = (by, key, "absent")
    counted.write.mode("errorifexists").format("parquet").bucketBy(buckets, *columns).sortBy(*columns).saveAsTable(table)


def merge_keys(state: DataFrame, load: DataFrame, *, key: str = KEY_FIELD, by: str = "accountable_period") -> DataFrame:
    """The key counts of ``state`` (a table of :func:`store_keys`) and of a new load together.

    The join keeps the table's buckets: its rows are read where they are, only the load's keys are sent to them.
    """
    new = key_counts(load, key, by).withColumnRenamed("rows", "more")
    rows = F.coalesce("rows", F.lit(0)) + F.coalesce("more", F.lit(0))
    return state.join(new.hint("shuffle_merge"), [by, key, "absent"], "full").select(by, key, "absent", rows.alias("rows"))


def uniqueness_of(state: DataFrame, *, key: str = KEY_FIELD, by: str = "accountable_period", nulls: str = "group") -> DataFrame:
    """Repeated keys per period from key counts; the first aggregate is already there."""
    plain = state.select(F.nullif(F.col(by), F.lit(-2147483648)).alias(by), F.when(~F.col("absent"), F.col(key)).alias(key), F.col("rows").alias("_rows"))
    return repeated_keys(plain, key, by, nulls=nulls)


def merged_cube(spark: SparkSession, path: str, keys: DataFrame, as_of: date, *, periods: Sequence[int], rules: Sequence[Rule] | None = None,
                nulls: str = "group", stamp: datetime | None = None) -> DataFrame:
    """The quality cube of the listed periods from what the loads left: the rows of ``quality_cube`` on all of them."""
    rules = default_rules() if rules is None else rules
    chosen = [int(p) for p in periods]
    wide = merged_counters(spark, path).filter(F.col("accountable_period").isin(chosen))
    real = F.col("periodo_contable").isin(chosen)
    parts = [
        counts.with_totals(counts.with_pct(counts.to_long(wide, rules))),
        uniqueness_of(keys.filter(F.col("accountable_period").isin(chosen)), nulls=nulls),
        av.rule4_of_days(av.days_of_masks(merged_masks(spark, path, PRODUCT_DAYS).filter(real)), as_of),
        av.month_of_masks(merged_masks(spark, path, MONTH_DAYS).filter(real), as_of).drop("hay_datos_mes"),
    ]
    cube = parts[0]
    for part in parts[1:]:
        cube = cube.unionByName(part)
    return with_calc_ts(with_label(cube).withColumn("periodo_fecha", period_date("periodo_contable")), stamp).select(*CUBE_COLUMNS)
