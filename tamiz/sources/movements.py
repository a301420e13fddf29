"""The movement fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.periods import period_date
from tamiz.model import MOVEMENT_SCHEMA, conform

PERIOD, GIVEN = "accountable_period", "accountable_period_given"
#: The partition of every period that is no month; such a row keeps the value it came with in GIVEN.
MALFORMED = 0


def movements(df: DataFrame) -> DataFrame:
    """The measured columns of a fact, with the declared types."""
    return conform(df, MOVEMENT_SCHEMA)


def read_movements(spark: SparkSession, path: str) -> DataFrame:
    """Movements stored as Parquet, best partitioned by ``accountable_period``.

    Columns that already have the declared type are not touched, so period filters prune
    partitions and the other filters reach the row groups. Malformed periods that ``write_movements`` put in
    one partition get their values back; they are a read of their own, so the months are pruned as ever.
    """
    stored = spark.read.parquet(path)
    if GIVEN not in stored.columns:
        return movements(stored)
    malformed = stored.filter(F.col(PERIOD) == MALFORMED)
    months = movements(stored.filter(F.coalesce(F.col(PERIOD) != MALFORMED, F.lit(True))))
    if malformed.isEmpty():
        return movements(stored)
    return months.unionByName(movements(malformed.drop(PERIOD).withColumnRenamed(GIVEN, PERIOD)))


def read_movement_table(spark: SparkSession, table: str) -> DataFrame:
    return movements(spark.table(table))


def write_movements(df: DataFrame, path: str, made: Callable[[DataFrame], DataFrame] | None = None, *, by: str = PERIOD) -> None:
    """Store a fact by period, in the layout ``read_movements`` prunes.

    The rebalance gathers each period before writing, so files are few; a period that is
    too large is split at run time, a hundred tiny ones are merged. Rows are sorted by day within a
    file, so filters on the date key skip row groups. Periods that are no months share one partition, however many
    there are.

    Movements are several times as wide as the feed they are made from. With ``made``, ``df`` is such a feed: its rows are
    sent as they come, dealt by their column ``by``, and made movements where they are written. ``by`` should follow the period, so
    that files are few; what is stored does not depend on it.
    """
    if made is None:
        dealt = _by_partition(df).hint("rebalance", PERIOD)
    else:
        dealt = _by_partition(made(df.hint("rebalance", by)))
    dealt.sortWithinPartitions(PERIOD, "transaction_date_sk").write.partitionBy(PERIOD).parquet(path)


def _by_partition(df: DataFrame) -> DataFrame:
    bad = F.col(PERIOD).isNotNull() & period_date(PERIOD).isNull()
    return df.withColumn(GIVEN, F.when(bad, F.col(PERIOD))).withColumn(PERIOD, F.when(bad, MALFORMED).otherwise(F.col(PERIOD)))
