"""Incremental refresh of a stored cube."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.periods import period_date, period_of
from tamiz.operators.universe import current_periods, is_malformed, since_months
from tamiz.plans.cube import quality_cube
from tamiz.sinks.versions import newest, read_version, write_version


def versions_of(path: str) -> str:
    """The folder of the versions behind a cube stored at ``path``."""
    return f"{path.rstrip('/')}.versions"


def read_cube(spark: SparkSession, path: str) -> DataFrame:
    """The last whole version of a refreshed cube; one stored without versions is read as it is."""
    root = versions_of(path)
    return spark.read.parquet(path) if newest(spark, root) is None else read_version(spark, root)


def closed_periods(df: DataFrame, path: str) -> DataFrame:
    """Stored periods that were calculated after their month had ended.

    A period last calculated while it was still open is not final and stays pending.
    """
    spark = df.sparkSession
    try:
        stored = read_cube(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], "periodo_contable int")
    month_end = F.add_months(period_date("periodo_contable"), 1)
    return (stored.groupBy("periodo_contable").agg(F.max("fecha_calculo").alias("_at"))
            .filter(F.col("_at") >= month_end).select("periodo_contable"))


def pending_periods(df: DataFrame, path: str, as_of: date, *, months: int = 36) -> DataFrame:
    """Periods of the source not stored in final form; the current one is always pending."""
    source = current_periods(since_months(df, as_of, months)).withColumnRenamed("periodo", "periodo_contable")
    done = closed_periods(df, path).filter(F.col("periodo_contable") != period_of(as_of))
    return source.join(done, "periodo_contable", "left_anti")


def refresh_pending(df: DataFrame, path: str, as_of: date, *, months: int = 36,
                    stamp: datetime | None = None) -> list[int]:
    """Compute the pending periods and put them in the place of what is stored; safe to repeat.

    The pending months (real ones, so at most ``months`` and the future) come to the driver
    as a literal list that prunes the fact's partitions. Malformed periods, however many,
    are selected by predicate and always calculated again: they are what the period format
    rule reports. Of the stored cube only final months stay, so a malformed period that was
    corrected and a pending month that lost its rows go.

    The new cube, some forty rows a period, is written as a version beside the former one and then takes its
    place (:func:`read_cube`): a job that dies on the way leaves the former cube whole. Last, ``path`` itself gets a
    plain copy for readers without this library; it can be made again at any time from the version. The fact is read
    for the pending periods alone.
    """
    spark = df.sparkSession
    pending = pending_periods(df, path, as_of, months=months).filter(~is_malformed("periodo_contable"))
    periods = sorted(int(r.periodo_contable) for r in pending.collect())
    cube = quality_cube(df, as_of, periods=periods, malformed=True, stamp=stamp)
    final = closed_periods(df, path).filter(~F.col("periodo_contable").isin([*periods, period_of(as_of)]))
    if not final.isEmpty():
        cube = cube.unionByName(read_cube(spark, path).join(final, "periodo_contable", "left_semi"))
    write_version(cube.repartition("periodo_contable"), versions_of(path))
    publish(spark, path)
    return periods


def publish(spark: SparkSession, path: str) -> None:
    """Make the plain copy at ``path`` from the last whole version."""
    read_cube(spark, path).write.mode("overwrite").parquet(path)
