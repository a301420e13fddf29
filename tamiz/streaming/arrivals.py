"""Arrival monitoring on a stream of movements: the batch operators, kept up to date."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tamiz.model import ARRIVAL_SCHEMA
from tamiz.operators.availability import load_arrival
from tamiz.operators.universe import since_days

#: Versions of the table that stay readable behind the newest one.
KEPT_VERSIONS = 8


def stream_load_arrival(stream: DataFrame, as_of: date, *, days: int = 60, cutoff: time = time(11)) -> DataFrame:
    """``load_arrival`` over a stream.

    State is one row per data day from the window on (first and last landing, rows), so it
    needs no watermark: a late rewrite must still be able to update the last landing, and can
    never move the first one forward. The window starts ``days`` before ``as_of`` for as long as
    the stream runs; ``write_arrivals`` moves it on.
    """
    return load_arrival(stream, as_of, days=days, cutoff=cutoff)


def write_arrivals(arrivals: DataFrame, path: str, checkpoint: str, *, once: bool = True, days: int = 60,
                   today: Callable[[], date] | None = None) -> StreamingQuery:
    """Keep the arrival table below ``path`` current; each trigger writes a version of its own.

    A version is one file of a row per data day, so it appears whole, and it replaces the one written
    KEPT_VERSIONS triggers before: ``read_arrivals`` never meets a table that is being written.
    ``today`` is asked in every trigger and leaves out the days that its window has passed.
    """
    columns = [c for c in ARRIVAL_SCHEMA.fieldNames() if c != "fecha_calculo"]

    def replace(batch: DataFrame, number: int) -> None:
        rows = batch if today is None else since_days(batch, today(), days)
        (rows.select(*columns, "dias_atraso", F.lit(number).cast("bigint").alias("version"))
         .repartition(1).write.mode("overwrite").parquet(f"{path}/slot={number % KEPT_VERSIONS}"))

    writer = (arrivals.writeStream.outputMode("complete").foreachBatch(replace)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the arrival table. A slot that is being replaced is passed over."""
    versions = spark.read.option("ignoreMissingFiles", True).parquet(path)
    newest = versions.agg(F.max("version")).scalar()
    return versions.filter(F.col("version") == newest).drop("version", "slot")
