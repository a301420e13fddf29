"""Did the data arrive: by product and day, by day of the month, by hour of the day.

Days of a month fit in one integer, so "which days have data" is a ``bit_or`` mask. It
merges map-side like a sum and needs no distinct shuffle. The shared universe does not
apply here.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.percent import pct
from tamiz.functions.periods import (date_key, date_of_key, days_back, days_in_period, elapsed_days, months_back,
                                     period_floor, period_of, period_of_key, period_of_ts, same_month,
                                     valid_date_key)
from tamiz.model import AVAILABILITY

RULE4, MONTH, ARRIVAL = "disponibilidad_regla4", "disponibilidad_mes", "hora_carga_11am"


def _day_bit(day: Column, last: int) -> Column:
    return F.when(day.between(1, last), F.call_function("shiftleft", F.lit(1).cast("bigint"), day.cast("int")))


def _days_set(mask: Column, up_to: Column | None = None) -> Column:
    if up_to is not None:
        mask = mask.bitwiseAND(F.call_function("shiftleft", F.lit(2).cast("bigint"), up_to) - 2)
    return F.coalesce(F.bit_count(mask), F.lit(0))


def _real(periods: Sequence[int]) -> list[int]:
    return [int(p) for p in periods if 100001 <= p <= 999912 and 1 <= p % 100 <= 12]


def _month_bounds(periods: Sequence[int]) -> tuple[date, date]:
    """First day of the first month and of the month after the last."""
    first, last = min(periods), max(periods)
    after = date(last // 100, last % 100, 28) + timedelta(days=4)
    return date(first // 100, first % 100, 1), after.replace(day=1)


def product_masks(df: DataFrame, days: int = 15, product: str = "product_code") -> DataFrame:
    """Days 1..``days`` with data as a bit mask, for each month of the accounting timestamp and product.

    Masks of parts of the rows merge with ``bit_or``.
    """
    return (df.groupBy(period_of_ts("transaction_accounting_ts").alias("periodo_contable"), F.col(product).alias("producto"))
            .agg(F.bit_or(_day_bit(_key_day(), days)).alias("_mask")))


def _key_day() -> Column:
    # Characters 7-8 of the printed key: the last two digits of a well-formed one, nothing
    # for a shorter key, so an odd key yields NULL instead of an error.
    return F.expr("try_cast(substring(cast(transaction_date_sk as string), 7, 2) as int)")


def joint_masks(df: DataFrame, days: int = 15, product: str = "product_code") -> DataFrame:
    """What ``product_masks`` and ``month_masks`` need of the rows, from one reading of them.

    One row for each month of the accounting timestamp, product, accounting period and whether the key is of that period.
    """
    period, key = F.col("accountable_period"), F.col("transaction_date_sk")
    same = F.coalesce(same_month(key, period), F.lit(False))
    return (df.groupBy(period_of_ts("transaction_accounting_ts").alias("mes"), F.col(product).alias("producto"), period.alias("periodo"),
                       same.alias("mismo_mes"))
            .agg(F.bit_or(_day_bit(_key_day(), days)).alias("_product"), F.bit_or(_day_bit(key % 100, 31)).alias("_month")))


def product_masks_of(joint: DataFrame) -> DataFrame:
    """``product_masks`` from :func:`joint_masks`."""
    return joint.groupBy(F.col("mes").alias("periodo_contable"), "producto").agg(F.bit_or("_product").alias("_mask"))


def month_masks_of(joint: DataFrame) -> DataFrame:
    """``month_masks`` from :func:`joint_masks`."""
    return joint.filter("mismo_mes").groupBy(F.col("periodo").alias("periodo_contable")).agg(F.bit_or("_month").alias("_mask"))


def product_days(df: DataFrame, as_of: date, *, months: int = 36, days: int = 15, product: str = "product_code",
                 periods: Sequence[int] | None = None) -> DataFrame:
    """Days 1..``days`` with data, for each month of the accounting timestamp and product."""
    ts = F.col("transaction_accounting_ts")
    if periods is None:
        df = df.filter(ts >= F.lit(months_back(as_of, months)))
    else:
        # Timestamps only ever fall in real months; the plain range is what prunes.
        periods = _real(periods)
        df = df.filter(period_of_ts(ts).isin(periods))
        if periods:
            low, high = _month_bounds(periods)
            df = df.filter((ts >= F.lit(low)) & (ts < F.lit(high)))
    return days_of_masks(product_masks(df, days, product))


def days_of_masks(masks: DataFrame) -> DataFrame:
    return masks.select("periodo_contable", "producto", _days_set(F.col("_mask")).alias("dias_presentes"))


def availability_rule4(df: DataFrame, as_of: date, *, months: int = 36, days: int = 15,
                       product: str = "product_code", periods: Sequence[int] | None = None) -> DataFrame:
    """Share of products with data on every required day of the month."""
    return rule4_of_days(product_days(df, as_of, months=months, days=days, product=product, periods=periods), as_of, days=days)


def rule4_of_days(by_product: DataFrame, as_of: date, *, days: int = 15) -> DataFrame:
    """Rule 4 from the days of each product."""
    needed = F.when(F.col("periodo_contable") == period_of(as_of), elapsed_days(as_of, days)).otherwise(days)
    by_period = (by_product.groupBy("periodo_contable")
                 .agg(F.count(F.lit(1)).alias("total_registros"),
                      F.count_if(F.col("dias_presentes") < needed).alias("cantidad_mala")))
    return by_period.select(
        "periodo_contable", F.lit(AVAILABILITY).alias("tipo_indicador"), F.lit(RULE4).alias("nombre_campo"),
        "total_registros", "cantidad_mala",
        pct(F.col("total_registros") - F.col("cantidad_mala"), F.col("total_registros")).alias("porcentaje"),
        F.lit(1).alias("es_total"))


def availability_month(df: DataFrame, as_of: date, *, months: int = 13, periods: Sequence[int] | None = None,
                       every_month: bool = False) -> DataFrame:
    """Days of each month with at least one movement of that month, over the required days.

    All days are required of a closed month, the elapsed ones of the current month. Zero
    required days give a NULL percentage. Months without data have no row unless
    ``every_month``, which adds the calendar months of the window (or the listed periods).
    """
    calendar = [period_of(months_back(as_of, back)) for back in range(months, -1, -1)] if periods is None else periods
    period, key = F.col("accountable_period"), F.col("transaction_date_sk")
    # A key of the same month is at least floor*100, and never more than 99999999: the plain
    # range prunes at the scan, the division does not.
    if periods is None:
        floor = period_floor(as_of, months)
        df = df.filter((period >= floor) & (key >= floor * 100))
    else:
        periods = _real(periods)
        df = df.filter(period.isin(periods))
        if periods:
            df = df.filter(key.between(min(periods) * 100, max(periods) * 100 + 99))
    by_period = month_masks(df)
    if every_month:
        months_listed = df.sparkSession.createDataFrame([(int(p), None) for p in calendar],
                                                        "periodo_contable int, _mask bigint")
        by_period = (by_period.unionByName(months_listed).groupBy("periodo_contable")
                     .agg(F.bit_or("_mask").alias("_mask")))
    return month_of_masks(by_period, as_of)


def month_masks(df: DataFrame) -> DataFrame:
    """Days of each month with a movement of that month as a bit mask; masks of parts merge with ``bit_or``."""
    period, key = F.col("accountable_period"), F.col("transaction_date_sk")
    return (df.filter(same_month(key, period)).groupBy(period.alias("periodo_contable"))
            .agg(F.bit_or(_day_bit(key % 100, 31)).alias("_mask")))


def month_of_masks(by_period: DataFrame, as_of: date) -> DataFrame:
    """Availability of each month from its days."""
    month_days = days_in_period("periodo_contable")
    needed = F.when(F.col("periodo_contable") == period_of(as_of),
                    F.least(F.lit(elapsed_days(as_of)), month_days)).otherwise(month_days)
    present = _days_set(F.col("_mask"), F.col("_needed"))
    return (by_period.withColumn("_needed", needed).withColumn("_present", F.when(F.col("_needed").isNotNull(), present))
            .select("periodo_contable", F.lit(AVAILABILITY).alias("tipo_indicador"), F.lit(MONTH).alias("nombre_campo"),
                    F.col("_needed").cast("bigint").alias("total_registros"),
                    (F.col("_needed") - F.col("_present")).cast("bigint").alias("cantidad_mala"),
                    pct(F.col("_present"), F.col("_needed"), when_empty=None).alias("porcentaje"),
                    F.lit(1).alias("es_total"),
                    (F.coalesce(F.col("_present"), F.lit(0)) > 0).alias("hay_datos_mes")))


def daily_counts(df: DataFrame, as_of: date, *, months: int = 3) -> DataFrame:
    """Rows per date key, newest first."""
    key = F.col("transaction_date_sk")
    return (df.filter(key >= date_key(months_back(as_of, months))).groupBy(key)
            .agg(F.count(F.lit(1)).alias("cantidad_registros")).orderBy(F.desc("transaction_date_sk")))


def load_spread(df: DataFrame, as_of: date, *, days: int = 10) -> DataFrame:
    """First and last load of each recent data day, to judge whether load times are real."""
    key = F.col("transaction_date_sk")
    return (df.filter(F.col("load_ts").isNotNull() & (key >= date_key(days_back(as_of, days)))).groupBy(key)
            .agg(F.count(F.lit(1)).alias("registros"), F.min("load_ts").alias("primera_carga"),
                 F.max("load_ts").alias("ultima_carga"))
            .orderBy(F.desc("transaction_date_sk")))


def arrivals_by_day(df: DataFrame, as_of: date, *, days: int = 60) -> DataFrame:
    """First landing, last rewrite and rows of each data day; also valid on a stream."""
    key = F.col("transaction_date_sk")
    return (df.filter(F.col("load_ts").isNotNull() & valid_date_key(key) & (key >= date_key(days_back(as_of, days))))
            .groupBy(key)
            .agg(F.min("load_ts").alias("arribo_datos"), F.max("load_ts").alias("ultima_escritura"),
                 F.count(F.lit(1)).alias("registros")))


def arrival_status(by_day: DataFrame, *, cutoff: time = time(11)) -> DataFrame:
    """Minutes against the cut-off of the arrival's own day, and on time or late.

    Minutes count clock minutes (10:59:30 is -1); on time or late is decided to the
    fraction of a second, so 11:00:30 is late by 0 minutes.
    """
    at = F.col("arribo_datos")
    minute_of_day = F.hour(at) * 60 + F.minute(at)
    seconds = minute_of_day * 60 + F.extract(F.lit("SECOND"), at)
    limit = cutoff.hour * 60 + cutoff.minute
    day = date_of_key("transaction_date_sk")
    return by_day.select(
        day.alias("fecha_datos"), "transaction_date_sk",
        period_of_key("transaction_date_sk").alias("periodo_contable"),
        F.lit(AVAILABILITY).alias("tipo_indicador"), F.lit(ARRIVAL).alias("nombre_campo"),
        "arribo_datos", F.date_format(at, "HH:mm:ss").alias("hora_arribo"), "ultima_escritura", "registros",
        (minute_of_day - limit).cast("bigint").alias("minutos_vs_corte"),
        F.when(seconds <= limit * 60 + cutoff.second, "A tiempo").otherwise("Tarde").alias("estado"),
        F.datediff(at.cast("date"), day).alias("dias_atraso"))


def load_arrival(df: DataFrame, as_of: date, *, days: int = 60, cutoff: time = time(11)) -> DataFrame:
    """Arrival of each data day of the last ``days``.

    The first landing is used because reprocessing rewrites old rows and moves the last
    one to today. ``dias_atraso`` shows days that landed late but early in the morning.
    """
    return arrival_status(arrivals_by_day(df, as_of, days=days), cutoff=cutoff)
