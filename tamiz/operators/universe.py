"""Which rows are measured: the shared universe, period and day windows, period lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.periods import date_key, days_back, months_back, period_date, period_floor, period_of
from tamiz.rules import AS400, IAXIS, UNIFIED_TOTAL

@dataclass(frozen=True)
class Scope:
    """What is measured: coverages left out, and the sources with the receipt types that each is measured without."""

    excluded_coverages: tuple[str, ...] = ("8888",)
    sources: tuple[tuple[str, tuple[str, ...]], ...] = ((IAXIS, (UNIFIED_TOTAL,)), (AS400, ()))


SCOPE = Scope()


def _none_of(column: str, values: Sequence[str]) -> Column:
    """Plain comparisons for one value, so the test of a common scope reaches the scan as it is."""
    return F.col(column) != values[0] if len(values) == 1 else ~F.col(column).isin(list(values))


def universe(df: DataFrame, scope: Scope = SCOPE) -> DataFrame:
    """Current rows with premium, of the sources and without the coverages and receipt types of ``scope``.

    By default without coverage 8888 and the unified totals of iaxis. Each condition is a plain comparison, so all but the
    OR reach the Parquet scan. A comparison with NULL is not true and drops the row.
    """
    kept = (F.col("current_record_flag") == 1)
    if scope.excluded_coverages:
        kept = kept & _none_of("coverage_code", scope.excluded_coverages)
    kept = kept & (F.col("transaction_delta_billed_premium_amount") != 0)
    of_source = [(F.col("source_system") == name) & _none_of("receipt_type", types) if types else F.col("source_system") == name
                 for name, types in scope.sources]
    return df.filter(kept & (reduce(Column.__or__, of_source) if of_source else F.lit(False)))


def since_months(df: DataFrame, as_of: date, months: int = 36, *, period: str = "accountable_period") -> DataFrame:
    """Rolling floor on the accounting period, whole first month included."""
    return df.filter(F.col(period) >= period_floor(as_of, months))


def since_days(df: DataFrame, as_of: date, days: int, *, key: str = "transaction_date_sk") -> DataFrame:
    return df.filter(F.col(key) >= date_key(days_back(as_of, days)))


def keys_since_months(df: DataFrame, as_of: date, months: int, *, key: str = "transaction_date_sk") -> DataFrame:
    return df.filter(F.col(key) >= date_key(months_back(as_of, months)))


def in_periods(df: DataFrame, periods: Sequence[int], *, malformed: bool = False,
               period: str = "accountable_period") -> DataFrame:
    """Listed periods; with ``malformed`` also every value that is no real period."""
    chosen = F.col(period).isin([int(p) for p in periods])
    return df.filter(chosen | is_malformed(period) if malformed else chosen)


def is_malformed(period: str = "accountable_period") -> Column:
    return F.col(period).isNotNull() & period_date(period).isNull()


def in_window(df: DataFrame, as_of: date, months: int, periods: Sequence[int] | None, *,
              malformed: bool = False) -> DataFrame:
    """Explicit periods when given, otherwise the rolling floor."""
    return since_months(df, as_of, months) if periods is None else in_periods(df, periods, malformed=malformed)


def current_periods(df: DataFrame) -> DataFrame:
    """Distinct periods of the current rows."""
    return (df.filter(F.col("current_record_flag") == 1)
            .select(F.col("accountable_period").alias("periodo")).distinct())


def list_periods(df: DataFrame) -> DataFrame:
    return current_periods(df).orderBy("periodo")


def pick_periods(df: DataFrame, as_of: date, n: int = 12, *, include_current: bool = True) -> DataFrame:
    """The last ``n`` closed periods, plus the current one if it has data.

    Works on the distinct periods only; the rank filter keeps ``n`` rows per task before
    anything is brought together.
    """
    current = period_of(as_of)
    is_current = F.col("periodo") == current
    listed = current_periods(df).filter(F.col("periodo") <= (current if include_current else current - 1))
    newest = Window.partitionBy("en_curso").orderBy(F.desc("periodo"))
    return (listed.withColumn("en_curso", is_current)
            .withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= n).drop("_n")
            .orderBy("periodo"))


def resolve_periods(df: DataFrame, as_of: date, n: int = 12, *, include_current: bool = True,
                    manual: Sequence[int] | None = None) -> list[int]:
    """Period list for ``in_periods``: manual if given, else detected (at most ``n + 1``)."""
    if manual:
        return sorted(int(p) for p in manual)
    found = [int(r.periodo) for r in pick_periods(df, as_of, n, include_current=include_current).collect()]
    if not found:
        raise ValueError("no periods found in the source")
    return found
