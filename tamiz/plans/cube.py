"""The quality cube: every indicator of every period in one long table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.periods import period_date
from tamiz.mappings import with_label
from tamiz.model import CUBE_SCHEMA
from tamiz.operators.availability import availability_month, availability_rule4
from tamiz.operators.counts import rule_report
from tamiz.operators.uniqueness import uniqueness
from tamiz.operators.universe import SCOPE, Scope, in_window, universe
from tamiz.rules import Rule, default_rules

CUBE_COLUMNS = CUBE_SCHEMA.fieldNames()


def with_calc_ts(df: DataFrame, stamp: datetime | None = None) -> DataFrame:
    """Calculation time: the given one, read in the session's zone, or the start of the query."""
    given = F.current_timestamp() if stamp is None else F.lit(stamp.isoformat(sep=" ")).cast("timestamp")
    return df.withColumn("fecha_calculo", given)


def quality_cube(df: DataFrame, as_of: date, *, months: int = 36, periods: Sequence[int] | None = None,
                 malformed: bool = False, rules: Sequence[Rule] | None = None, nulls: str = "group",
                 month_availability: bool = True, stamp: datetime | None = None, scope: Scope = SCOPE) -> DataFrame:
    """Rule counts, uniqueness and availability with labels, as one lazy plan.

    Covers the last ``months``, or ``periods`` when given (plus every malformed period
    with ``malformed``; the rolling window always has those above its floor).

    The fact is read once per grouping that cannot be shared: all rules by period, keys by
    period, day masks by product, day masks by period. Each read carries only its own
    columns. Persisting the universe instead would store most of the fact; reading narrow
    columns again is cheaper. Only the key count shuffles data in proportion to the fact.
    """
    rules = default_rules() if rules is None else rules
    measured = in_window(universe(df, scope), as_of, months, periods, malformed=malformed)
    parts = [
        rule_report(measured, rules),
        uniqueness(measured, nulls=nulls),
        availability_rule4(df, as_of, months=months, periods=periods),
    ]
    if month_availability:
        parts.append(availability_month(df, as_of, months=months, periods=periods).drop("hay_datos_mes"))
    cube = parts[0]
    for part in parts[1:]:
        cube = cube.unionByName(part)
    cube = with_label(cube).withColumn("periodo_fecha", period_date("periodo_contable"))
    return with_calc_ts(cube, stamp).select(*CUBE_COLUMNS)


def ordered(cube: DataFrame) -> DataFrame:
    return cube.orderBy("periodo_contable", "tipo_indicador", "es_total", "nombre_campo")
