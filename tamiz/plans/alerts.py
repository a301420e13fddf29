"""The alert list: balances, dimensions, availability and arrivals in one table."""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import DataFrame

from tamiz.model import ALERT_SCHEMA, THRESHOLDS, Thresholds
from tamiz.operators.alerts import arrival_alerts, balance_alerts, cube_alerts, daily_balance
from tamiz.operators.availability import load_arrival
from tamiz.plans.cube import quality_cube, with_calc_ts


def combine(balances: DataFrame, cube: DataFrame, arrivals: DataFrame, *, thresholds: Thresholds = THRESHOLDS,
            stamp: datetime | None = None, cutoff: time = time(11), mapping: DataFrame | None = None) -> DataFrame:
    """One list from daily balances, a cube (computed or stored) and arrivals; ``cutoff`` is theirs.

    With ``mapping`` balances carry their business category as ``categoria``, NULL in the other scopes.
    """
    more = [] if mapping is None else ["categoria"]
    rows = (balance_alerts(balances, thresholds=thresholds, mapping=mapping)
            .unionByName(cube_alerts(cube, thresholds=thresholds), allowMissingColumns=bool(more))
            .unionByName(arrival_alerts(arrivals, thresholds=thresholds, cutoff=cutoff), allowMissingColumns=bool(more)))
    return with_calc_ts(rows, stamp).select(*ALERT_SCHEMA.fieldNames(), *more)


def alerts(df: DataFrame, as_of: date, *, cube: DataFrame | None = None, months: int = 36, balance_days: int = 90,
           arrival_days: int = 60, cutoff: time = time(11), thresholds: Thresholds = THRESHOLDS,
           stamp: datetime | None = None, mapping: DataFrame | None = None) -> DataFrame:
    """Alerts of the fact. Pass a stored ``cube`` to skip computing it again, a ``mapping`` for categories."""
    cube = quality_cube(df, as_of, months=months, stamp=stamp) if cube is None else cube
    return combine(daily_balance(df, as_of, days=balance_days), cube,
                   load_arrival(df, as_of, days=arrival_days, cutoff=cutoff), thresholds=thresholds, stamp=stamp,
                   cutoff=cutoff, mapping=mapping)
