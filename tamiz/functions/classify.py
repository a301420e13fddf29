"""Threshold classifiers, as native columns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.model import STATE_ORDER, THRESHOLDS, Thresholds


def _exact(limit: float) -> Column:
    return F.lit(str(limit)).cast("decimal(9,4)")


def balance_state(value: Column, base: Column, t: Thresholds = THRESHOLDS) -> Column:
    """State of a change against its base.

    ``100*|v-b|/|b| > limit`` is tested as ``100*|v-b| > limit*|b|``: decimals stay exact
    at the limits, and the unrounded ratio decides.
    """
    change, size = F.abs(value - base) * 100, F.abs(base)
    return (F.when(base.isNull() | (base == 0), "Sin base")
            .when(change > size * _exact(t.balance_critical), "Crítica")
            .when(change > size * _exact(t.balance_warning), "Advertencia")
            .otherwise("Normal"))


def floor_state(pct: Column, warning: float, critical: float) -> Column:
    return (F.when(pct.isNull(), "Pendiente")
            .when(pct < _exact(critical), "Crítica")
            .when(pct < _exact(warning), "Advertencia")
            .otherwise("Normal"))


def dimension_state(pct: Column, t: Thresholds = THRESHOLDS) -> Column:
    return floor_state(pct, t.dimension_warning, t.dimension_critical)


def availability_state(pct: Column, t: Thresholds = THRESHOLDS) -> Column:
    return floor_state(pct, t.availability_warning, t.availability_critical)


def arrival_state(minutes: Column, t: Thresholds = THRESHOLDS) -> Column:
    return (F.when(minutes.isNull(), "Sin dato")
            .when(minutes <= t.arrival_warning_minutes, "Normal")
            .when(minutes <= t.arrival_critical_minutes, "Advertencia")
            .otherwise("Crítica"))


def band(pct: Column, key: Column | None = None, t: Thresholds = THRESHOLDS) -> Column:
    """Four-band state; ``key`` selects the limits of an indicator that has its own."""
    def bands(limits: tuple[float, float, float]) -> Column:
        good, alert, serious = (_exact(x) for x in limits)
        return (F.when(pct >= good, "BUENO").when(pct >= alert, "ALERTA")
                .when(pct >= serious, "GRAVE").when(pct.isNotNull(), "CRÍTICO"))

    result = bands(t.bands["default"])
    if key is not None:
        for name, limits in t.bands.items():
            if name != "default":
                result = F.when(key == name, bands(limits)).otherwise(result)
    return result


def trend_state(delta: Column) -> Column:
    return (F.when(delta.isNull(), "sin anterior")
            .when(F.abs(delta) < 0.005, "Estable")
            .when(delta > 0, "Mejora")
            .otherwise("Baja"))


def state_rank(state: Column) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(STATE_ORDER.items())])
    return F.coalesce(F.try_element_at(table, state), F.lit(9))


def is_error_row(dimension: Column, is_total: Column) -> Column:
    """1 on rows that count errors once: detail rows plus the uniqueness total."""
    return (F.when(dimension == "disponibilidad", 0).when(is_total == 0, 1)
            .when(dimension == "unicidad", 1).otherwise(0))


def dimension_label(dimension: Column) -> Column:
    known = ["completitud", "exactitud", "unicidad", "validez"]
    return F.when(dimension.isin(known), F.initcap(dimension)).otherwise(F.lit("Disponibilidad"))
