"""Alerts in one long format. The four scopes are not comparable with each other."""

from __future__ import annotations

from datetime import date, time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.classify import (arrival_state, availability_state, balance_state, dimension_state, state_rank)
from tamiz.functions.percent import change_pct
from tamiz.functions.periods import date_of_key, period_of_key, valid_date_key
from tamiz.mappings import with_category
from tamiz.model import AVAILABILITY, COMPARABLE_DIMENSIONS, PREMIUM, THRESHOLDS, Thresholds
from tamiz.operators.universe import since_days, universe

BALANCE, DIMENSION, ARRIVAL = "saldo_ramo", "dimension", "hora_carga"
ACTIONABLE = ("Advertencia", "Crítica")


def _number(value: float | None) -> Column:
    return F.lit(value).cast("double")


def _limit(value: float) -> Column:
    return F.lit(str(value)).cast("decimal(6,2)")


def daily_balance(df: DataFrame, as_of: date, *, days: int = 90) -> DataFrame:
    """Premium of each product and day of the last ``days``.

    Grouped on the raw key; keys are turned into dates after the aggregate. A key of eight digits
    that is no calendar date keeps its premium with a NULL ``fecha``, so balances add up to the window.
    """
    key = F.col("transaction_date_sk")
    return (since_days(universe(df), as_of, days).filter(valid_date_key(key))
            .groupBy(F.trim("product_code").alias("ramo"), key).agg(F.sum(PREMIUM).alias("prima_dia"))
            .select("ramo", date_of_key(key).alias("fecha"), period_of_key(key).alias("periodo_contable"), "prima_dia"))


def balance_alerts(daily: DataFrame, *, thresholds: Thresholds = THRESHOLDS,
                   mapping: DataFrame | None = None) -> DataFrame:
    """Change of each product's balance against its previous day with data.

    A balance without a date has no place in the sequence: it has no base and is nobody's base.
    The window sees one row per product and day, so a dominant product is no hot key. With
    ``mapping`` the business category is added as ``categoria``.
    """
    t = thresholds
    dated = F.col("fecha").isNotNull()
    by_day = Window.partitionBy("ramo", dated).orderBy("fecha")
    value, base = F.col("prima_dia"), F.col("_previous")
    rows = (daily.withColumn("_previous", F.when(dated, F.lag("prima_dia").over(by_day)))
            .withColumn("_previous_day", F.lag("fecha").over(by_day)))
    alerts = rows.select(
        F.lit(BALANCE).alias("ambito"), F.col("ramo").alias("clave"), F.col("ramo").alias("clave_natural"),
        "periodo_contable", "fecha",
        F.round(value, 2).cast("double").alias("valor"),
        F.round(base, 2).cast("double").alias("valor_referencia"),
        F.round(value - base, 2).cast("double").alias("variacion_abs"),
        change_pct(value, base, signed_base=False).alias("variacion_pct"),
        _limit(t.balance_warning).alias("umbral_adv"), _limit(t.balance_critical).alias("umbral_crit"),
        balance_state(value, base, t).alias("estado"),
        F.concat(F.lit("Saldo del día vs. día con datos anterior ("),
                 F.coalesce(F.date_format("_previous_day", "yyyy-MM-dd"), F.lit("s/d")),
                 F.lit(f"). Umbrales ±{t.balance_warning:g}% / ±{t.balance_critical:g}%.")).alias("detalle"))
    return alerts if mapping is None else with_category(alerts, mapping, product="clave", output="categoria")


def _total_alert(t: Thresholds) -> dict[str, Column]:
    """Alert columns of one total row of the cube."""
    dimension, pct = F.col("tipo_indicador"), F.col("porcentaje")
    own_band = dimension == AVAILABILITY

    def pick(available, comparable) -> Column:
        return F.when(own_band, available).otherwise(comparable)

    return {
        "ambito": pick(F.lit(AVAILABILITY), F.lit(DIMENSION)),
        "clave": pick(F.col("nombre_campo"), dimension),
        "clave_natural": pick(F.col("nombre_natural"), F.initcap(dimension)),
        "periodo_contable": F.col("periodo_contable"),
        "fecha": F.col("periodo_fecha"),
        "valor": pct.cast("double"),
        "valor_referencia": pick(_number(None), _number(t.dimension_warning)),
        "variacion_abs": _number(None),
        "variacion_pct": _number(None),
        "umbral_adv": pick(_limit(t.availability_warning), _limit(t.dimension_warning)),
        "umbral_crit": pick(_limit(t.availability_critical), _limit(t.dimension_critical)),
        "estado": pick(availability_state(pct, t), dimension_state(pct, t)),
        "detalle": pick(
            F.lit("Disponibilidad (días del mes con datos / ramos con días 1-15 completos). Banda laxa: "
                  "valores bajos son esperables."),
            F.lit(f"% de cumplimiento de la dimensión. Umbrales <{t.dimension_warning:g}% Advertencia, "
                  f"<{t.dimension_critical:g}% Crítica.")),
    }


def _integrity_alert(t: Thresholds) -> dict[str, Column]:
    return {
        "ambito": F.lit(DIMENSION), "clave": F.lit("integridad"), "clave_natural": F.lit("Integridad"),
        "periodo_contable": F.col("periodo_contable"), "fecha": F.col("periodo_fecha"),
        "valor": _number(None), "valor_referencia": _number(None),
        "variacion_abs": _number(None), "variacion_pct": _number(None),
        "umbral_adv": _limit(t.dimension_warning), "umbral_crit": _limit(t.dimension_critical),
        "estado": F.lit("Pendiente"), "detalle": F.lit("Integridad aún no tiene lógica definida."),
    }


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def _totals(cube: DataFrame) -> DataFrame:
    return cube.filter(F.col("es_total") == 1)


def dimension_alerts(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    return (_totals(cube).filter(F.col("tipo_indicador").isin(*COMPARABLE_DIMENSIONS))
            .select(*_aliased(_total_alert(thresholds))))


def availability_alerts(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    return (_totals(cube).filter(F.col("tipo_indicador") == AVAILABILITY)
            .select(*_aliased(_total_alert(thresholds))))


def integrity_pending(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """One pending row per period: integrity has no rule yet and must stay visible."""
    return (_totals(cube).select("periodo_contable", "periodo_fecha").distinct()
            .select(*_aliased(_integrity_alert(thresholds))))


def cube_alerts(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Dimension, availability and integrity alerts from one read of the cube.

    The first total row of each period also emits the integrity row. Three separate
    branches would compute the whole cube three times.
    """
    own, pending = (F.struct(*_aliased(c)) for c in (_total_alert(thresholds), _integrity_alert(thresholds)))
    first = F.row_number().over(
        Window.partitionBy("periodo_contable").orderBy("tipo_indicador", "nombre_campo")) == 1
    return (_totals(cube).withColumn("_first", first)
            .select(F.inline(F.when(F.col("_first"), F.array(own, pending)).otherwise(F.array(own)))))


def arrival_alerts(arrivals: DataFrame, *, thresholds: Thresholds = THRESHOLDS, cutoff: time = time(11)) -> DataFrame:
    """Landing time against the cut-off (that of ``arrivals``); minutes, negative when early."""
    t = thresholds
    # The texts that readers of the alert list know.
    short = f"{cutoff:%H:%M}" if cutoff.minute or cutoff.hour > 12 else f"{cutoff.hour}am"
    minutes = F.col("minutos_vs_corte")
    return arrivals.select(
        F.lit(ARRIVAL).alias("ambito"), F.col("nombre_campo").alias("clave"),
        F.lit(f"Hora de carga (corte {short})").alias("clave_natural"), "periodo_contable",
        F.col("fecha_datos").alias("fecha"), minutes.cast("double").alias("valor"),
        _number(0.0).alias("valor_referencia"), _number(None).alias("variacion_abs"),
        _number(None).alias("variacion_pct"), _limit(t.arrival_warning_minutes).alias("umbral_adv"),
        _limit(t.arrival_critical_minutes).alias("umbral_crit"), arrival_state(minutes, t).alias("estado"),
        F.concat(F.lit("Datos del día arribaron a las "), F.date_format("arribo_datos", "HH:mm"),
                 F.lit(f" (corte {cutoff:%H:%M}). Negativo = a tiempo.")).alias("detalle"))


# ---- reading the list -------------------------------------------------------------------

def actionable(alerts: DataFrame, *, only_breaches: bool = False) -> DataFrame:
    """Everything but Normal, or only Advertencia and Crítica."""
    state = F.col("estado")
    return alerts.filter(state.isin(*ACTIONABLE) if only_breaches else state != "Normal")


def alert_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("ambito", "estado").agg(F.count(F.lit(1)).alias("alertas"))


def state_summary(alerts: DataFrame) -> DataFrame:
    """Alerts by state over all scopes."""
    return alerts.groupBy("estado").agg(F.count(F.lit(1)).alias("alertas"))


def latest(df: DataFrame, column: str, *, within: str | None = None) -> DataFrame:
    """Rows holding the highest ``column`` (per ``within`` value), ties included.

    The maximum is an aggregate and then a filter: rows that tie stay where they are, however many.
    """
    keys = [F.col(within).alias("_within")] if within else []
    newest = df.groupBy(*keys).agg(F.max(column).alias("_newest")).filter("_newest IS NOT NULL")
    same = F.col(column) == F.col("_newest")
    if within:
        same = same & F.col(within).eqNullSafe(F.col("_within"))
    return df.join(newest, same, "left_semi")


def actionable_panel(alerts: DataFrame, top: int = 60) -> DataFrame:
    """Most urgent ``top`` open alerts of each scope, by state, then date, then key."""
    order = [state_rank(F.col("estado")), F.asc_nulls_first(F.col("fecha").cast("string")), F.col("clave"),
             F.col("periodo_contable")]
    position = F.row_number().over(Window.partitionBy("ambito").orderBy(*order))
    return actionable(alerts).withColumn("posicion", position).filter(F.col("posicion") <= top)


def balance_panel(alerts: DataFrame, top: int = 40) -> DataFrame:
    return (actionable(alerts).filter(F.col("ambito") == BALANCE)
            .orderBy(F.desc("fecha"), F.asc_nulls_first("clave")).limit(top))


def dimension_panel(alerts: DataFrame) -> DataFrame:
    return latest(alerts.filter(F.col("ambito") == DIMENSION), "periodo_contable").orderBy("clave_natural")


def arrival_panel(alerts: DataFrame, top: int = 30) -> DataFrame:
    return alerts.filter(F.col("ambito") == ARRIVAL).orderBy(F.desc("fecha")).limit(top)
