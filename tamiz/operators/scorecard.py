"""Scorecard measures over the quality cube.

The cube holds a few dozen rows per period; every measure here reads it once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.classify import band, dimension_label, is_error_row, trend_state
from tamiz.functions.percent import pct
from tamiz.model import (ACCURACY, AVAILABILITY, COMPARABLE_DIMENSIONS, COMPLETENESS, THRESHOLDS, VALIDITY,
                         Thresholds)

SCORE = "dq_score"


def _comparable(cube: DataFrame) -> DataFrame:
    return cube.filter(F.col("tipo_indicador").isin(*COMPARABLE_DIMENSIONS))


def error_rows(cube: DataFrame) -> DataFrame:
    """Rows that count each error once, flagged ``es_fila_error``."""
    return (cube.withColumn("es_fila_error", is_error_row(F.col("tipo_indicador"), F.col("es_total")))
            .filter(F.col("es_fila_error") == 1))


def with_dimension(cube: DataFrame) -> DataFrame:
    return cube.withColumn("dimension", dimension_label(F.col("tipo_indicador")))


def with_band(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    return cube.withColumn("banda", band(F.col("porcentaje"), F.col("nombre_campo"), thresholds))


def dimension_series(cube: DataFrame) -> DataFrame:
    return (_comparable(cube).filter(F.col("es_total") == 1)
            .select("periodo_contable", "tipo_indicador", "porcentaje"))


def dq_score(cube: DataFrame) -> DataFrame:
    """Mean of the comparable dimensions present in the period; availability stays out."""
    return (dimension_series(cube).groupBy("periodo_contable")
            .agg((F.sum("porcentaje").cast("double") / F.count("porcentaje")).alias(SCORE)))


def _by_period(cube: DataFrame) -> DataFrame:
    """One row per listed period: the four totals and the score."""
    value = {d: F.max(F.when((F.col("tipo_indicador") == d) & (F.col("es_total") == 1), F.col("porcentaje")))
             for d in COMPARABLE_DIMENSIONS}
    wide = cube.groupBy("periodo_contable").agg(*[v.alias(d) for d, v in value.items()])
    filled = sum((F.coalesce(F.col(d), F.lit(0)) for d in COMPARABLE_DIMENSIONS), F.lit(0))
    present = sum((F.col(d).isNotNull().cast("int") for d in COMPARABLE_DIMENSIONS), F.lit(0))
    return wide.select(
        "periodo_contable", *[F.col(d).cast("double").alias(d) for d in COMPARABLE_DIMENSIONS],
        (filled.cast("double") / F.nullif(present, F.lit(0))).alias(SCORE))


def deltas(cube: DataFrame) -> DataFrame:
    """Points gained or lost against the previous listed period, by dimension and score.

    "Previous" is the period before in the list (202512 for 202601), whatever dimensions
    it has; the window runs over one row per period.
    """
    order = Window.orderBy("periodo_contable")
    measures = [*COMPARABLE_DIMENSIONS, SCORE]
    rows = F.array(*[
        F.struct(F.lit(m).alias("tipo_indicador"), F.col(m).alias("actual"), F.col(f"_{m}").alias("anterior"))
        for m in measures])
    return (_by_period(cube)
            .select("*", F.lag("periodo_contable").over(order).alias("periodo_anterior"),
                    *[F.lag(m).over(order).alias(f"_{m}") for m in measures])
            .select("periodo_contable", "periodo_anterior", F.inline(rows))
            .filter(F.col("actual").isNotNull())
            .withColumn("delta", F.col("actual") - F.col("anterior")))


def trend(cube: DataFrame) -> DataFrame:
    """Current and previous value of each dimension with its direction."""
    return (deltas(cube).filter(F.col("tipo_indicador") != SCORE)
            .withColumn("tendencia", trend_state(F.col("delta"))))


def traffic_light(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Percentage, evaluated fields, rows and band of each comparable dimension."""
    total = F.col("es_total") == 1
    return (_comparable(cube).groupBy("periodo_contable", "tipo_indicador")
            .agg(F.max(F.when(total, F.col("porcentaje"))).alias("porcentaje"),
                 F.greatest(F.count_if(~total), F.lit(1)).alias("campos"),
                 F.max(F.when(total, F.col("total_registros"))).alias("total_registros"),
                 F.count_if(total).alias("_totals"))
            .filter(F.col("_totals") > 0).drop("_totals")
            .withColumn("banda", band(F.col("porcentaje"), None, thresholds)))


def field_detail(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Fields of completeness, validity and accuracy, worst first within each."""
    return (cube.filter(F.col("tipo_indicador").isin(COMPLETENESS, VALIDITY, ACCURACY) & (F.col("es_total") == 0))
            .select("periodo_contable", "tipo_indicador", "nombre_campo", "porcentaje", "cantidad_mala",
                    band(F.col("porcentaje"), None, thresholds).alias("banda"))
            .orderBy("periodo_contable", "tipo_indicador", "porcentaje", F.desc("cantidad_mala"), "nombre_campo"))


def remediation_list(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """All fields of all dimensions, the first to fix on top."""
    state = band(F.col("porcentaje"), None, thresholds)
    impact = F.when(state == "BUENO", "OK").otherwise(F.initcap(state))
    return (error_rows(cube)
            .select("periodo_contable", "nombre_campo", dimension_label(F.col("tipo_indicador")).alias("dimension"),
                    "porcentaje", "cantidad_mala", impact.alias("impacto"))
            .orderBy("periodo_contable", "porcentaje", F.desc("cantidad_mala"), "nombre_campo", "dimension"))


def _share(part: Column, whole: Column) -> Column:
    return pct(part, whole, when_empty=None)


def errors_by_dimension(cube: DataFrame) -> DataFrame:
    whole = F.sum("errores").over(Window.partitionBy("periodo_contable"))
    return (error_rows(cube).groupBy("periodo_contable", "tipo_indicador")
            .agg(F.sum("cantidad_mala").alias("errores"))
            .withColumn("_whole", whole)
            .select("periodo_contable", "tipo_indicador", "errores",
                    _share(F.col("errores"), F.col("_whole")).alias("pct_errores")))


def _ranked_fields(cube: DataFrame) -> DataFrame:
    period = Window.partitionBy("periodo_contable")
    worst = [F.desc("errores"), F.asc("nombre_campo")]
    running = period.orderBy(*worst).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    peers = period.orderBy(F.desc("errores")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (error_rows(cube).groupBy("periodo_contable", "nombre_campo").agg(F.sum("cantidad_mala").alias("errores"))
            .filter(F.col("errores") > 0)
            .select("*", F.row_number().over(period.orderBy(*worst)).alias("posicion"),
                    F.sum("errores").over(period).alias("_whole"),
                    F.sum("errores").over(running).alias("_running"),
                    F.sum("errores").over(peers).alias("_peers")))


def errors_by_field(cube: DataFrame, top: int = 10) -> DataFrame:
    """Fields with most errors over all dimensions; shares are of all errors."""
    return (_ranked_fields(cube).filter(F.col("posicion") <= top)
            .select("periodo_contable", "posicion", "nombre_campo", "errores",
                    _share(F.col("errores"), F.col("_whole")).alias("pct_errores")))


def pareto(cube: DataFrame, top: int = 10, *, ties: str = "rows") -> DataFrame:
    """Cumulative share of the worst fields; with ``ties='peers'`` equal counts share it."""
    if ties not in ("rows", "peers"):
        raise ValueError("ties must be 'rows' or 'peers'")
    running = F.col("_running" if ties == "rows" else "_peers")
    return (_ranked_fields(cube).filter(F.col("posicion") <= top)
            .select("periodo_contable", "posicion", "nombre_campo", "errores",
                    _share(F.col("errores"), F.col("_whole")).alias("pct_errores"),
                    _share(running, F.col("_whole")).alias("pct_acumulado")))


def drilldown(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Failing fields out of all fields, and their errors, by period and dimension."""
    total, failing = F.col("es_total") == 1, (F.col("es_total") == 0) & (F.col("cantidad_mala") > 0)
    return (_comparable(cube).groupBy("periodo_contable", "tipo_indicador")
            .agg(F.max(F.when(total, F.col("porcentaje"))).alias("porcentaje"),
                 F.count_if(failing).alias("campos_con_falla"), F.count_if(~total).alias("campos"),
                 F.coalesce(F.sum(F.when(~total, F.col("cantidad_mala"))), F.lit(0)).alias("errores"))
            .filter(F.col("porcentaje").isNotNull())
            .withColumn("banda", band(F.col("porcentaje"), None, thresholds)))


def drilldown_fields(cube: DataFrame, dimension: str, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Fields of one dimension, worst first, flagged when they fail."""
    return (cube.filter((F.col("tipo_indicador") == dimension) & (F.col("es_total") == 0))
            .select("periodo_contable", "nombre_campo", "porcentaje", "cantidad_mala",
                    (F.col("cantidad_mala") > 0).alias("falla"),
                    band(F.col("porcentaje"), None, thresholds).alias("banda"))
            .orderBy("periodo_contable", "porcentaje", F.desc("cantidad_mala"), "nombre_campo"))


def availability_tiles(cube: DataFrame, *, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    return with_band(cube.filter(F.col("tipo_indicador") == AVAILABILITY), thresholds=thresholds).select(
        "periodo_contable", "nombre_campo", "nombre_natural", "total_registros", "cantidad_mala", "porcentaje", "banda")


def vs_target(cube: DataFrame, target: float = THRESHOLDS.target) -> DataFrame:
    limit = F.lit(str(target)).cast("decimal(10,2)")
    return dimension_series(cube).withColumn("objetivo", limit).withColumn("brecha", F.col("porcentaje") - limit)


def measures(cube: DataFrame, by: Sequence[str] = ("periodo_contable", "tipo_indicador")) -> DataFrame:
    """Average quality, bad and evaluated rows, evaluated fields and last calculation."""
    detail_field = F.when(F.col("es_total") == 0, F.col("nombre_campo"))
    return cube.groupBy(*by).agg(
        (F.sum("porcentaje").cast("double") / F.count("porcentaje")).alias("calidad"),
        F.sum("cantidad_mala").alias("registros_malos"), F.sum("total_registros").alias("registros_evaluados"),
        F.greatest(F.count_distinct(detail_field), F.lit(1)).alias("campos_evaluados"),
        F.max("fecha_calculo").alias("fecha_calculo"))


def field_matrix(cube: DataFrame) -> DataFrame:
    """Percentage of each field (rows) in each comparable dimension (columns)."""
    return (error_rows(cube).groupBy("periodo_contable", "nombre_campo")
            .pivot("tipo_indicador", list(COMPARABLE_DIMENSIONS)).agg(F.max("porcentaje")))
