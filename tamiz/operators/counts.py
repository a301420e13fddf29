"""Rule counters: one grouped pass over the fact, then long rows, percentages and totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.percent import mean_pct, pct
from tamiz.model import ACCURACY, COMPLETENESS, MOVEMENT_SCHEMA, VALIDITY, loose_columns
from tamiz.rules import Rule

TOTAL_NAMES = {ACCURACY: "TOTAL"}
DEFAULT_TOTAL_NAME = "TOTAL_PERIODO"


def rule_counts(df: DataFrame, rules: Sequence[Rule], by: str = "accountable_period") -> DataFrame:
    """All rule counters by period in a single aggregate.

    Each task emits one partial row per period it saw, so the shuffle carries a few
    hundred bytes per task and period however large or skewed the fact is.
    """
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("total_registros"), *[r.bad_rows() for r in rules])


def to_long(wide: DataFrame, rules: Sequence[Rule], by: str = "accountable_period") -> DataFrame:
    """One row per period and rule, generated from the wide row (no rescan, no shuffle)."""
    rows = ", ".join(
        f"struct('{r.dimension}' AS tipo_indicador, '{r.field}' AS nombre_campo, `{r.counter}` AS cantidad_mala)"
        for r in rules)
    return wide.select(F.col(by).alias("periodo_contable"), "total_registros", F.expr(f"inline(array({rows}))"))


def with_pct(long: DataFrame) -> DataFrame:
    good = F.col("total_registros") - F.col("cantidad_mala")
    return long.withColumn("porcentaje", pct(good, F.col("total_registros")))


def _total_name():
    name = F.lit(DEFAULT_TOTAL_NAME)
    for dimension, label in TOTAL_NAMES.items():
        name = F.when(F.col("tipo_indicador") == dimension, label).otherwise(name)
    return name


def _total_measures():
    return (F.max("total_registros").alias("total_registros"),
            F.sum("cantidad_mala").alias("cantidad_mala"),
            mean_pct(F.sum("porcentaje"), F.count("porcentaje")).alias("porcentaje"))


def totals(long: DataFrame) -> DataFrame:
    """Total row of each period and dimension: summed errors, mean of the percentages."""
    return (long.groupBy("periodo_contable", "tipo_indicador").agg(*_total_measures())
            .select("periodo_contable", "tipo_indicador", _total_name().alias("nombre_campo"),
                    "total_registros", "cantidad_mala", "porcentaje", F.lit(1).alias("es_total")))


def with_totals(long: DataFrame) -> DataFrame:
    """Detail and total rows together.

    Grouping sets keep it one pass: a union of the detail with ``totals(detail)`` would
    read the fact twice.
    """
    keys = ["periodo_contable", "tipo_indicador", "nombre_campo"]
    is_total = F.grouping("nombre_campo").cast("int").alias("es_total")
    grouped = long.groupingSets([[F.col(k) for k in keys], [F.col(k) for k in keys[:2]]], *keys).agg(
        *_total_measures(), is_total)
    return grouped.select(
        "periodo_contable", "tipo_indicador",
        F.when(F.col("es_total") == 1, _total_name()).otherwise(F.col("nombre_campo")).alias("nombre_campo"),
        "total_registros", "cantidad_mala", "porcentaje", "es_total")


def rule_report(df: DataFrame, rules: Sequence[Rule], by: str = "accountable_period") -> DataFrame:
    """Counts, percentages and totals of a set of rules over the rows of ``df``."""
    return with_totals(with_pct(to_long(rule_counts(df, rules, by), rules, by)))


def loose_report(raw: DataFrame, schema: T.StructType = MOVEMENT_SCHEMA, by: str = "accountable_period") -> DataFrame:
    """Absent and unreadable values of the columns of ``raw`` that arrive with another type than declared.

    A report on the fact as it came, before ``conform`` makes both NULL: a value that is not there is a fault of completeness,
    one that is there and cannot be read as its type ('n/a') a fault of validity. Two rows for each column and period,
    with the columns of ``rule_report``; one aggregate, as for the rules.
    """
    loose = [f for f in loose_columns(raw, schema) if f.name != by]
    period = F.col(by).try_cast(schema[by].dataType)
    counted, rows = [], []
    for f in loose:
        value = F.col(f.name)
        absent, unreadable = f"{COMPLETENESS}__{f.name}", f"{VALIDITY}__{f.name}"
        counted += [F.count_if(value.isNull()).alias(absent), F.count_if(value.isNotNull() & value.try_cast(f.dataType).isNull()).alias(unreadable)]
        rows += [F.struct(F.lit(d).alias("tipo_indicador"), F.lit(f.name).alias("nombre_campo"), F.col(c).alias("cantidad_mala"))
                 for d, c in ((COMPLETENESS, absent), (VALIDITY, unreadable))]
    if not rows:
        rows = [F.struct(F.lit("").alias("tipo_indicador"), F.lit("").alias("nombre_campo"), F.lit(0).cast("bigint").alias("cantidad_mala"))]
        raw = raw.limit(0)
    wide = raw.groupBy(period.alias("periodo_contable")).agg(F.count(F.lit(1)).alias("total_registros"), *counted)
    return with_pct(wide.select("periodo_contable", "total_registros", F.inline(F.array(*rows)))).select(
        "periodo_contable", "tipo_indicador", "nombre_campo", "total_registros", "cantidad_mala", "porcentaje", F.lit(0).alias("es_total"))


def masked_report(measured: DataFrame, rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Bad rows of each rule among the ``measured`` rows and among all ``rows``.

    ``enmascarada`` marks the rules that the universe keeps from ever firing.
    """
    sides = [to_long(rule_counts(df, rules), rules).withColumn("_in", F.lit(inside))
             for df, inside in ((measured, True), (rows, False))]
    masked = F.concat_ws("/", "tipo_indicador", "nombre_campo").isin(
        [f"{r.dimension}/{r.field}" for r in rules if r.masked])
    return (sides[0].unionByName(sides[1]).groupBy("tipo_indicador", "nombre_campo")
            .agg(F.sum(F.when(F.col("_in"), F.col("cantidad_mala"))).alias("en_universo"),
                 F.sum(F.when(~F.col("_in"), F.col("cantidad_mala"))).alias("en_todo"))
            .withColumn("enmascarada", masked))


def cube_pivot(cube: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Total percentages, indicator by period. Listed periods make the pivot one pass."""
    return (cube.filter(F.col("es_total") == 1).groupBy("tipo_indicador", "nombre_campo")
            .pivot("periodo_contable", [int(p) for p in periods]).agg(F.avg("porcentaje")))
