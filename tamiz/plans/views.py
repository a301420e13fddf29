"""Named views of the results, in dependency order."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date, datetime
from graphlib import CycleError, TopologicalSorter
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tamiz.operators.alerts import daily_balance
from tamiz.operators.availability import load_arrival
from tamiz.plans.alerts import combine
from tamiz.plans.cube import quality_cube, with_calc_ts
from tamiz.sources.sqlfile import run_sql_file, sql_text

CUBE_VIEW, ARRIVAL_VIEW, ALERT_VIEW = "vw_kpi_cubo_mensual", "vw_disponibilidad_hora_carga", "vw_alertas_primas"


def register_views(df: DataFrame, as_of: date, *, months: int = 36, stamp: datetime | None = None) -> list[str]:
    """Create or replace the cube, arrival and alert views; alerts read the first two."""
    spark = df.sparkSession
    quality_cube(df, as_of, months=months, stamp=stamp).createOrReplaceTempView(CUBE_VIEW)
    with_calc_ts(load_arrival(df, as_of), stamp).createOrReplaceTempView(ARRIVAL_VIEW)
    combine(daily_balance(df, as_of), spark.table(CUBE_VIEW), spark.table(ARRIVAL_VIEW),
            stamp=stamp).createOrReplaceTempView(ALERT_VIEW)
    return [CUBE_VIEW, ARRIVAL_VIEW, ALERT_VIEW]


def relations(spark: SparkSession, statement: str) -> set[str]:
    """Tables and views that a SELECT names anywhere, in lower case, as Spark's own parser reads it."""
    tree = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement).toString()
    return {name.replace(", ", ".").lower() for name in re.findall(r"'UnresolvedRelation \[([^\]]*)\]", tree)}


def register_sql_views(spark: SparkSession, files: Mapping[str, str | Path], args: Mapping[str, Any] | None = None) -> list[str]:
    """Create or replace a view for each stored SELECT, those that others read first, and return their names in that order.

    ``files``: view name to file, in any order. What a SELECT names beside these views must be there. Views that read each other
    in a circle, or themselves, are refused before any is made. Of ``args`` each statement gets the parameters it has.
    """
    texts = {name.lower(): sql_text(path) for name, path in files.items()}
    reads = {name: relations(spark, text) & texts.keys() for name, text in texts.items()}
    try:
        order = list(TopologicalSorter({name: sorted(of) for name, of in reads.items()}).static_order())
    except CycleError as circle:
        raise ValueError(f"views read each other: {' -> '.join(circle.args[1])}") from None
    paths = {name.lower(): path for name, path in files.items()}
    for name in order:
        wanted = {k: v for k, v in (args or {}).items() if re.search(rf":{re.escape(k)}\b", texts[name])}
        run_sql_file(spark, paths[name], wanted).createOrReplaceTempView(name)
    return order
