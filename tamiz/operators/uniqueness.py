"""Repeated keys per period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.percent import pct
from tamiz.model import KEY_FIELD, UNIQUENESS


def uniqueness(df: DataFrame, key: str = KEY_FIELD, by: str = "accountable_period", *,
               nulls: str = "group") -> DataFrame:
    """Rows whose key repeats within the period; every one of them is bad.

    ``nulls='group'`` treats NULL keys as one repeated key, ``'ignore'`` never counts them.
    Two stacked aggregates replace a self join: the first shuffles on (period, key), with a
    hot or NULL key already folded to one row per task; the second shuffles one row per
    task and period.
    """
    return repeated_keys(df.groupBy(by, key).agg(F.count(F.lit(1)).alias("_rows")), key, by, nulls=nulls)


def repeated_keys(per_key: DataFrame, key: str = KEY_FIELD, by: str = "accountable_period", *, nulls: str = "group") -> DataFrame:
    """Uniqueness from the number of rows (``_rows``) of each period and key."""
    if nulls not in ("group", "ignore"):
        raise ValueError("nulls must be 'group' or 'ignore'")
    repeated = F.col("_rows") > 1
    if nulls == "ignore":
        repeated = repeated & F.col(key).isNotNull()
    per_period = per_key.groupBy(by).agg(
        F.sum("_rows").alias("total_registros"),
        F.sum(F.when(repeated, F.col("_rows")).otherwise(F.lit(0))).alias("cantidad_mala"))
    return per_period.select(
        F.col(by).alias("periodo_contable"),
        F.lit(UNIQUENESS).alias("tipo_indicador"),
        F.lit(key).alias("nombre_campo"),
        "total_registros", "cantidad_mala",
        pct(F.col("total_registros") - F.col("cantidad_mala"), F.col("total_registros")).alias("porcentaje"),
        F.lit(1).alias("es_total"))
