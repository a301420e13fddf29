"""Agreement of two tables: amounts, missing rows, mappings.

Both sides are stacked and grouped by key instead of joined. Repeated or hot keys fold
map-side and never pair up with each other, and NULL keys meet like any other value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.percent import pct
from tamiz.model import ACCURACY

EQUAL, DIFFERENT, LEFT_ONLY, RIGHT_ONLY = "igual", "distinto", "solo_izquierda", "solo_derecha"
OTHER_ROWS = "filas_distintas"


def _side(df: DataFrame, keys: Sequence[str], cols: Sequence[str], left: bool) -> DataFrame:
    other = [F.lit(None).cast(df.schema[c].dataType) for c in cols]
    own = [F.col(c) for c in cols]
    ls, rs = (own, other) if left else (other, own)
    return df.select(
        *keys, F.lit(int(left)).alias("_l"), F.lit(int(not left)).alias("_r"),
        *[v.alias(f"{c}_izquierda") for c, v in zip(cols, ls)], *[v.alias(f"{c}_derecha") for c, v in zip(cols, rs)])


def _stacked(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return _side(left, keys, cols, True).unionByName(_side(right, keys, cols, False))


def _presence():
    return F.when(F.col("filas_derecha") == 0, LEFT_ONLY).when(F.col("filas_izquierda") == 0, RIGHT_ONLY)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], cols: Sequence[str],
              tolerance: float | Sequence[float] = 0) -> DataFrame:
    """Compare amounts key by key; a repeated key is compared by its sum and its number of values.

    ``<col>_ok`` is true when both sides agree within ``tolerance`` (one for all or one for each column)
    and have as many values. A key whose amounts agree but whose rows are not as many on both sides
    is ``filas_distintas``.
    """
    both = _stacked(left, right, keys, cols).groupBy(*keys).agg(
        F.sum("_l").alias("filas_izquierda"), F.sum("_r").alias("filas_derecha"),
        *[F.sum(f"{c}_{side}").alias(f"{c}_{side}") for c in cols for side in ("izquierda", "derecha")],
        *[F.count(f"{c}_{side}").alias(f"_{c}_{side}") for c in cols for side in ("izquierda", "derecha")])
    limits = [tolerance] * len(cols) if isinstance(tolerance, (int, float)) else tolerance
    for c, limit in zip(cols, map(F.lit, limits), strict=True):
        a, b = F.col(f"{c}_izquierda"), F.col(f"{c}_derecha")
        as_many = F.col(f"_{c}_izquierda") == F.col(f"_{c}_derecha")
        both = both.withColumn(f"{c}_ok", as_many & (a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= limit, F.lit(False))))
    agree = F.lit(True)
    for c in cols:
        agree = agree & F.col(f"{c}_ok")
    alike = F.when(F.col("filas_izquierda") != F.col("filas_derecha"), OTHER_ROWS).otherwise(EQUAL)
    state = F.coalesce(_presence(), F.when(agree, alike).otherwise(DIFFERENT))
    return both.withColumn("estado", state).drop(*[f"_{c}_{side}" for c in cols for side in ("izquierda", "derecha")])


def reconcile_summary(result: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Disagreements per amount in the shape of rule counters, over the keys of either side."""
    missing = F.col("estado").isin(LEFT_ONLY, RIGHT_ONLY)
    wide = result.agg(F.count(F.lit(1)).alias("total_registros"),
                      *[F.count_if(missing | ~F.col(f"{c}_ok")).alias(c) for c in cols])
    long = wide.unpivot(["total_registros"], list(cols), "nombre_campo", "cantidad_mala")
    return long.select(
        F.lit(ACCURACY).alias("tipo_indicador"), "nombre_campo", "total_registros", "cantidad_mala",
        pct(F.col("total_registros") - F.col("cantidad_mala"), F.col("total_registros")).alias("porcentaje"))


def row_sync(base: DataFrame, view: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` that ``view`` has not yet, key by key; 0 means in sync."""
    per_key = (_stacked(base, view, keys, []).groupBy(*keys)
               .agg(F.sum("_l").alias("_base"), F.sum("_r").alias("_view")))
    return per_key.agg(
        F.coalesce(F.sum("_base"), F.lit(0)).alias("total_registros"),
        F.coalesce(F.sum(F.greatest(F.col("_base") - F.col("_view"), F.lit(0))), F.lit(0)).alias("filas_faltantes"))


def mapping_drift(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose values differ between two mappings, or that only one of them has.

    A key with several values is compared by all of them; the greatest of each side is shown. Each pair
    of key and value is folded first, so a key keeps no list.
    """
    sides = (left.select(F.col(key), F.col(value).alias("_v"), F.lit(True).alias("_l"), F.lit(False).alias("_r"))
             .unionByName(right.select(F.col(key), F.col(value).alias("_v"), F.lit(False).alias("_l"), F.lit(True).alias("_r"))))
    pairs = sides.groupBy(key, "_v").agg(F.bool_or("_l").alias("_l"), F.bool_or("_r").alias("_r"))
    both = pairs.groupBy(key).agg(
        F.max(F.when(F.col("_l"), F.col("_v"))).alias("valor_izquierda"),
        F.max(F.when(F.col("_r"), F.col("_v"))).alias("valor_derecha"),
        F.count_if("_l").alias("filas_izquierda"), F.count_if("_r").alias("filas_derecha"),
        F.bool_and(F.col("_l") & F.col("_r")).alias("_same"))
    state = F.coalesce(_presence(), F.when(F.col("_same"), EQUAL).otherwise(DIFFERENT))
    return both.withColumn("estado", state).filter(F.col("estado") != EQUAL).drop("filas_izquierda", "filas_derecha", "_same")
