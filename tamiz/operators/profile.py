"""Getting to know a source: samples, columns, field dictionary, unmapped products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.mappings import category_table, lookup_table
from tamiz.model import PREMIUM
from tamiz.operators.universe import universe
from tamiz.rules import Rule, default_rules

UNDEFINED = "(pendiente de definir)"
UNIVERSE_FIELDS = ("accountable_period", "current_record_flag", "coverage_code",
                   "transaction_delta_billed_premium_amount", "source_system", "receipt_type")
RULE4_FIELDS = ("product_code", "transaction_date_sk")


def sample_rows(df: DataFrame, n: int = 10, *, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """``n`` current rows; with ``order_by`` the same ones every time."""
    rows = df.filter(F.col("current_record_flag") == 1)
    return (rows.orderBy(*order_by) if order_by else rows).limit(n)


def find_columns(df: DataFrame, type_like: Sequence[str] = ("%timestamp%",),
                 name_like: Sequence[str] = ("%ts%", "%load%", "%carga%", "%fecha%")) -> DataFrame:
    """Columns whose type or name looks like a load time, from the schema alone."""
    columns = lookup_table(df.sparkSession, [(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                           ["column_name", "data_type"])
    matches = F.lit(False)
    for pattern in type_like:
        matches = matches | F.col("data_type").ilike(pattern)
    for pattern in name_like:
        matches = matches | F.col("column_name").ilike(pattern)
    return columns.filter(matches).orderBy("column_name")


def field_dictionary(df: DataFrame, dictionary: DataFrame | None = None,
                     rules: Sequence[Rule] | None = None) -> DataFrame:
    """Each column of ``df`` with its type, definition, an example and the rules that use it.

    The example is the smallest non-null value: one aggregate for all columns, and the
    same answer on every run. Pass a sample when any example will do.
    """
    rules = default_rules() if rules is None else rules
    used: dict[str, list[str]] = {name: [] for name in df.columns}
    for r in rules:
        if r.field in used and r.dimension not in used[r.field]:
            used[r.field].append(r.dimension)
    if "policy_transaction_movement_sk" in used:
        used["policy_transaction_movement_sk"].append("unicidad")
    for name in RULE4_FIELDS:
        if name in used:
            used[name].append("disponibilidad (regla 4)")

    examples = df.agg(*[F.min(name).cast("string").alias(name) for name in df.columns])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("campo"), F.lit(f.dataType.simpleString()).alias("tipo_dato"),
                 F.col(f.name).alias("ejemplo"), F.lit(", ".join(used[f.name]) or "—").alias("reglas_dq"),
                 F.lit("sí" if f.name in UNIVERSE_FIELDS else "").alias("filtro_base"))
        for f in df.schema.fields])
    documented = examples.select(F.inline(rows))
    if dictionary is None:
        return documented.withColumn("definicion", F.lit(UNDEFINED))
    return (documented.join(dictionary.select("campo", "definicion"), "campo", "left")
            .withColumn("definicion", F.coalesce("definicion", F.lit(UNDEFINED))))


def unmapped_products(df: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Products of the universe without a category, and their share of the net premium.

    Product codes are summed first, so the lookup sees one row per code; the total is a
    scalar subquery over the same sums, never a window over all codes in one task. It asks for
    the rows of a code too, so that both take the same columns and the sums are computed once.
    """
    mapping = category_table(df.sparkSession) if mapping is None else mapping
    by_product = (universe(df).groupBy(F.trim("product_code").alias("ramo"))
                  .agg(F.count(F.lit(1)).alias("movimientos"), F.sum(PREMIUM).alias("prima_neta")))
    whole = by_product.agg(F.sum(F.when(F.col("movimientos") > 0, F.col("prima_neta")))).scalar()
    share = F.lit(100.0) * F.col("prima_neta").cast("double") / F.nullif(whole, F.lit(0)).cast("double")
    # An anti join would be moved below the sums, which then differ from those of the total.
    known = mapping.select(F.trim("ramo").alias("_known"))
    return (by_product.join(known, F.col("ramo") == F.col("_known"), "left").filter(F.col("_known").isNull())
            .select("ramo", "movimientos", "prima_neta", F.round(share, 2).alias("pct_prima")))
