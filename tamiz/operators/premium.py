"""Monthly premium series and their changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.percent import change_pct
from tamiz.functions.periods import period_date
from tamiz.mappings import with_category
from tamiz.model import COMMISSION, PREMIUM
from tamiz.operators.universe import SCOPE, Scope, in_window, universe

MEASURES = ("movimientos", "polizas", "prima_neta", "prima_emitida", "prima_anulada", "comision")


def premium_by_category(df: DataFrame, as_of: date, mapping: DataFrame | None = None, *, months: int = 36,
                        periods: Sequence[int] | None = None, scope: Scope = SCOPE) -> DataFrame:
    """Net premium by month and business category.

    Products are summed first and looked up afterwards: the category join handles one row
    per period and product code instead of one per movement.
    """
    by_product = (in_window(universe(df, scope), as_of, months, periods)
                  .groupBy("accountable_period", F.trim("product_code").alias("product_code"))
                  .agg(F.sum(PREMIUM).alias("prima_neta")))
    return (with_category(by_product, mapping)
            .groupBy(period_date("accountable_period").alias("periodo_fecha"), "categoria_ramo")
            .agg(F.sum("prima_neta").alias("prima_neta")))


def _or_zero(amount):
    return F.coalesce(F.sum(amount), F.lit(0))


def premium_by_source(df: DataFrame, as_of: date, *, months: int = 36,
                      periods: Sequence[int] | None = None, scope: Scope = SCOPE) -> DataFrame:
    """Movements, distinct policies, net, issued and cancelled premium and commission.

    Amounts and distinct policies are separate aggregates: together, every policy would
    carry five running sums through the shuffle that finds it distinct. The two small
    results are stacked and folded; a join on the partition column would make one scan
    wait for the other (dynamic pruning) for nothing.
    """
    amount = F.col(PREMIUM)
    measured = in_window(universe(df, scope), as_of, months, periods).withColumnRenamed(
        "accountable_period", "periodo_contable")
    keys = ["periodo_contable", "source_system"]
    amounts = measured.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("movimientos"),
        _or_zero(amount).alias("prima_neta"),
        _or_zero(F.when(amount > 0, amount)).alias("prima_emitida"),
        _or_zero(F.when(amount < 0, amount)).alias("prima_anulada"),
        _or_zero(F.col(COMMISSION)).alias("comision"))
    policies = measured.groupBy(*keys).agg(F.count_distinct("policy_number").alias("polizas"))
    return (amounts.unionByName(policies, allowMissingColumns=True).groupBy(*keys)
            .agg(*[F.max(m).alias(m) for m in MEASURES]))


def premium_by_period(by_source: DataFrame) -> DataFrame:
    """All sources together. Policies are added up, so one in both sources counts twice."""
    return by_source.groupBy("periodo_contable").agg(*[F.sum(m).alias(m) for m in MEASURES])


def distinct_policies(df: DataFrame, as_of: date, *, months: int = 36,
                      periods: Sequence[int] | None = None, scope: Scope = SCOPE) -> DataFrame:
    """Policies of each period counted once across sources."""
    return (in_window(universe(df, scope), as_of, months, periods)
            .groupBy(F.col("accountable_period").alias("periodo_contable"))
            .agg(F.count_distinct("policy_number").alias("polizas")))


def aligned_series(by_source: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Net premium of every source at every listed period, zero where it has none.

    A pivot over the listed periods and back fills the gaps in one pass, without pairing
    sources with periods.
    """
    names = [str(int(p)) for p in periods]
    wide = (by_source.filter(F.col("source_system").isNotNull()).groupBy("source_system")
            .pivot("periodo_contable", [int(p) for p in periods]).agg(F.sum("prima_neta")))
    filled = wide.select("source_system", *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(n) for n in names])
    return (filled.unpivot(["source_system"], names, "periodo_contable", "prima_neta")
            .select(F.col("periodo_contable").cast("int").alias("periodo_contable"), "source_system", "prima_neta"))


def on_axis(rows: DataFrame, periods: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Every measure at every listed period (of each ``by``), zero where it has no row.

    ``rows`` has one row for a period and ``by``. Those of listed periods become one map, which the
    list bounds, and the list is laid over it: keys and periods are never paired by a join.
    """
    listed = [int(p) for p in dict.fromkeys(periods)]
    entry = F.struct("periodo_contable", F.struct(*MEASURES))
    found = F.map_from_entries(F.collect_list(F.when(F.col("periodo_contable").isin(listed), entry)))
    laid = (rows.groupBy(*by).agg(found.alias("_found"))
            .select(*by, F.explode(F.array(*map(F.lit, listed))).alias("periodo_contable"), "_found"))
    here = F.try_element_at("_found", F.col("periodo_contable"))
    return laid.select("periodo_contable", *by, *[F.coalesce(here[m], F.lit(0)).alias(m) for m in MEASURES])


def stacked_totals(series: DataFrame) -> DataFrame:
    return series.groupBy("periodo_contable").agg(F.sum("prima_neta").alias("prima_neta"))


def mom_total(by_category: DataFrame, *, signed_base: bool = True, as_of: date | None = None) -> DataFrame:
    """Month-over-month change of the total.

    The newest month present is the open one, or the calendar month of ``as_of`` when
    given. The window has no partition key: it runs over one row per month.
    """
    monthly = (by_category.filter(F.col("periodo_fecha").isNotNull()).groupBy("periodo_fecha")
               .agg(F.sum("prima_neta").alias("prima_neta")))
    order = Window.orderBy("periodo_fecha")
    previous = F.lag("prima_neta").over(order)
    newest = F.col("_next").isNull()
    is_open = newest if as_of is None else F.col("periodo_fecha") == F.lit(as_of.replace(day=1))
    return (monthly.withColumn("_previous", previous).withColumn("_next", F.lead("periodo_fecha").over(order))
            .select(F.date_format("periodo_fecha", "yyyy-MM").alias("periodo"), "periodo_fecha", "prima_neta",
                    (F.col("prima_neta") - F.col("_previous")).alias("var_abs_mom"),
                    change_pct(F.col("prima_neta"), F.col("_previous"), signed_base=signed_base,
                               digits=None).alias("var_pct_mom"),
                    is_open.alias("en_curso")))


def mom_by_category(by_category: DataFrame, *, signed_base: bool = True, calendar: bool = False) -> DataFrame:
    """Month-over-month change of each category against its previous month with data.

    ``calendar=True`` compares only with the month right before, leaving gaps without change.
    """
    rows = by_category.filter(F.col("periodo_fecha").isNotNull() & F.col("prima_neta").isNotNull())
    order = Window.partitionBy("categoria_ramo").orderBy("periodo_fecha")
    previous = F.lag("prima_neta").over(order)
    if calendar:
        consecutive = F.lag("periodo_fecha").over(order) == F.add_months("periodo_fecha", -1)
        previous = F.when(consecutive, previous)
    return (rows.withColumn("_previous", previous)
            .select(F.date_format("periodo_fecha", "yyyy-MM").alias("periodo"), "periodo_fecha", "categoria_ramo",
                    "prima_neta",
                    change_pct(F.col("prima_neta"), F.col("_previous"), signed_base=signed_base,
                               digits=None).alias("var_pct_mom")))


def mom_last_months(total: DataFrame, n: int = 12) -> DataFrame:
    return total.orderBy(F.desc("periodo_fecha")).limit(n)


def mom_newest_by_category(by_category_mom: DataFrame) -> DataFrame:
    """Categories of the newest month, largest change first.

    ``rank() = 1`` keeps only each task's newest month before rows are brought together.
    """
    newest = F.rank().over(Window.orderBy(F.desc("periodo_fecha")))
    return (by_category_mom.withColumn("_rank", newest).filter(F.col("_rank") == 1).drop("_rank")
            .orderBy(F.desc_nulls_last("var_pct_mom"), "categoria_ramo"))


def net_change(by_period: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Change of the net premium against the previous listed period, over its magnitude.

    A listed period without rows counts as zero, so the one after it has no change. The window runs
    over the listed periods only.
    """
    previous = F.lag("prima_neta").over(Window.orderBy("periodo_contable"))
    return (on_axis(by_period, periods).withColumn("_previous", previous)
            .withColumn("var_neta_pct", change_pct(F.col("prima_neta"), F.col("_previous"), signed_base=False))
            .drop("_previous"))
