"""One query per operator, over the movement fact made from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz import mappings
from tamiz.functions import periods as per
from tamiz.model import ALERT_SCHEMA, ARRIVAL_SCHEMA, CUBE_SCHEMA, Thresholds
from tamiz.operators import alerts as al
from tamiz.operators import availability as av
from tamiz.operators import counts, distinct, premium, profile, reconcile, scorecard, uniqueness
from tamiz.operators import universe as un
from tamiz.plans import alerts as alert_plan
from tamiz.plans import cube as cube_plan
from tamiz.plans import refresh, state, views
from tamiz.rules import (accuracy_rules, completeness_rules, default_rules, optional_rules, validity_rules, with_explanation)
from tamiz.session import work_path
from tamiz.sinks.export import export_csv, export_json
from tamiz.sinks.snapshot import snapshot
from tamiz.sinks.versions import read_version
from tamiz.sources.csvs import CATALOGUE_COLUMNS, read_catalogue, read_dictionary, read_mapping
from tamiz.sources.movements import movements as conform_movements
from tamiz.sources.movements import read_movements, write_movements
from tamiz.sources.sqlfile import run_sql_file
from tamiz.streaming.arrivals import read_arrivals, stream_load_arrival, write_arrivals
from verification.fixture import AS_OF, STAMP, adapted, feed, from_lines, movements, table

SQL_DIR = Path(__file__).parent / "sql"
SCORE_MONTHS = 36

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text: the same in every engine."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def _cube(m: DataFrame) -> DataFrame:
    return cube_plan.quality_cube(m, AS_OF, months=SCORE_MONTHS, stamp=STAMP)


def _windowed(m: DataFrame) -> DataFrame:
    return un.since_months(un.universe(m), AS_OF, 36)


def _periods(m: DataFrame) -> list[int]:
    """The last twelve closed periods of the source and the open one."""
    return un.resolve_periods(m, AS_OF, 12)


def _by_source(m: DataFrame) -> DataFrame:
    return premium.premium_by_source(m, AS_OF, periods=_periods(m))


def _by_category(m: DataFrame) -> DataFrame:
    return premium.premium_by_category(m, AS_OF)


def _alerts(m: DataFrame) -> DataFrame:
    return alert_plan.alerts(m, AS_OF, stamp=STAMP)


def _event_balances(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("ts").cast("date")
    return (table(spark, sf, "events").groupBy(F.col("event_type").alias("ramo"), day.alias("fecha"))
            .agg(F.sum(F.col("value").cast("decimal(15,2)")).alias("prima_dia"))
            .withColumn("periodo_contable", per.period_of_ts("fecha")))


# ---- sources and sinks -------------------------------------------------------------------

def sample_rows(m: DataFrame) -> DataFrame:
    order = [F.asc_nulls_last(c) for c in m.columns]
    return profile.sample_rows(m, 10, order_by=order).select(
        "policy_transaction_movement_sk", "source_system", "accountable_period", "product_code",
        "transaction_date_sk", "transaction_delta_billed_premium_amount", "load_ts")


def _made(rows: DataFrame) -> DataFrame:
    return conform_movements(adapted(rows))


def partitioned_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact stored by period and read back, then counted by period."""
    path = work_path(spark, "fact")
    write_movements(feed(spark, sf), path, _made, by="month")
    fact = read_movements(spark, path)
    stored = un.in_periods(un.universe(fact), _periods(fact))
    return (stored.groupBy("accountable_period")
            .agg(F.count(F.lit(1)).alias("registros"),
                 F.sum("transaction_delta_billed_premium_amount").alias("prima_neta")))


def mapping_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A mapping written as CSV with a byte-order mark, read back and applied."""
    parts = table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ramo"),
        F.col("p_name").alias("product_description"), F.col("p_brand").alias("categoria"))
    path = work_path(spark, "mapping")
    export_csv(parts, path)
    lines = table(spark, sf, "lineitem").groupBy(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_code")).agg(
        F.count(F.lit(1)).alias("movimientos"))
    return (mappings.with_category(lines, read_mapping(spark, path))
            .groupBy("categoria_ramo").agg(F.sum("movimientos").alias("movimientos")))


def _dictionary(spark: SparkSession, sf: str, fields: list[str]) -> DataFrame:
    """A field dictionary of all parts as CSV, read back; the first parts take the names of ``fields``.

    Types are broken over two lines, some with their halves swapped; some fields have no text.
    """
    names = F.array(*map(F.lit, fields))
    cells = table(spark, sf, "part").withColumn("names", names).selectExpr(
        "coalesce(get(names, int(p_partkey - 1)), concat('parte_', p_partkey)) AS campo",
        "CASE WHEN p_partkey % 7 <> 0 THEN concat(p_name, ' \"', p_type, '\", sí') END AS descripcion",
        "CASE p_partkey % 3 WHEN 0 THEN concat('NUMERIC(16', char(10), '10)') "
        "WHEN 1 THEN concat('10)', char(10), 'NUMERIC(16') ELSE 'VARCHAR(50)' END AS tipo",
        "CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS ejemplo")
    path = work_path(spark, "dictionary")
    export_csv(cells, path)
    return read_dictionary(spark, path)


def dictionary_csv(spark: SparkSession, sf: str) -> DataFrame:
    return _dictionary(spark, sf, [])


def documented_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The fields of the fact with the definitions of a dictionary file."""
    m = movements(spark, sf)
    return profile.field_dictionary(m, _dictionary(spark, sf, m.columns))


def catalogue_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A rule catalogue of all parts as CSV with cells of several lines, read back."""
    logic = "concat('SUM(CASE', char(10), ' WHEN ', p_name, ' = \"', p_brand, '\"', char(10), ' THEN 1 END)')"
    cells = [f"concat(p_partkey, ' {c}') AS {c}" if i < 8 else f"CASE WHEN p_size % {i} = 0 THEN p_type END AS {c}"
             if i < 14 else f"{logic} AS {c}" for i, c in enumerate(CATALOGUE_COLUMNS)]
    path = work_path(spark, "catalogue")
    export_csv(table(spark, sf, "part").selectExpr(*cells), path)
    return read_catalogue(spark, path)


def _explained(m: DataFrame) -> DataFrame:
    return with_explanation(counts.rule_report(_windowed(m), default_rules())).select(
        "periodo_contable", "tipo_indicador", "nombre_campo", "total_registros", "cantidad_mala", "porcentaje", "es_total",
        "regla", "enmascarada", (F.length("explicacion") > 0).alias("explicada"),
        F.col("predicado").contains(F.col("nombre_campo")).alias("con_predicado"))


def _through_csv(source: DataFrame) -> DataFrame:
    """Written as CSV and read back."""
    path = work_path(source.sparkSession, "csv")
    export_csv(source, path)
    return source.sparkSession.read.schema(source.schema).option("header", True).csv(path)


def premium_csv(m: DataFrame) -> DataFrame:
    return _through_csv(_by_source(m))


def alerts_json(m: DataFrame) -> DataFrame:
    spark = m.sparkSession
    path = work_path(spark, "alerts-json")
    source = al.balance_alerts(al.daily_balance(m, AS_OF))
    export_json(source, path)
    return spark.read.schema(source.schema).json(path)


def _snapshot(df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    spark = df.sparkSession
    path = work_path(spark, name)
    name = f"snap_{path.rsplit('-', 1)[1]}"
    snapshot(df.limit(0), name, schema, path=path)
    snapshot(df, name, schema, path=path)
    spark.sql(f"DROP TABLE {name}")  # the versions are in a folder of their own and stay
    return read_version(spark, f"{path}.versions")


def refreshed_cube(m: DataFrame) -> DataFrame:
    """A cube stored in October, brought up to date in November."""
    spark = m.sparkSession
    path = work_path(spark, "refresh")
    october = AS_OF.replace(month=10, day=5)
    refresh.refresh_pending(m, path, october, stamp=STAMP.replace(month=10, day=5))
    refresh.refresh_pending(m, path, AS_OF, stamp=STAMP)
    return refresh.read_cube(spark, path).select(
        F.col("periodo_contable").cast("int").alias("periodo_contable"), "tipo_indicador", "nombre_campo",
        "total_registros", "cantidad_mala", "porcentaje", "es_total")


def alert_views(m: DataFrame) -> DataFrame:
    views.register_views(m, AS_OF, stamp=STAMP)
    return run_sql_file(m.sparkSession, SQL_DIR / "open_alerts.sql", {"estado": "Normal"})


def ordered_views(m: DataFrame) -> DataFrame:
    """Three views from files, given in the wrong order."""
    m.createOrReplaceTempView("movimientos")
    files = {name: SQL_DIR / f"{name}.sql" for name in ("vista_picos", "vista_meses", "vista_dias")}
    *_, last = views.register_sql_views(m.sparkSession, files, {"desde": per.period_floor(AS_OF, 36), "veces": 2})
    return m.sparkSession.table(last)


def stored_select(m: DataFrame) -> DataFrame:
    m.createOrReplaceTempView("movimientos")
    floor = per.date_key(per.months_back(AS_OF, 3))
    return run_sql_file(m.sparkSession, SQL_DIR / "daily_counts.sql", {"desde": floor})


def streamed_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    lines = (spark.readStream.schema(table(spark, sf, "lineitem").schema)
             .option("pathGlobFilter", "lineitem.parquet").parquet(sf))
    stream = from_lines(lines, table(spark, sf, "orders"), table(spark, sf, "part"))
    path = work_path(spark, "arrivals")
    query = write_arrivals(stream_load_arrival(stream, AS_OF), path, work_path(spark, "arrivals-state"))
    query.awaitTermination()
    return read_arrivals(spark, path)


# ---- kept by merging ---------------------------------------------------------------------

def _two_loads(m: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The fact as a first load and a late one, which repeats keys of the first."""
    late = F.pmod(F.hash("policy_number", "transaction_date_sk"), F.lit(5)) == 0
    return m.filter(~late), m.filter(late)


def _merged_keys(m: DataFrame) -> DataFrame:
    spark = m.sparkSession
    first, late = _two_loads(m)
    path = work_path(spark, "keys")
    name = f"keys_{path.rsplit('-', 1)[1]}"
    state.store_keys(state.key_counts(first), name, buckets=8)
    state.merge_keys(spark.table(name), late).write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


def late_load_cube(m: DataFrame) -> DataFrame:
    """The cube of two loads from what each left behind; the late one arrives twice and counts once."""
    spark = m.sparkSession
    path = work_path(spark, "loads")
    first, late = _two_loads(m)
    for name, load in (("1", first), ("2", late), ("2", late)):
        state.add_load(load, name, path)
    return state.merged_cube(spark, path, _merged_keys(m), AS_OF, periods=_periods(m), nulls="ignore", stamp=STAMP)


def distinct_by_calendar(m: DataFrame) -> DataFrame:
    """Policies of months, quarters and years from stored bitmaps of months and sources, numbered in two loads."""
    spark = m.sparkSession
    measured = un.universe(m)
    first, late = _two_loads(measured)
    paths = [work_path(spark, name) for name in ("numbers", "numbers", "bitmaps")]
    distinct.numbered(first).write.parquet(paths[0])
    known = spark.read.parquet(paths[0])
    known.unionByName(distinct.numbered(late, known)).write.parquet(paths[1])
    distinct.bitmaps(measured, spark.read.parquet(paths[1]), ["accountable_period", "source_system"]).write.parquet(paths[2])
    return distinct.calendar_counts(spark.read.parquet(paths[2]))


# ---- catalog -----------------------------------------------------------------------------

def _on_fact(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: plain(build(movements(spark, sf)))


def _on_tables(build: Query) -> Query:
    return lambda spark, sf: plain(build(spark, sf))


def _on_cube(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_fact(lambda m: build(_cube(m)))


def _on_alerts(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_fact(lambda m: build(_alerts(m).drop("fecha_calculo")))


def _event_days(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "events").select(F.col("ts").cast("date").alias("dia")).distinct()
    return days.select("dia", per.required_days("dia").alias("dias_regla4"),
                       per.required_days("dia", 31).alias("dias_mes"))


def _order_totals(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("clave"))
             .agg(F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("monto"),
                  F.min("l_linenumber").alias("linea")))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("clave"), F.col("o_totalprice").cast("decimal(15,2)").alias("monto"),
        F.lit(1).alias("linea"))
    return lines, orders


def _reconciled(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _order_totals(spark, sf)
    return reconcile.reconcile(left, right, ["clave"], ["monto", "linea"], tolerance=[50_000, 0])


def _nation_drift(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ramo"),
                                                    F.col("s_nationkey").alias("categoria"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("ramo"),
                                                    F.col("c_nationkey").alias("categoria"))
    return reconcile.mapping_drift(suppliers, customers, "ramo", "categoria")


def _pivot(m: DataFrame) -> DataFrame:
    periods = _periods(m)
    return counts.cube_pivot(cube_plan.quality_cube(m, AS_OF, periods=periods, stamp=STAMP), periods)


def _masked(m: DataFrame) -> DataFrame:
    return counts.masked_report(_windowed(m), un.since_months(m, AS_OF, 36), default_rules())


# ---- dirty input -------------------------------------------------------------------------

def csv_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Cells with outer spaces, quotes, commas, line ends and nothing, written as CSV and read back."""
    cells = table(spark, sf, "part").select(
        F.expr("concat(' ', p_partkey, ' ')").alias("ramo"),
        F.expr("concat('a \"', p_name, '\", ', char(10), p_type)").alias("product_description"),
        F.expr("CASE WHEN p_partkey % 7 <> 0 THEN concat(p_brand, ' ') END").alias("categoria"))
    path = work_path(spark, "cells")
    export_csv(cells, path)
    return read_mapping(spark, path)


def impossible_dates(m: DataFrame) -> DataFrame:
    """Every 15th of a month becomes a 45th: eight digits and no date."""
    key = F.col("transaction_date_sk")
    return m.withColumn("transaction_date_sk", F.when(key % 100 == 15, key + 30).otherwise(key))


def reconcile_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Sums agree on every key; some keys have another number of rows or of values."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("clave"), F.col("o_totalprice").cast("decimal(15,2)").alias("monto"))
    empty = F.lit(None).cast("decimal(15,2)").alias("monto")
    left = orders.unionByName(orders.filter("clave % 2 = 0").select("clave", empty))
    right = orders.unionByName(orders.filter("clave % 3 = 0").select("clave", (F.col("monto") * 0).alias("monto")))
    return reconcile.reconcile(left, right, ["clave"], ["monto"])


def mapping_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Mappings with several values for a key, of which one side lacks some."""
    left = table(spark, sf, "part").selectExpr("p_partkey div 3 AS ramo", "p_brand AS categoria", "p_size")
    return reconcile.mapping_drift(left, left.filter("p_size % 5 <> 0"), "ramo", "categoria")


def _loose(m: DataFrame) -> DataFrame:
    """Flags and times that arrive as text, some of which cannot be read."""
    def spoilt(name: str, digit: int, value: str):
        return F.when(F.col("branch_sk") % 10 == digit, value).otherwise(F.col(name).cast("string"))
    return m.withColumns({"current_record_flag": spoilt("current_record_flag", 3, "S"), "load_ts": spoilt("load_ts", 4, "n/a")})


def loose_types(m: DataFrame) -> DataFrame:
    return conform_movements(_loose(m)).groupBy("accountable_period").agg(
        F.count(F.lit(1)).alias("registros"), F.count_if(F.isnull("current_record_flag")).alias("marca_ausente"),
        F.count_if(F.isnull("load_ts")).alias("carga_ausente"))


def _with_bad_periods(m: DataFrame) -> DataFrame:
    period = F.col("accountable_period")
    bad = F.col("policy_transaction_movement_sk") % 3 == 0
    return m.withColumn("accountable_period", F.when(bad, (9_000_000 + F.col("transaction_date_sk") % 1_000_000).cast("int")).otherwise(period))


def many_bad_periods(spark: SparkSession, sf: str) -> DataFrame:
    """The fact with thousands of periods that are no months, stored and read back, counted by period."""
    path = work_path(spark, "fact")
    write_movements(feed(spark, sf), path, lambda rows: _with_bad_periods(_made(rows)), by="month")
    return (read_movements(spark, path).groupBy("accountable_period").agg(F.count(F.lit(1)).alias("registros"), F.min("transaction_date_sk").alias("primera")))


OWN_SCOPE = un.Scope(excluded_coverages=("8888", "3114"), sources=(("CO_iaxis", ("unificado-total", "not-unificado")), ("CO_as400", ())))


def refresh_after_correction(m: DataFrame) -> DataFrame:
    """Rows of the stored cube by period, after the malformed periods of the source were corrected."""
    spark = m.sparkSession
    path = work_path(spark, "refresh")
    refresh.refresh_pending(m, path, AS_OF, stamp=STAMP)
    period = F.col("accountable_period")
    refresh.refresh_pending(m.withColumn("accountable_period", F.when(period > 999999, F.expr(
        "int(accountable_period div 10)")).otherwise(period)), path, AS_OF, stamp=STAMP)
    return refresh.read_cube(spark, path).groupBy("periodo_contable").agg(F.count(F.lit(1)).alias("filas"))


def _emptied(m: DataFrame) -> DataFrame:
    """By source, with one listed month lost."""
    periods = _periods(m)
    return premium.premium_by_source(m.filter(F.col("accountable_period") != periods[len(periods) // 2]), AS_OF,
                                     periods=periods)


def _calendar(m: DataFrame) -> DataFrame:
    """Period and key columns of every distinct key, well formed or not."""
    keys = m.select("accountable_period", "transaction_date_sk").distinct()
    return keys.select(
        "accountable_period", "transaction_date_sk",
        per.period_date("accountable_period").alias("periodo_fecha"),
        per.period_label("accountable_period", AS_OF).alias("periodo_texto"),
        F.coalesce(per.valid_date_key("transaction_date_sk"), F.lit(False)).alias("clave_valida"),
        F.coalesce(per.same_month("transaction_date_sk", "accountable_period"), F.lit(False)).alias("mismo_mes"),
        per.date_of_key("transaction_date_sk").alias("fecha"))


def queries() -> dict[str, Query]:
    report = counts.rule_report
    catalog: dict[str, Query] = {
        # sources, sinks, jobs
        "sample_rows": _on_fact(sample_rows),
        "list_periods": _on_fact(un.list_periods),
        "load_spread": _on_fact(lambda m: av.load_spread(m, AS_OF)),
        "stored_select": _on_fact(stored_select),
        "partitioned_fact": _on_tables(partitioned_fact),
        "mapping_csv": _on_tables(mapping_csv),
        "premium_csv": _on_fact(premium_csv),
        "cube_csv": _on_fact(lambda m: _through_csv(_cube(m))),
        "mom_csv": _on_fact(lambda m: _through_csv(premium.mom_total(_by_category(m)))),
        "mom_by_category_csv": _on_fact(lambda m: _through_csv(premium.mom_by_category(_by_category(m)))),
        "alerts_json": _on_fact(alerts_json),
        "snapshot_cube": _on_fact(lambda m: _snapshot(_cube(m), "cube", CUBE_SCHEMA)),
        "snapshot_alerts": _on_fact(lambda m: _snapshot(_alerts(m), "alerts", ALERT_SCHEMA)),
        "snapshot_arrivals": _on_fact(lambda m: _snapshot(
            cube_plan.with_calc_ts(av.load_arrival(m, AS_OF), STAMP), "arrivals", ARRIVAL_SCHEMA)),
        "alert_views": _on_fact(alert_views),
        "ordered_views": _on_fact(ordered_views),
        "refreshed_cube": _on_fact(refreshed_cube),
        "field_dictionary": _on_fact(profile.field_dictionary),
        "documented_fields": _on_tables(documented_fields),
        "dictionary_csv": _on_tables(dictionary_csv),
        "catalogue_csv": _on_tables(catalogue_csv),
        # rows and periods
        "universe": _on_fact(lambda m: un.universe(m).select(
            "policy_transaction_movement_sk", "source_system", "accountable_period", "coverage_code", "receipt_type",
            "transaction_delta_billed_premium_amount")),
        "universe_own_scope": _on_fact(lambda m: un.universe(m, OWN_SCOPE).groupBy(
            "accountable_period", "source_system", "coverage_code", "receipt_type").agg(F.count(F.lit(1)).alias("registros"))),
        "window_months": _on_fact(lambda m: _windowed(m).groupBy("accountable_period").agg(
            F.count(F.lit(1)).alias("registros"))),
        "window_days": _on_fact(lambda m: un.since_days(m, AS_OF, 90).groupBy("transaction_date_sk").agg(
            F.count(F.lit(1)).alias("registros"))),
        "chosen_periods": _on_fact(lambda m: un.in_periods(m, _periods(m)[-3:]).groupBy(
            "accountable_period", "source_system").agg(F.count(F.lit(1)).alias("registros"))),
        "picked_periods": _on_fact(lambda m: un.pick_periods(m, AS_OF, 12)),
        "picked_closed_periods": _on_fact(lambda m: un.pick_periods(m, AS_OF, 6, include_current=False)),
        "required_days": _on_tables(_event_days),
        "calendar_columns": _on_fact(_calendar),
        # rules
        "completeness": _on_fact(lambda m: report(_windowed(m), completeness_rules())),
        "accuracy": _on_fact(lambda m: report(_windowed(m), accuracy_rules())),
        "validity": _on_fact(lambda m: report(_windowed(m), validity_rules())),
        "completeness_all_rows": _on_fact(lambda m: report(m, completeness_rules())),
        "accuracy_all_rows": _on_fact(lambda m: report(m, accuracy_rules())),
        "validity_all_rows": _on_fact(lambda m: report(m, validity_rules())),
        "optional_validity": _on_fact(lambda m: report(_windowed(m), optional_rules())),
        "masked_rules": _on_fact(_masked),
        "explained_rules": _on_fact(_explained),
        "rule_counters": _on_fact(lambda m: counts.rule_counts(_windowed(m), default_rules())),
        "dimension_totals": _on_fact(lambda m: counts.totals(counts.with_pct(counts.to_long(
            counts.rule_counts(_windowed(m), default_rules()), default_rules())))),
        "uniqueness": _on_fact(lambda m: uniqueness.uniqueness(_windowed(m))),
        "uniqueness_without_nulls": _on_fact(lambda m: uniqueness.uniqueness(_windowed(m), nulls="ignore")),
        "reconciled_amounts": _on_tables(_reconciled),
        "reconciliation_summary": _on_tables(
            lambda spark, sf: reconcile.reconcile_summary(_reconciled(spark, sf), ["monto", "linea"])),
        "row_sync": _on_tables(lambda spark, sf: reconcile.row_sync(
            table(spark, sf, "orders").select(F.col("o_orderkey").alias("clave")),
            table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("clave")), ["clave"])),
        # availability
        "availability_by_product": _on_fact(lambda m: av.availability_rule4(m, AS_OF)),
        "availability_by_description": _on_fact(lambda m: av.availability_rule4(
            m, AS_OF, months=96, product="transaction_type_description")),
        "availability_of_periods": _on_fact(lambda m: av.availability_rule4(m, AS_OF, periods=_periods(m))),
        "product_days": _on_fact(lambda m: av.product_days(m, AS_OF)),
        "availability_by_month": _on_fact(lambda m: av.availability_month(m, AS_OF)),
        "availability_every_month": _on_fact(lambda m: av.availability_month(
            m, AS_OF.replace(year=2002, month=1), every_month=True)),
        "daily_counts": _on_fact(lambda m: av.daily_counts(m, AS_OF)),
        "load_arrival": _on_fact(lambda m: av.load_arrival(m, AS_OF)),
        "streamed_arrivals": _on_tables(streamed_arrivals),
        # cube
        "quality_cube": _on_fact(lambda m: cube_plan.ordered(_cube(m))),
        "quality_cube_of_periods": _on_fact(lambda m: cube_plan.quality_cube(
            m, AS_OF, periods=_periods(m), nulls="ignore", stamp=STAMP)),
        "cube_pivot": _on_fact(_pivot),
        "short_labels": _on_cube(lambda c: mappings.with_short_label(c).select(
            "periodo_contable", "tipo_indicador", "nombre_campo", "nombre_natural", "nombre_corto")),
        # alerts
        "daily_balance": _on_fact(lambda m: al.daily_balance(m, AS_OF)),
        "balance_alerts": _on_fact(lambda m: al.balance_alerts(
            al.daily_balance(m, AS_OF), mapping=mappings.category_table(m.sparkSession))),
        "event_balance_alerts": _on_tables(lambda spark, sf: al.balance_alerts(_event_balances(spark, sf))),
        "dimension_alerts": _on_cube(al.dimension_alerts),
        "dimension_alerts_own_limits": _on_cube(lambda c: al.dimension_alerts(
            c, thresholds=Thresholds(dimension_warning=99.5, dimension_critical=98))),
        "integrity_pending": _on_cube(al.integrity_pending),
        "availability_alerts": _on_cube(al.availability_alerts),
        "arrival_alerts": _on_fact(lambda m: al.arrival_alerts(av.load_arrival(m, AS_OF))),
        "alerts": _on_fact(_alerts),
        "alerts_with_category": _on_fact(lambda m: alert_plan.alerts(
            m, AS_OF, stamp=STAMP, mapping=mappings.category_table(m.sparkSession))),
        "actionable_alerts": _on_alerts(lambda a: al.actionable(a, only_breaches=True)),
        "alert_summary": _on_alerts(al.alert_summary),
        "state_summary": _on_alerts(al.state_summary),
        "alert_panel": _on_alerts(al.actionable_panel),
        "balance_panel": _on_alerts(al.balance_panel),
        "dimension_panel": _on_alerts(al.dimension_panel),
        "arrival_panel": _on_alerts(al.arrival_panel),
        "latest_balances": _on_alerts(lambda a: al.latest(a, "fecha", within="ambito")),
        # scorecard
        "dimension_series": _on_cube(scorecard.dimension_series),
        "dq_score": _on_cube(scorecard.dq_score),
        "quality_bands": _on_cube(lambda c: scorecard.with_band(scorecard.with_dimension(c)).select(
            "periodo_contable", "dimension", "nombre_campo", "porcentaje", "banda")),
        "score_deltas": _on_cube(scorecard.deltas),
        "trend": _on_cube(scorecard.trend),
        "traffic_light": _on_cube(scorecard.traffic_light),
        "field_detail": _on_cube(scorecard.field_detail),
        "error_rows": _on_cube(lambda c: scorecard.error_rows(c).select(
            "periodo_contable", "tipo_indicador", "nombre_campo", "cantidad_mala", "es_fila_error")),
        "remediation_list": _on_cube(scorecard.remediation_list),
        "errors_by_dimension": _on_cube(scorecard.errors_by_dimension),
        "errors_by_field": _on_cube(scorecard.errors_by_field),
        "pareto": _on_cube(scorecard.pareto),
        "pareto_peers": _on_cube(lambda c: scorecard.pareto(c, ties="peers")),
        "drilldown": _on_cube(scorecard.drilldown),
        "drilldown_validity": _on_cube(lambda c: scorecard.drilldown_fields(c, "validez")),
        "availability_tiles": _on_cube(scorecard.availability_tiles),
        "target_gap": _on_cube(scorecard.vs_target),
        "cube_measures": _on_cube(scorecard.measures),
        "field_matrix": _on_cube(scorecard.field_matrix),
        # premium
        "premium_by_category": _on_fact(_by_category),
        "premium_by_source": _on_fact(_by_source),
        "premium_by_period": _on_fact(lambda m: premium.premium_by_period(_by_source(m))),
        "distinct_policies": _on_fact(lambda m: premium.distinct_policies(m, AS_OF, periods=_periods(m))),
        "aligned_series": _on_fact(lambda m: premium.aligned_series(_by_source(m), _periods(m))),
        "stacked_totals": _on_fact(lambda m: premium.stacked_totals(
            premium.aligned_series(_by_source(m), _periods(m)))),
        "premium_mom": _on_fact(lambda m: premium.mom_total(_by_category(m))),
        "premium_mom_absolute": _on_fact(lambda m: premium.mom_total(
            _by_category(m), signed_base=False, as_of=AS_OF)),
        "premium_mom_by_category": _on_fact(lambda m: premium.mom_by_category(_by_category(m))),
        "premium_mom_calendar": _on_fact(lambda m: premium.mom_by_category(_by_category(m), calendar=True)),
        "premium_mom_last_months": _on_fact(lambda m: premium.mom_last_months(premium.mom_total(_by_category(m)))),
        "premium_mom_newest": _on_fact(lambda m: premium.mom_newest_by_category(
            premium.mom_by_category(_by_category(m)))),
        "premium_net_change": _on_fact(lambda m: premium.net_change(
            premium.premium_by_period(_by_source(m)), _periods(m))),
        "filled_series": _on_fact(lambda m: premium.on_axis(_emptied(m), _periods(m), ["source_system"])),
        "net_change_after_empty_month": _on_fact(lambda m: premium.net_change(
            premium.premium_by_period(_emptied(m)), _periods(m))),
        # kept by merging
        "late_load_cube": _on_fact(late_load_cube),
        "uniqueness_of_two_loads": _on_fact(lambda m: state.uniqueness_of(un.since_months(_merged_keys(m), AS_OF, 36))),
        "distinct_by_calendar": _on_fact(distinct_by_calendar),
        # dirty input
        "csv_text_roundtrip": _on_tables(csv_text_roundtrip),
        "balances_with_impossible_dates": _on_fact(lambda m: al.daily_balance(impossible_dates(m), AS_OF)),
        "reconcile_row_counts": _on_tables(reconcile_row_counts),
        "mapping_conflicts": _on_tables(mapping_conflicts),
        "loose_types": _on_fact(loose_types),
        "loose_report": _on_fact(lambda m: counts.loose_report(_loose(m))),
        "many_bad_periods": _on_tables(many_bad_periods),
        "refresh_after_correction": _on_fact(refresh_after_correction),
        # mappings
        "unmapped_products": _on_fact(profile.unmapped_products),
        "mapping_drift": _on_tables(_nation_drift),
    }
    return catalog
