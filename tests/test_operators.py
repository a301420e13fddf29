from datetime import date, datetime, time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tamiz.model import conform
from tamiz.operators import availability, premium, profile, reconcile, uniqueness
from tamiz.operators import universe as un


# ---- universe and periods ---------------------------------------------------------------

def test_universe_follows_sql_null_logic(facts):
    key = "policy_transaction_movement_sk"
    kept = [{key: 1}, {key: 2, "source_system": "CO_as400", "receipt_type": None},
            {key: 3, "source_system": "CO_as400", "receipt_type": "unificado-total"}]
    dropped = [{"current_record_flag": 0}, {"current_record_flag": None}, {"coverage_code": "8888"},
               {"coverage_code": None}, {"transaction_delta_billed_premium_amount": Decimal(0)},
               {"transaction_delta_billed_premium_amount": None}, {"receipt_type": "unificado-total"},
               {"receipt_type": None}, {"source_system": None}, {"source_system": "Unknown"}]
    df = un.universe(facts(*kept, *[{key: 99, **row} for row in dropped]))
    assert sorted(r[0] for r in df.select(key).collect()) == [1, 2, 3]


def test_period_windows(facts, rows):
    df = facts(*[{"accountable_period": p} for p in (202011, 202012, 202312, 2024010)])
    assert rows(un.since_months(df, date(2023, 12, 5), 36), "accountable_period") == [(202012,), (202312,), (2024010,)]
    assert rows(un.in_periods(df, [202312, 1]), "accountable_period") == [(202312,)]


def test_period_detection(facts, rows):
    df = facts(*[{"accountable_period": p} for p in (202309, 202310, 202311, 202311, 202401, 202402)],
               {"accountable_period": 202312, "current_record_flag": 0})
    as_of = date(2024, 1, 20)
    assert rows(un.pick_periods(df, as_of, 2)) == [(202310, False), (202311, False), (202401, True)]
    assert un.resolve_periods(df, as_of, 2, include_current=False) == [202310, 202311]
    assert un.resolve_periods(df, as_of, manual=[202402, 202309]) == [202309, 202402]
    with pytest.raises(ValueError):
        un.resolve_periods(df, date(2020, 1, 1))


# ---- uniqueness ---------------------------------------------------------------------------

def test_uniqueness_counts_every_row_of_a_repeated_key(facts, rows):
    key = "policy_transaction_movement_sk"
    df = facts({key: 1}, {key: 1}, {key: 1}, {key: 2}, {key: None}, {key: None}, {key: 1, "accountable_period": 202402})
    columns = ("periodo_contable", "total_registros", "cantidad_mala", "porcentaje")
    assert rows(uniqueness.uniqueness(df), *columns) == [(202401, 6, 5, 16.67), (202402, 1, 0, 100.0)]
    assert rows(uniqueness.uniqueness(df, nulls="ignore"), *columns) == [(202401, 6, 3, 50.0), (202402, 1, 0, 100.0)]
    with pytest.raises(ValueError):
        uniqueness.uniqueness(df, nulls="drop")


def test_a_dominant_key_stays_whole(spark, rows):
    df = spark.range(90_000).select(F.lit(202401).alias("accountable_period"),
                                    F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id")).alias("k"))
    assert rows(uniqueness.uniqueness(df, key="k"), "total_registros", "cantidad_mala") == [(90_000, 30_000)]


# ---- availability -------------------------------------------------------------------------

def days(product, days_, period=202401, **more):
    base = {"product_code": product, "accountable_period": period,
            "transaction_accounting_ts": datetime(period // 100, period % 100, 20)}
    return [{**base, "transaction_date_sk": period * 100 + d, **more} for d in days_]


def test_rule4_requires_every_day(facts, rows):
    df = facts(*days("A", range(1, 16)), *days("B", [*range(1, 15), 16]), *days(None, range(1, 16)),
               *days("C", [1]), {"product_code": "C", "transaction_date_sk": -1},
               {"product_code": "C", "transaction_date_sk": None})
    columns = ("periodo_contable", "total_registros", "cantidad_mala", "porcentaje")
    assert rows(availability.availability_rule4(df, date(2024, 3, 1)), *columns) == [(202401, 4, 2, 50.0)]
    # In the open month only the elapsed days count: one on the 2nd, none on the 1st.
    assert rows(availability.availability_rule4(df, date(2024, 1, 2)), *columns) == [(202401, 4, 0, 100.0)]
    assert rows(availability.availability_rule4(df, date(2024, 1, 16)), *columns) == [(202401, 4, 2, 50.0)]


def test_rule4_window_and_period_list(facts, rows):
    df = facts(*days("A", range(1, 16)), *days("A", range(1, 16), 202101), *days("A", [3], 202402))
    rule4 = availability.availability_rule4
    assert rows(rule4(df, date(2024, 3, 1)), "periodo_contable") == [(202401,), (202402,)]
    # The floor is a moment: a movement before it in the same month is left out.
    assert rows(rule4(df, date(2024, 1, 21)), "periodo_contable") == [(202401,), (202402,)]
    assert rows(rule4(df, date(2024, 1, 20)), "periodo_contable") == [(202101,), (202401,), (202402,)]
    assert rows(rule4(df, date(2024, 3, 1), periods=[202101, 202402]), "periodo_contable", "cantidad_mala") == [
        (202101, 0), (202402, 1)]


def test_month_coverage(facts, rows):
    df = facts(*days("A", [1, 2, 2, 29], 202402), {"accountable_period": 202402, "transaction_date_sk": 20240310},
               *days("A", [31], 202401), {"accountable_period": 202312, "transaction_date_sk": 20240101},
               {"accountable_period": 2024020, "transaction_date_sk": 20240201})
    columns = ("periodo_contable", "total_registros", "cantidad_mala", "porcentaje", "hay_datos_mes")
    assert rows(availability.availability_month(df, date(2024, 3, 10)), *columns) == [
        (202401, 31, 30, 3.23, True), (202402, 29, 26, 10.34, True)]
    # 10 February: nine elapsed days, two with data; the 29th does not count yet.
    assert rows(availability.availability_month(df, date(2024, 2, 10)), *columns)[1] == (202402, 9, 7, 22.22, True)
    # The first of the month requires no day.
    assert rows(availability.availability_month(df, date(2024, 2, 1)), *columns)[1] == (202402, 0, 0, None, False)
    assert rows(availability.availability_month(df, date(2024, 3, 10), periods=[202401]), "periodo_contable") == [(202401,)]


def test_month_coverage_on_the_calendar(facts, rows):
    df = facts(*days("A", [1], 202312), *days("A", [2], 202402))
    columns = ("periodo_contable", "total_registros", "cantidad_mala", "hay_datos_mes")
    got = rows(availability.availability_month(df, date(2024, 2, 10), months=2, every_month=True), *columns)
    assert got == [(202312, 31, 30, True), (202401, 31, 31, False), (202402, 9, 8, True)]


def test_days_outside_the_calendar_are_ignored(facts, rows):
    df = facts(*days("A", [0, 1, 45, 99]))
    assert rows(availability.availability_month(df, date(2024, 3, 1)), "cantidad_mala") == [(30,)]


@pytest.mark.parametrize("at,minutes,state", [
    (datetime(2024, 1, 16, 10, 59, 30), -1, "A tiempo"), (datetime(2024, 1, 16, 11, 0, 0), 0, "A tiempo"),
    (datetime(2024, 1, 16, 11, 0, 0, 1), 0, "Tarde"), (datetime(2024, 1, 16, 11, 0, 30), 0, "Tarde"),
    (datetime(2024, 1, 16, 13, 0, 0), 120, "Tarde"), (datetime(2024, 1, 19, 4, 0, 0), -420, "A tiempo")])
def test_arrival_minutes(facts, at, minutes, state):
    later = datetime(2024, 2, 1, 8, 0, 0)
    df = facts({"load_ts": at}, {"load_ts": later}, {"load_ts": None}, {"transaction_date_sk": 20231001},
               {"transaction_date_sk": 2024011})
    got = availability.load_arrival(df, date(2024, 1, 20)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.minutos_vs_corte, r.estado, r.registros, r.ultima_escritura) == (minutes, state, 2, later)
    assert (r.fecha_datos, r.periodo_contable, r.hora_arribo, r.dias_atraso) == (
        date(2024, 1, 15), 202401, at.strftime("%H:%M:%S"), (at.date() - date(2024, 1, 15)).days)


def test_other_cutoff(facts):
    df = facts({"load_ts": datetime(2024, 1, 16, 5, 30)})
    r = availability.load_arrival(df, date(2024, 1, 20), cutoff=time(5, 15)).first()
    assert (r.minutos_vs_corte, r.estado) == (15, "Tarde")


def test_daily_counts_and_spread(facts, rows):
    df = facts({}, {}, {"transaction_date_sk": 20231019}, {"transaction_date_sk": 20231020}, {"transaction_date_sk": None})
    assert rows(availability.daily_counts(df, date(2024, 1, 20))) == [(20231020, 1), (20240115, 2)]
    assert rows(availability.load_spread(df, date(2024, 1, 20)), "transaction_date_sk", "registros") == [(20240115, 2)]


# ---- premium ------------------------------------------------------------------------------

def paid(amount, **more):
    return {"transaction_delta_billed_premium_amount": None if amount is None else Decimal(amount), **more}


def test_premium_by_category_and_mom(facts, rows):
    df = facts(paid(100), paid(50, product_code="RC", source_system="CO_as400"), paid(30, product_code=" 6031 "),
               paid(200, accountable_period=202402), paid(-20, accountable_period=202404),
               paid(7, accountable_period=2024020))
    by_category = premium.premium_by_category(df, date(2024, 4, 10))
    assert rows(by_category) == [
        (date(2024, 1, 1), "Autos", 130.0), (date(2024, 1, 1), "Responsabilidad Civil", 50.0),
        (date(2024, 2, 1), "Autos", 200.0), (date(2024, 4, 1), "Autos", -20.0), (None, "Autos", 7.0)]
    total = rows(premium.mom_total(by_category))
    assert [r[0] for r in total] == ["2024-01", "2024-02", "2024-04"]
    assert [r[2:] for r in total] == [(180.0, None, None, False), (200.0, 20.0, pytest.approx(100 / 9), False),
                                      (-20.0, -220.0, -110.0, True)]
    autos = premium.mom_by_category(by_category).filter("categoria_ramo = 'Autos'")
    assert rows(autos, "periodo", "var_pct_mom")[1:] == [("2024-02", pytest.approx(100 * 70 / 130)), ("2024-04", -110.0)]
    strict = premium.mom_by_category(by_category, calendar=True).filter("categoria_ramo = 'Autos'")
    assert rows(strict, "periodo", "var_pct_mom")[2] == ("2024-04", None)
    assert rows(premium.mom_last_months(premium.mom_total(by_category), 2), "periodo") == [("2024-02",), ("2024-04",)]
    assert rows(premium.mom_newest_by_category(premium.mom_by_category(by_category)), "categoria_ramo") == [("Autos",)]


def test_mom_recomputes_published_changes(spark, rows):
    # Three months of a published series with their changes.
    data = [(date(2023, 8, 1), 90244147327.03706), (date(2023, 9, 1), 91516610289.52733),
            (date(2023, 10, 1), 95374417253.25064)]
    series = spark.createDataFrame(data, "periodo_fecha date, prima_neta double")
    out = rows(premium.mom_total(series), "periodo", "var_abs_mom", "var_pct_mom", "en_curso")
    assert out == [("2023-08", None, None, False),
                   ("2023-09", pytest.approx(1272462962.490265), pytest.approx(1.4100226997313836), False),
                   ("2023-10", pytest.approx(3857806963.7233124), pytest.approx(4.215417235754826), True)]


def test_mom_open_month_from_the_calendar(spark, rows):
    data = [(date(2024, 1, 1), 1.0), (date(2024, 2, 1), 2.0)]
    series = spark.createDataFrame(data, "periodo_fecha date, prima_neta double")
    assert rows(premium.mom_total(series, as_of=date(2024, 1, 9)), "en_curso") == [(False,), (True,)]
    assert rows(premium.mom_total(series, as_of=date(2024, 3, 9)), "en_curso") == [(False,), (False,)]


def test_mom_with_zero_base(spark, rows):
    data = [(date(2024, 1, 1), Decimal(0)), (date(2024, 2, 1), Decimal(5))]
    series = spark.createDataFrame(data, "periodo_fecha date, prima_neta decimal(10,2)")
    assert rows(premium.mom_total(series), "var_pct_mom") == [(None,), (None,)]


def test_premium_by_source(facts, rows):
    as400 = {"source_system": "CO_as400"}
    df = facts(paid(100), paid(-40), paid(10, policy_number="2"), paid(5, **as400), paid(1, policy_number=None, **as400),
               paid(9, accountable_period=202403, **as400), paid(3, accountable_period=202310))
    by_source = premium.premium_by_source(df, date(2024, 3, 5), periods=[202401, 202402, 202403])
    out = rows(by_source)
    assert out == [(202401, "CO_as400", 2, 1, 6.0, 6.0, 0.0, 20.0), (202401, "CO_iaxis", 3, 2, 70.0, 110.0, -40.0, 30.0),
                   (202403, "CO_as400", 1, 1, 9.0, 9.0, 0.0, 10.0)]
    assert all(net == issued + cancelled for *_, net, issued, cancelled, _ in out)
    by_period = premium.premium_by_period(by_source)
    assert rows(by_period, "periodo_contable", "polizas", "prima_neta") == [(202401, 3, 76.0), (202403, 1, 9.0)]
    assert rows(premium.distinct_policies(df, date(2024, 3, 5))) == [(202310, 1), (202401, 2), (202403, 1)]
    series = premium.aligned_series(by_source, [202402, 202401, 202403])
    assert rows(series) == [(202401, "CO_as400", 6.0), (202401, "CO_iaxis", 70.0), (202402, "CO_as400", 0.0),
                            (202402, "CO_iaxis", 0.0), (202403, "CO_as400", 9.0), (202403, "CO_iaxis", 0.0)]
    assert rows(premium.stacked_totals(series)) == [(202401, 76.0), (202402, 0.0), (202403, 9.0)]
    listed = [202401, 202402, 202403]
    # The month after an empty one has no change; so has a list over no rows at all.
    assert rows(premium.net_change(by_period, listed), "periodo_contable", "prima_neta", "var_neta_pct") == [
        (202401, 76.0, None), (202402, 0.0, -100.0), (202403, 9.0, None)]
    assert rows(premium.net_change(by_period.limit(0), listed[:1]), "prima_neta", "var_neta_pct") == [(0.0, None)]
    assert rows(premium.on_axis(by_source, [202402, 202401, 202402], ["source_system"])) == [
        (202401, "CO_as400", 2, 1, 6.0, 6.0, 0.0, 20.0), (202401, "CO_iaxis", 3, 2, 70.0, 110.0, -40.0, 30.0),
        (202402, "CO_as400", 0, 0, 0.0, 0.0, 0.0, 0.0), (202402, "CO_iaxis", 0, 0, 0.0, 0.0, 0.0, 0.0)]


# ---- agreement and profile ----------------------------------------------------------------

def test_reconcile(spark, rows):
    left = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, None), (4, 1.0), (4, 2.0), (None, 1.0)], "k int, v double")
    right = spark.createDataFrame([(1, 10.0), (2, 5.5), (3, None), (4, 3.0), (5, 1.0), (None, 1.0)], "k int, v double")
    result = reconcile.reconcile(left, right, ["k"], ["v"])
    assert rows(result, "k", "filas_izquierda", "v_ok", "estado") == [
        (1, 1, True, "igual"), (2, 1, False, "distinto"), (3, 1, True, "igual"), (4, 2, False, "distinto"),
        (5, 0, False, "solo_derecha"), (None, 1, True, "igual")]
    assert rows(reconcile.reconcile(left, right, ["k"], ["v"], tolerance=0.5).filter("k = 2"), "estado") == [("igual",)]
    assert rows(reconcile.reconcile_summary(result, ["v"])) == [("exactitud", "v", 6, 3, 50.0)]
    assert rows(reconcile.row_sync(left, right.filter("k <> 4"), ["k"])) == [(6, 3)]
    assert rows(reconcile.row_sync(left, left, ["k"])) == [(6, 0)]


def test_reconcile_hot_key_against_brute_force(spark, rows):
    left = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    right = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id + if(id = 7, 1, 0) AS v")
    result = reconcile.reconcile(left, right, ["k"], ["v"])
    assert rows(result.groupBy("estado").count()) == [("distinto", 1), ("igual", 20_000)]
    assert rows(result.filter("k = 0"), "filas_izquierda", "v_izquierda") == [(10_000, sum(range(0, 30_000, 3)))]


def test_mapping_drift(spark, rows):
    a = spark.createDataFrame([("x", "A"), ("y", "B"), ("z", None)], "ramo string, categoria string")
    b = spark.createDataFrame([("x", "A"), ("y", "C"), ("w", "D"), ("z", None)], "ramo string, categoria string")
    assert rows(reconcile.mapping_drift(a, b, "ramo", "categoria")) == [
        ("w", None, "D", "solo_derecha"), ("y", "B", "C", "distinto")]
    assert reconcile.mapping_drift(a, a, "ramo", "categoria").count() == 0
    several = spark.createDataFrame([("x", "0"), ("x", "A"), ("y", "B"), ("z", None)], "ramo string, categoria string")
    assert rows(reconcile.mapping_drift(several, a, "ramo", "categoria")) == [("x", "A", "A", "distinto")]


def test_reconcile_counts_rows(spark, rows):
    left = spark.createDataFrame([(1, 50), (1, 50), (2, 5), (2, None), (3, None), (3, None)], "k int, v int")
    right = spark.createDataFrame([(1, 100), (2, 5), (3, None)], "k int, v int")
    result = reconcile.reconcile(left, right, ["k"], ["v"])
    assert rows(result, "k", "v_ok", "estado") == [(1, False, "distinto"), (2, True, "filas_distintas"), (3, True, "filas_distintas")]
    assert rows(reconcile.row_sync(left, right, ["k"])) == [(6, 3)]


def test_unmapped_products(facts, rows):
    df = facts(paid(75), paid(20, product_code=" ZZ "), paid(5, product_code=None))
    assert rows(profile.unmapped_products(df)) == [("ZZ", 1, 20.0, 20.0), (None, 1, 5.0, 5.0)]


def test_find_columns_and_sample(facts, rows):
    df = facts({}, {"current_record_flag": 0}, {"branch_sk": 1})
    assert rows(profile.find_columns(df), "column_name") == [("load_ts",), ("transaction_accounting_ts",)]
    assert rows(profile.find_columns(df, type_like=(), name_like=("%BRANCH%",))) == [("branch_sk", "bigint")]
    assert profile.sample_rows(df, 5).count() == 2
    assert rows(profile.sample_rows(df, 1, order_by=["branch_sk"]), "branch_sk") == [(1,)]


def test_field_dictionary(facts, spark):
    definitions = spark.createDataFrame([("branch_sk", "Sucursal.")], "campo string, definicion string")
    df = facts({"branch_sk": None}, {"branch_sk": 9}).withColumn("extra", F.lit(None).cast("string"))
    out = {r.campo: r for r in profile.field_dictionary(df, definitions).collect()}
    assert (out["branch_sk"].definicion, out["branch_sk"].ejemplo, out["branch_sk"].reglas_dq) == (
        "Sucursal.", "9", "completitud")
    assert out["extra"].definicion == profile.UNDEFINED and out["extra"].reglas_dq == "—"
    assert out["product_code"].reglas_dq == "completitud, validez, disponibilidad (regla 4)"
    assert (out["coverage_code"].filtro_base, out["branch_sk"].filtro_base) == ("sí", "")
    assert set(out) == set(df.columns)


def test_conform_normalises_types(spark):
    df = spark.createDataFrame([(True, 3114, "x")], "flag boolean, code int, other string")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("flag", T.IntegerType())])
    assert conform(df, schema).collect() == [("3114", 1)]
    with pytest.raises(ValueError):
        conform(df, T.StructType([T.StructField("missing", T.StringType())]))
