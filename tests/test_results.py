"""Alerts and scorecard over hand-made balances and cubes."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from tamiz.mappings import category_table
from tamiz.model import ALERT_SCHEMA, Thresholds
from tamiz.operators import alerts as al
from tamiz.operators import scorecard as sc
from tamiz.plans.alerts import alerts

TOTAL, KEY = "TOTAL_PERIODO", "policy_transaction_movement_sk"


def balances(spark, *rows):
    data = [(r, d, d.year * 100 + d.month, Decimal(v)) for r, d, v in rows]
    return spark.createDataFrame(data, "ramo string, fecha date, periodo_contable int, prima_dia decimal(20,4)")


def test_daily_balance(facts, rows):
    def move(key, amount, product="6031", **more):
        return {"transaction_date_sk": key, "transaction_delta_billed_premium_amount": Decimal(amount),
                "product_code": product, **more}
    df = facts(move(20240110, 10), move(20240110, 5, " 6031 "), move(20240110, 1, None), move(20240111, -3),
               move(20240231, 9), move(202401, 9), move(None, 9), move(20231001, 9), move(20240111, 9, coverage_code="8888"))
    assert rows(al.daily_balance(df, date(2024, 3, 1))) == [
        ("6031", date(2024, 1, 10), 202401, 15.0), ("6031", date(2024, 1, 11), 202401, -3.0),
        ("6031", None, 202402, 9.0), (None, date(2024, 1, 10), 202401, 1.0)]
    impossible = al.balance_alerts(al.daily_balance(df, date(2024, 3, 1)))
    assert rows(impossible.filter("estado = 'Sin base'"), "clave", "fecha", "valor") == [
        ("6031", date(2024, 1, 10), 15.0), ("6031", None, 9.0), (None, date(2024, 1, 10), 1.0)]


def test_balance_alerts_compare_with_previous_day_with_data(spark, rows):
    daily = balances(spark, ("A", date(2024, 1, 5), "100"), ("A", date(2024, 1, 9), "115"), ("A", date(2024, 1, 10), "149.51"),
                     ("A", date(2024, 2, 1), "0"), ("A", date(2024, 2, 2), "7"), ("RC", date(2024, 1, 9), "1"))
    out = al.balance_alerts(daily, mapping=category_table(spark))
    assert rows(out, "clave", "fecha", "variacion_pct", "estado", "categoria") == [
        ("A", date(2024, 1, 5), None, "Sin base", "Sin clasificar"),
        ("A", date(2024, 1, 9), 15.0, "Normal", "Sin clasificar"),
        ("A", date(2024, 1, 10), 30.01, "Crítica", "Sin clasificar"),
        ("A", date(2024, 2, 1), -100.0, "Crítica", "Sin clasificar"),
        ("A", date(2024, 2, 2), None, "Sin base", "Sin clasificar"),
        ("RC", date(2024, 1, 9), None, "Sin base", "Responsabilidad Civil")]
    details = [r.detalle for r in out.orderBy("clave", "fecha").collect()]
    assert details[0].startswith("Saldo del día vs. día con datos anterior (s/d).")
    assert "(2024-01-05). Umbrales ±15% / ±30%." in details[1]


@pytest.fixture(scope="module")
def cube(cubes):
    return cubes(
        (202312, "completitud", TOTAL, 10, 1, 99.0, 1), (202312, "completitud", "branch_sk", 10, 1, 90, 0),
        (202401, "completitud", TOTAL, 10, 4, 94.99, 1), (202401, "completitud", "branch_sk", 10, 3, 70, 0),
        (202401, "completitud", "sseguro", 10, 1, 90, 0), (202401, "completitud", "receipt_type", 10, 0, 100, 0),
        (202401, "validez", TOTAL, 10, 3, 89.99, 1), (202401, "validez", "branch_sk", 10, 3, 70, 0),
        (202401, "exactitud", "TOTAL", 10, 0, 95, 1), (202401, "exactitud", "source_system", 10, 0, 100, 0),
        (202401, "unicidad", KEY, 10, 2, 80, 1), (202401, "disponibilidad", "disponibilidad_mes", 31, 10, 67.74, 1),
        (202401, "disponibilidad", "disponibilidad_regla4", 4, 1, 75, 1),
        (202402, "disponibilidad", "disponibilidad_mes", 0, 0, None, 1))


def test_cube_alerts_equal_their_three_parts(cube, rows):
    parts = al.dimension_alerts(cube).unionByName(al.integrity_pending(cube)).unionByName(al.availability_alerts(cube))
    assert rows(al.cube_alerts(cube)) == rows(parts)
    assert rows(al.cube_alerts(cube), "periodo_contable", "ambito", "clave", "estado") == [
        (202312, "dimension", "completitud", "Normal"), (202312, "dimension", "integridad", "Pendiente"),
        (202401, "dimension", "completitud", "Advertencia"), (202401, "dimension", "exactitud", "Normal"),
        (202401, "dimension", "integridad", "Pendiente"), (202401, "dimension", "unicidad", "Crítica"),
        (202401, "dimension", "validez", "Crítica"), (202401, "disponibilidad", "disponibilidad_mes", "Normal"),
        (202401, "disponibilidad", "disponibilidad_regla4", "Normal"), (202402, "dimension", "integridad", "Pendiente"),
        (202402, "disponibilidad", "disponibilidad_mes", "Pendiente")]


def test_thresholds_are_data(cube, spark, rows):
    loose = Thresholds(dimension_warning=60, dimension_critical=50, availability_critical=70, availability_warning=72,
                       balance_warning=1, balance_critical=500, arrival_critical_minutes=5)
    states = dict(rows(al.cube_alerts(cube, thresholds=loose).filter("periodo_contable = 202401"), "clave", "estado"))
    assert states == {"completitud": "Normal", "exactitud": "Normal", "unicidad": "Normal", "validez": "Normal",
                      "integridad": "Pendiente", "disponibilidad_mes": "Crítica", "disponibilidad_regla4": "Normal"}
    daily = balances(spark, ("A", date(2024, 1, 5), "100"), ("A", date(2024, 1, 9), "115"))
    last = al.balance_alerts(daily, thresholds=loose).orderBy("fecha").collect()[1]
    assert (last.estado, float(last.umbral_crit)) == ("Advertencia", 500.0) and "±1% / ±500%" in last.detalle
    bands = Thresholds(bands={"default": (50, 40, 30)})
    assert set(rows(sc.traffic_light(cube, thresholds=bands), "banda")) == {("BUENO",)}


def test_panels(spark, rows):
    data = [("saldo_ramo", "A", 202401, date(2024, 1, 5), "Normal"), ("saldo_ramo", "B", 202401, date(2024, 1, 4), "Crítica"),
            ("saldo_ramo", "C", 202401, date(2024, 1, 3), "Advertencia"), ("saldo_ramo", "D", 202401, date(2024, 1, 2), "Sin base"),
            ("saldo_ramo", "E", 202401, date(2024, 1, 1), "Crítica"), ("dimension", "x", 202401, date(2024, 1, 1), "Pendiente"),
            ("dimension", "y", 202312, None, "Crítica"), ("hora_carga", "h", 202401, date(2024, 1, 5), "Normal"),
            ("hora_carga", "h", 202401, date(2024, 1, 6), "Normal")]
    df = spark.createDataFrame([(a, c, c, p, f, s) for a, c, p, f, s in data],
                               "ambito string, clave string, clave_natural string, periodo_contable int, fecha date, estado string")
    assert rows(al.actionable_panel(df, 2), "ambito", "clave", "posicion") == [
        ("dimension", "x", 2), ("dimension", "y", 1), ("saldo_ramo", "B", 2), ("saldo_ramo", "E", 1)]
    assert [r.clave for r in al.balance_panel(df, 3).collect()] == ["B", "C", "D"]
    assert rows(al.dimension_panel(df), "clave") == [("x",)]
    assert rows(al.arrival_panel(df, 1), "fecha") == [(date(2024, 1, 6),)]
    assert rows(al.latest(df, "fecha", within="ambito"), "clave") == [("A",), ("h",), ("x",)]
    assert al.actionable(df).count() == 6 and al.actionable(df, only_breaches=True).count() == 4
    assert sum(r.alertas for r in al.alert_summary(df).collect()) == len(data)


def test_all_alerts_of_a_fact(facts, rows):
    df = facts({}, {"transaction_date_sk": 20240116, "load_ts": datetime(2024, 1, 17, 14, 0)})
    out = alerts(df, date(2024, 1, 20), stamp=datetime(2024, 1, 20))
    assert out.columns == ALERT_SCHEMA.fieldNames()
    counts = {(r.ambito, r.estado): r.alertas for r in al.alert_summary(out).collect()}
    assert counts == {("saldo_ramo", "Sin base"): 1, ("saldo_ramo", "Normal"): 1, ("dimension", "Normal"): 3,
                      ("dimension", "Crítica"): 1, ("dimension", "Pendiente"): 1, ("disponibilidad", "Crítica"): 2,
                      ("hora_carga", "Normal"): 1, ("hora_carga", "Crítica"): 1}


def test_score_and_deltas(cube, rows):
    assert rows(sc.dq_score(cube)) == [(202312, 99.0), (202401, pytest.approx(89.995))]
    out = {(r.periodo_contable, r.tipo_indicador): r for r in sc.deltas(cube).collect()}
    first, now = out[202312, "completitud"], out[202401, "completitud"]
    assert (first.periodo_anterior, first.delta) == (None, None)
    assert (now.periodo_anterior, now.anterior, now.delta) == (202312, 99.0, pytest.approx(-4.01))
    # Validity has no value in the previous listed period, so it has no delta.
    assert (out[202401, "validez"].periodo_anterior, out[202401, "validez"].delta) == (202312, None)
    assert out[202401, "dq_score"].delta == pytest.approx(89.995 - 99)
    assert (202402, "dq_score") not in out
    states = {(r.periodo_contable, r.tipo_indicador): r.tendencia for r in sc.trend(cube).collect()}
    assert (states[202401, "completitud"], states[202401, "validez"]) == ("Baja", "sin anterior")


def test_scorecard_tables(cube, rows):
    assert rows(sc.traffic_light(cube), "periodo_contable", "tipo_indicador", "campos", "banda")[1:] == [
        (202401, "completitud", 3, "GRAVE"), (202401, "exactitud", 1, "GRAVE"), (202401, "unicidad", 1, "CRÍTICO"),
        (202401, "validez", 1, "CRÍTICO")]
    assert rows(sc.drilldown(cube), "periodo_contable", "tipo_indicador", "campos_con_falla", "campos", "errores")[1:] == [
        (202401, "completitud", 2, 3, 4), (202401, "exactitud", 0, 1, 0), (202401, "unicidad", 0, 0, 0),
        (202401, "validez", 1, 1, 3)]
    now = sc.remediation_list(cube).filter("periodo_contable = 202401")
    assert [(r.nombre_campo, r.dimension, r.impacto) for r in now.collect()] == [
        ("branch_sk", "Completitud", "Crítico"), ("branch_sk", "Validez", "Crítico"), (KEY, "Unicidad", "Crítico"),
        ("sseguro", "Completitud", "Grave"), ("receipt_type", "Completitud", "OK"), ("source_system", "Exactitud", "OK")]
    assert [r.nombre_campo for r in sc.drilldown_fields(cube, "completitud").filter("falla").collect()] == [
        "branch_sk", "branch_sk", "sseguro"]
    assert rows(sc.availability_tiles(cube), "nombre_campo", "banda") == [
        ("disponibilidad_mes", "GRAVE"), ("disponibilidad_mes", None), ("disponibilidad_regla4", "ALERTA")]
    assert rows(sc.vs_target(cube), "periodo_contable", "tipo_indicador", "brecha")[0] == (202312, "completitud", 4.0)
    assert rows(sc.field_matrix(cube).filter("nombre_campo = 'branch_sk'"))[1] == (
        202401, "branch_sk", 70.0, None, None, 70.0)


def test_errors_and_pareto(cube, rows):
    now = "periodo_contable = 202401"
    assert rows(sc.errors_by_dimension(cube).filter(now), "tipo_indicador", "errores", "pct_errores") == [
        ("completitud", 4, 44.44), ("exactitud", 0, 0.0), ("unicidad", 2, 22.22), ("validez", 3, 33.33)]
    assert rows(sc.errors_by_field(cube).filter(now), "posicion", "nombre_campo", "errores", "pct_errores") == [
        (1, "branch_sk", 6, 66.67), (2, KEY, 2, 22.22), (3, "sseguro", 1, 11.11)]
    # Shares of a shorter list stay shares of all errors.
    assert rows(sc.pareto(cube, 2).filter(now), "nombre_campo", "pct_acumulado") == [("branch_sk", 66.67), (KEY, 88.89)]


def test_pareto_ties(cubes, rows):
    tied = cubes(*[(202401, "validez", f, 10, b, 50, 0) for f, b in (("a", 2), ("b", 1), ("c", 1))])
    assert [r[0] for r in rows(sc.pareto(tied), "pct_acumulado")] == [100.0, 50.0, 75.0]
    assert [r[0] for r in rows(sc.pareto(tied, ties="peers"), "pct_acumulado")] == [100.0, 100.0, 50.0]
    with pytest.raises(ValueError):
        sc.pareto(tied, ties="none")


def test_measures(cube):
    out = {(r.periodo_contable, r.tipo_indicador): r for r in sc.measures(cube).collect()}
    r = out[202401, "completitud"]
    assert (r.registros_malos, r.registros_evaluados, r.campos_evaluados) == (8, 40, 3)
    assert (out[202401, "unicidad"].campos_evaluados, r.fecha_calculo) == (1, datetime(2024, 3, 5))
    assert r.calidad == pytest.approx((94.99 + 70 + 90 + 100) / 4)
