from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tamiz.functions import classify, percent, periods
from tamiz.mappings import LONG_LABELS, PRODUCT_CATEGORY, SHORT_LABELS, category_table, with_category, with_short_label


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def values(spark, data, column, schema):
    return [r[0] for r in spark.createDataFrame([(v,) for v in data], schema).coalesce(1).select(column).collect()]


def test_percentages_round_half_up(spark):
    cases = [(19997, 20000, "99.99"), (799, 800, "99.88"), (2, 3, "66.67"), (1, 3, "33.33"), (0, 5, "0.00"),
             (5, 5, "100.00"), (0, 0, "0.00"), (999_999_999_999, 1_000_000_000_000, "100.00")]
    df = spark.createDataFrame([(g, t) for g, t, _ in cases], "g long, t long").coalesce(1)
    got = [r[0] for r in df.select(percent.pct(F.col("g"), F.col("t"))).collect()]
    assert got == [Decimal(v) for _, _, v in cases]
    assert one(spark, percent.pct(F.lit(0), F.lit(0), when_empty=None))[0] is None


def test_mean_of_percentages_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("199.99"), 2), (Decimal("299.95"), 3)], "s decimal(20,2), n long").coalesce(1)
    assert [r[0] for r in df.select(percent.mean_pct(F.col("s"), F.col("n"))).collect()] == [
        Decimal("100.00"), Decimal("99.98")]


def test_change_and_state_at_the_limits(spark):
    # (value, base, state): exactly 15 and 30 per cent stay below the limit, 15.004 does not.
    cases = [("1.15", "1", "Normal"), ("1.15004", "1", "Advertencia"), ("1.3", "1", "Advertencia"),
             ("1.30001", "1", "Crítica"), ("0.7", "1", "Advertencia"), ("-1.3", "-1", "Advertencia"),
             ("5", "0", "Sin base"), ("5", None, "Sin base"), ("-2", "1", "Crítica")]
    data = [(Decimal(v), None if b is None else Decimal(b)) for v, b, _ in cases]
    df = spark.createDataFrame(data, "v decimal(17,6), b decimal(17,6)").coalesce(1)
    out = df.select(classify.balance_state(F.col("v"), F.col("b")).alias("s"),
                    percent.change_pct(F.col("v"), F.col("b"), signed_base=False).alias("abs"),
                    percent.change_pct(F.col("v"), F.col("b"), signed_base=True).alias("signed")).collect()
    assert [r.s for r in out] == [s for _, _, s in cases]
    assert (out[0].abs, out[1].abs, out[6].abs, out[7].abs) == (15.0, 15.0, None, None)
    assert (out[5].abs, out[5].signed) == (-30.0, 30.0)


@pytest.mark.parametrize("function,data,expected", [
    (classify.dimension_state, ["89.99", "90", "94.99", "95", None],
     ["Crítica", "Advertencia", "Advertencia", "Normal", "Pendiente"]),
    (classify.availability_state, ["24.99", "25", "49.99", "50", None],
     ["Crítica", "Advertencia", "Advertencia", "Normal", "Pendiente"]),
    (classify.band, ["99", "98.99", "97", "96.99", "90", "89.99", None],
     ["BUENO", "ALERTA", "ALERTA", "GRAVE", "GRAVE", "CRÍTICO", None]),
])
def test_percent_states(spark, function, data, expected):
    data = [None if v is None else Decimal(v) for v in data]
    assert values(spark, data, function(F.col("v")), "v decimal(10,2)") == expected


def test_own_bands_of_availability(spark):
    df = spark.createDataFrame([(Decimal("80"), "disponibilidad_mes"), (Decimal("80"), "disponibilidad_regla4"),
                                (Decimal("80"), "otro")], "v decimal(10,2), k string").coalesce(1)
    assert [r[0] for r in df.select(classify.band(F.col("v"), F.col("k"))).collect()] == ["ALERTA", "BUENO", "CRÍTICO"]


def test_arrival_trend_and_rank(spark):
    assert values(spark, [-1, 0, 1, 120, 121, None], classify.arrival_state(F.col("v")), "v int") == [
        "Normal", "Normal", "Advertencia", "Advertencia", "Crítica", "Sin dato"]
    assert values(spark, [0.0049, -0.0049, 0.005, -0.005, None], classify.trend_state(F.col("v")), "v double") == [
        "Estable", "Estable", "Mejora", "Baja", "sin anterior"]
    assert values(spark, ["Crítica", "Sin base", "Normal", "?"], classify.state_rank(F.col("v")), "v string") == [
        0, 3, 4, 9]


def test_reference_dates():
    assert periods.period_floor(date(2026, 8, 18), 36) == 202308
    assert periods.months_back(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert periods.months_back(date(2024, 1, 15), 13) == date(2022, 12, 15)
    assert periods.date_key(periods.days_back(date(2024, 3, 1), 1)) == 20240229
    assert [periods.elapsed_days(date(2024, 2, d), 15) for d in (1, 2, 16, 29)] == [0, 1, 15, 15]
    assert periods.elapsed_days(date(2024, 2, 29)) == 28


def test_period_and_key_columns(spark):
    assert values(spark, [202402, 2024020, 202413, 99, None], periods.period_date("v"), "v int") == [
        date(2024, 2, 1), None, None, None, None]
    assert values(spark, [20240229, 20230229, 20240231, 2024022, -1, None], periods.date_of_key("v"), "v long") == [
        date(2024, 2, 29), None, None, None, None, None]
    assert values(spark, [202402, 202302, 202412], periods.days_in_period("v"), "v int") == [29, 28, 31]
    assert values(spark, [202402, 202401], periods.period_label("v", date(2024, 2, 10)), "v int") == [
        "202402 (en curso)", "202401"]
    df = spark.createDataFrame([(20240115, 202401), (20240115, 202402), (202401, 202401)], "k long, p int").coalesce(1)
    assert [r[0] for r in df.select(periods.same_month("k", "p")).collect()] == [True, False, False]


def test_labels(spark, rows):
    assert len(LONG_LABELS) == 26 and set(LONG_LABELS) <= set(SHORT_LABELS)
    df = spark.createDataFrame([("sseguro",), ("inventado",)], "nombre_campo string")
    assert rows(with_short_label(df)) == [("inventado", "inventado"), ("sseguro", "ID de seguro")]
    assert values(spark, ["completitud", "disponibilidad", "x"], classify.dimension_label(F.col("v")), "v string") == [
        "Completitud", "Disponibilidad", "Disponibilidad"]


def test_categories(spark, rows):
    table = category_table(spark)
    assert (table.count(), table.select("ramo").distinct().count(), len(set(PRODUCT_CATEGORY.values()))) == (112, 112, 18)
    df = spark.createDataFrame([(" 6031 ",), ("RC",), ("01",), ("1",), (None,)], "product_code string")
    assert rows(with_category(df)) == [
        (" 6031 ", "Autos"), ("01", "Cumplimiento"), ("1", "Sin clasificar"), ("RC", "Responsabilidad Civil"),
        (None, "Sin clasificar")]
    repeated = spark.createDataFrame([("A", "x"), (" A", "w"), ("B", "y")], "ramo string, categoria string")
    df = spark.createDataFrame([("A",), ("B",)], "product_code string")
    assert rows(with_category(df, repeated)) == [("A", "w"), ("B", "y")]
