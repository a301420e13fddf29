from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tamiz.model import ALERT_SCHEMA, ARRIVAL_SCHEMA, CUBE_SCHEMA
from tamiz.operators.availability import load_arrival
from tamiz.plans import refresh, views
from tamiz.plans.cube import quality_cube, with_calc_ts
from tamiz.session import shared_folder, work_path
from tamiz.sinks.export import export_csv, export_json
from tamiz.sinks.snapshot import snapshot
from tamiz.sources.csvs import read_catalogue, read_dictionary, read_mapping
from tamiz.sources.movements import read_movement_table, read_movements, write_movements
from tamiz.sources.sqlfile import run_sql_file
from tamiz.streaming.arrivals import KEPT_VERSIONS, read_arrivals, stream_load_arrival, write_arrivals
from verification import fixture

AS_OF, STAMP = date(2024, 2, 10), datetime(2024, 2, 10, 9, 0)


def two_months(facts):
    return facts({"policy_transaction_movement_sk": 1}, {"policy_transaction_movement_sk": 2, "branch_sk": None},
                 {"accountable_period": 202402, "transaction_date_sk": 20240203,
                  "transaction_accounting_ts": datetime(2024, 2, 3), "load_ts": datetime(2024, 2, 4, 12, 0)})


def test_dictionary_csv(spark, tmp_path, rows):
    text = ('﻿Campo,Descripción,Tipo de dato,Ejemplo\r\n'
            'source_system,"Sistema (ej. a, b).",VARCHAR(50),CO_iaxis\r\n'
            'monto,Variación.,"NUMERIC(17\n10)",27154\r\n'
            'comision,"Con ""comillas"".","10)\nNUMERIC(16",-1\r\n'
            'sin_tipo,Algo.,,\r\n'
            'sin_texto,,BIGINT,1\r\n')
    path = tmp_path / "dic.csv"
    path.write_text(text, encoding="utf-8")
    out = {r.campo: r for r in read_dictionary(spark, str(path)).collect()}
    assert set(out) == {"source_system", "monto", "comision", "sin_tipo"}
    assert out["source_system"].definicion == "Sistema (ej. a, b). (Tipo: VARCHAR(50) · Ej: CO_iaxis)"
    assert (out["monto"].tipo, out["comision"].tipo) == ("NUMERIC(17,10)", "NUMERIC(16,10)")
    assert out["comision"].descripcion == 'Con "comillas".'
    assert out["sin_tipo"].definicion == "Algo."


def test_catalogue_csv_with_multiline_cells(spark, tmp_path):
    header = ",".join(f"c{i}" for i in range(18))
    cell = '"SUM(CASE\n  WHEN x IS NULL\n THEN 1 END)"'
    path = tmp_path / "cat.csv"
    path.write_bytes((header + "\nb,s,t,TABLE,x,varchar,,o,No vac\xedo,,,,,," + cell + ",,,\n"
                      "b,s,t,TABLE,y,int8,,o,,,,,,,,,,\n").encode("latin-1"))
    out = read_catalogue(spark, str(path)).collect()
    assert [r.column_name for r in out] == ["x", "y"]
    assert out[0].logica_completitud.count("\n") == 2 and out[1].logica_completitud is None


def test_mapping_csv(spark, tmp_path, rows):
    path = tmp_path / "map.csv"
    path.write_text("﻿ramo,product_description,categoria\n01,CUMPLIMIENTO,Cumplimiento\n10,NAVEGACIÓN,Transporte\n",
                    encoding="utf-8")
    assert rows(read_mapping(spark, str(path)), "ramo", "categoria") == [("01", "Cumplimiento"), ("10", "Transporte")]
    path.write_text("﻿Campo,Nombre\nbranch_sk,Sucursal\n", encoding="utf-8")
    assert rows(read_mapping(spark, str(path), ("nombre_campo", "nombre_corto"))) == [("branch_sk", "Sucursal")]


def test_csv_export_has_a_mark_in_every_part(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, f"año {i}, b") for i in range(10)], "id int, texto string").repartition(3)
    export_csv(df, str(tmp_path / "csv"))
    parts = list((tmp_path / "csv").glob("part-*.csv"))
    assert len(parts) == 3
    assert all(p.read_bytes().startswith(b"\xef\xbb\xbfid,texto") for p in parts)
    back = spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "csv"))
    assert rows(back) == rows(df)
    export_csv(df, str(tmp_path / "csv"), bom=False)
    assert all(p.read_bytes().startswith(b"id,") for p in (tmp_path / "csv").glob("part-*.csv"))


def test_csv_export_bounds_what_a_reading_task_gets(spark, tmp_path, rows):
    path = str(tmp_path / "csv")
    df = spark.range(250_001).selectExpr("concat(id, char(10), 'x') AS ramo", "string(id) AS product_description", "'c' AS categoria").coalesce(1)
    export_csv(df, path)
    files = sorted((tmp_path / "csv").glob("part-*.csv"))
    assert len(files) == 3 and all(f.read_bytes().startswith(b"\xef\xbb\xbframo,") for f in files)
    back = read_mapping(spark, path)
    assert back.count() == 250_001 and back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    export_csv(df.limit(10), path, file_rows=4)
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 3 and rows(read_mapping(spark, path)) == rows(df.limit(10))


def test_json_export_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None, float("nan")), ("b", 1, 2.5)], "k string, n int, x double").coalesce(1)
    export_json(df, str(tmp_path / "json"))
    lines = next((tmp_path / "json").glob("part-*.json")).read_text().splitlines()
    assert lines == ['{"k":"a","n":null,"x":null}', '{"k":"b","n":1,"x":2.5}']


def test_snapshots_are_repeatable_and_keep_the_table(spark, facts, rows):
    cube = quality_cube(two_months(facts), AS_OF, stamp=STAMP)
    spark.sql("DROP TABLE IF EXISTS t_cube")
    first = snapshot(cube, "t_cube", CUBE_SCHEMA)
    before = rows(first)
    assert first.schema == CUBE_SCHEMA
    assert rows(snapshot(cube, "t_cube", CUBE_SCHEMA)) == before
    assert rows(snapshot(cube.filter("es_total = 1"), "t_cube", CUBE_SCHEMA)) == [r for r in before if r[8] == 1]
    arrivals = with_calc_ts(load_arrival(two_months(facts), AS_OF), STAMP)
    assert snapshot(arrivals, "t_arrivals", ARRIVAL_SCHEMA, path=work_path(spark, "t_arrivals")).count() == 2
    with pytest.raises(ValueError):
        snapshot(arrivals.drop("estado"), "t_arrivals", ARRIVAL_SCHEMA)


def test_cube_shape(facts, spark):
    cube = quality_cube(two_months(facts), AS_OF, stamp=STAMP)
    assert cube.columns == CUBE_SCHEMA.fieldNames()
    assert {r["count"] for r in cube.groupBy("periodo_contable").count().collect()} == {43}
    lean = quality_cube(two_months(facts), AS_OF, stamp=STAMP, month_availability=False)
    assert {r["count"] for r in lean.groupBy("periodo_contable").count().collect()} == {42}
    assert cube.filter("porcentaje < 0 OR porcentaje > 100 OR nombre_natural IS NULL").count() == 0


def test_refresh_processes_only_what_is_pending(spark, facts, rows):
    df, path = two_months(facts), work_path(spark, "refresh")
    january = df.filter("accountable_period = 202401")
    assert refresh.refresh_pending(january, path, date(2024, 1, 20), stamp=datetime(2024, 1, 20)) == [202401]
    # January was still open when it was stored, so it is calculated once more.
    assert refresh.refresh_pending(df, path, AS_OF, stamp=STAMP) == [202401, 202402]
    stored = rows(spark.read.parquet(path), *CUBE_SCHEMA.fieldNames()[2:9])
    assert refresh.refresh_pending(df, path, AS_OF, stamp=STAMP) == [202402]
    assert rows(spark.read.parquet(path), *CUBE_SCHEMA.fieldNames()[2:9]) == stored
    assert stored == rows(quality_cube(df, AS_OF, periods=[202401, 202402]), *CUBE_SCHEMA.fieldNames()[2:9])


def test_refresh_keeps_malformed_periods(spark, facts, rows):
    df = two_months(facts).unionByName(facts({"accountable_period": 2024010}))
    path = work_path(spark, "refresh")
    assert refresh.refresh_pending(df, path, AS_OF, stamp=STAMP) == [202401, 202402]
    assert refresh.refresh_pending(df, path, AS_OF, stamp=STAMP) == [202402]
    bad = spark.read.parquet(path).filter("periodo_contable = 2024010 AND cantidad_mala > 0 AND es_total = 0")
    assert rows(bad, "nombre_campo", "periodo_fecha") == [("accountable_period", None)]
    # Corrected in the source, it goes from the cube.
    assert refresh.refresh_pending(two_months(facts), path, AS_OF, stamp=STAMP) == [202402]
    assert spark.read.parquet(path).filter("periodo_contable = 2024010").count() == 0
    assert spark.read.parquet(path).filter("periodo_contable = 202401").count() == 43


def test_csv_keeps_every_character(spark, tmp_path):
    cells = [(' 6031 ', 'a "b", c', "x"), (None, None, "two\nlines"), ("\\", ' "', "é,")]
    df = spark.createDataFrame(cells, "ramo string, product_description string, categoria string")
    export_csv(df.coalesce(1), str(tmp_path / "cells"), bom=False)
    assert [tuple(r) for r in read_mapping(spark, str(tmp_path / "cells")).collect()] == cells


def test_snapshot_refuses_other_columns(spark):
    from pyspark.sql import types as T

    a, b = T.StructField("a", T.StringType()), T.StructField("b", T.StringType())
    df = spark.createDataFrame([("va", "vb")], "a string, b string")
    snapshot(df, "turned", T.StructType([b, a]))
    with pytest.raises(ValueError, match="other columns"):
        snapshot(df, "turned", T.StructType([a, b]))


def test_unreadable_values_become_null(spark):
    from tamiz.model import MOVEMENT_SCHEMA, conform

    odd = spark.createDataFrame([("S", "n/a", "7")], "current_record_flag string, load_ts string, branch_sk string")
    row = conform(odd, MOVEMENT_SCHEMA, missing_as_null=True).first()
    assert (row.current_record_flag, row.load_ts, int(row.branch_sk)) == (None, None, 7)


def test_views_and_stored_select(spark, facts, tmp_path):
    assert views.register_views(two_months(facts), AS_OF, stamp=STAMP) == [
        views.CUBE_VIEW, views.ARRIVAL_VIEW, views.ALERT_VIEW]
    assert spark.table(views.ALERT_VIEW).columns == ALERT_SCHEMA.fieldNames()
    path = tmp_path / "late.sql"
    path.write_text("SELECT transaction_date_sk FROM vw_disponibilidad_hora_carga WHERE estado = :estado;\n")
    assert [r[0] for r in run_sql_file(spark, path, {"estado": "Tarde"}).collect()] == [20240203]


def test_fact_is_read_as_stored(spark, facts, rows):
    df, path = two_months(facts), work_path(spark, "fact")
    write_movements(df, path)
    columns = sorted(df.columns)
    assert rows(read_movements(spark, path), *columns) == rows(df, *columns)
    spark.read.parquet(path).createOrReplaceTempView("stored_fact")
    assert read_movement_table(spark, "stored_fact").count() == 3
    # Other types of the same columns are brought to the declared ones.
    loose = df.selectExpr("*", "current_record_flag = 1 AS flag").drop("current_record_flag").withColumnRenamed(
        "flag", "current_record_flag").withColumn("coverage_code", df.coverage_code.cast("int"))
    other = work_path(spark, "loose")
    loose.write.parquet(other)
    assert rows(read_movements(spark, other), *columns) == rows(df, *columns)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "a").startswith(shared_folder(spark)) and work_path(spark, "a") != work_path(spark, "a")


def test_stream_equals_batch_and_takes_late_rewrites(spark, facts, rows):
    source, out = work_path(spark, "stream-in"), work_path(spark, "stream-out")
    state = work_path(spark, "stream-state")
    first = two_months(facts)
    late = facts({"load_ts": datetime(2024, 2, 9, 8, 0)}, {"load_ts": datetime(2024, 1, 16, 4, 0)})
    first.write.mode("append").parquet(source)

    def advance():
        stream = spark.readStream.schema(first.schema).parquet(source)
        write_arrivals(stream_load_arrival(stream, AS_OF), out, state).awaitTermination(120)
        return rows(read_arrivals(spark, out).drop("dias_atraso"))

    def batch(df):
        return rows(load_arrival(df, AS_OF).drop("dias_atraso"))

    assert advance() == batch(first)
    late.write.mode("append").parquet(source)
    assert advance() == batch(first.unionByName(late))


def test_stream_window_moves_and_old_versions_go(spark, facts, rows):
    source, out, state = (work_path(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    days = iter([date(2024, 2, 10)] * KEPT_VERSIONS + [date(2024, 4, 1)])
    for _ in range(KEPT_VERSIONS + 1):
        two_months(facts).write.mode("append").parquet(source)
        stream = spark.readStream.schema(two_months(facts).schema).parquet(source)
        write_arrivals(stream_load_arrival(stream, AS_OF), out, state, today=lambda: next(days)).awaitTermination(120)
    # Sixty days before April the first begin after the 15th of January; the third of February is inside.
    assert rows(read_arrivals(spark, out), "transaction_date_sk", "registros") == [(20240203, KEPT_VERSIONS + 1)]
    assert spark.read.parquet(out).select("version").distinct().count() == KEPT_VERSIONS


def test_money_survives_the_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(Decimal("12345678901.2345"),)], "v decimal(17,4)")
    export_csv(df, str(tmp_path / "m"))
    assert spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "m")).first()[0] == Decimal(
        "12345678901.2345")


def test_results_do_not_depend_on_the_session_zone(spark, facts, rows):
    df = two_months(facts)
    path = work_path(spark, "ntz")
    df.withColumn("load_ts", df.load_ts.cast("timestamp_ntz")).withColumn(
        "transaction_accounting_ts", df.transaction_accounting_ts.cast("timestamp_ntz")).write.parquet(path)

    def results():
        fact = read_movements(spark, path)
        cube = quality_cube(fact, AS_OF, stamp=STAMP).withColumn("fecha_calculo", F.col("fecha_calculo").cast("string"))
        periods = quality_cube(fact, AS_OF, periods=[202401], stamp=STAMP).drop("fecha_calculo")
        arrivals = load_arrival(fact, AS_OF)
        return rows(cube), rows(periods), rows(arrivals.withColumn("arribo_datos", F.col("arribo_datos").cast("string")))

    utc = results()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
        assert results() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_adapter_computes_above_its_joins(spark):
    text = _optimized(fixture.movements(spark, "/root/testdata/sf0.001"))
    assert -1 < text.index(" AS h#") < text.index("Join") and text.count(" AS h#") == 1


def test_movements_are_made_after_dealing(spark, tmp_path, rows):
    sf = "/root/testdata/sf0.001"
    seen = []

    def made(df):
        seen.append(fixture.conform_movements(fixture.adapted(df)))
        return seen[-1]

    write_movements(fixture.feed(spark, sf), str(tmp_path / "made"), made, by="month")
    write_movements(fixture.movements(spark, sf), str(tmp_path / "whole"))
    text = _optimized(seen[0])
    assert text.index(" AS h#") < text.index("RebalancePartitions")
    new, old = (read_movements(spark, str(tmp_path / name)) for name in ("made", "whole"))
    assert new.columns == old.columns and rows(new) == rows(old)
    folders = [{p.name for p in (tmp_path / name).glob("accountable_period=*")} for name in ("made", "whole")]
    assert folders[0] == folders[1]
