"""Versions that survive a dead write, and results kept by merging loads."""

import pytest
import tamiz.session
from pyspark.sql import functions as F

from tamiz.operators import availability as av
from tamiz.operators import distinct
from tamiz.operators.counts import loose_report
from tamiz.operators.uniqueness import uniqueness
from tamiz.operators.universe import Scope, universe
from tamiz.plans import refresh, state
from tamiz.plans.cube import quality_cube
from tamiz.plans.views import register_sql_views
from tamiz.session import drop_scratch, scratch_folder, work_path
from tamiz.sinks.snapshot import recover, root_of, snapshot
from tamiz.sinks.versions import SLOTS, newest, read_version, slot_path, write_version
from tamiz.sources.movements import read_movements, write_movements
from tests.test_io import AS_OF, STAMP, two_months
from tests.test_plans import plan


def broken(df):
    """The rows of ``df``, of which one cannot be made: some tasks have written theirs when the job dies."""
    more = df.limit(0).unionByName(df)
    return more.repartition(4).withColumn(df.columns[0], F.when(F.rand() >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col(df.columns[0])))


def test_a_dead_write_leaves_the_former_version(spark):
    root = work_path(spark, "versions")
    assert newest(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_version(spark, root)
    for i in range(1, SLOTS + 3):
        assert write_version(spark.range(i).selectExpr("id", "'x' AS s"), root) == i
        with pytest.raises(Exception, match="lost"):
            write_version(broken(spark.range(100).selectExpr("id", "'y' AS s")), root)
        # Rows that were written whole, but not committed, are not there either.
        spark.range(50).selectExpr("id", "'z' AS s").write.mode("overwrite").parquet(slot_path(root, (i + 1) % SLOTS))
        assert sorted(r.id for r in read_version(spark, root).collect()) == list(range(i))
    assert write_version(read_version(spark, root).filter("id < 2"), root) == SLOTS + 3
    assert read_version(spark, root).count() == 2


def test_refresh_that_dies_keeps_the_cube(spark, facts, rows, monkeypatch):
    df, path = two_months(facts), work_path(spark, "refresh")
    refresh.refresh_pending(df, path, AS_OF, stamp=STAMP)
    before = rows(refresh.read_cube(spark, path))
    cube = refresh.quality_cube
    monkeypatch.setattr(refresh, "quality_cube", lambda *a, **k: broken(cube(*a, **k)))
    with pytest.raises(Exception, match="lost"):
        refresh.refresh_pending(df, path, AS_OF, stamp=STAMP)
    assert rows(refresh.read_cube(spark, path)) == before == rows(spark.read.parquet(path))
    monkeypatch.undo()
    assert refresh.refresh_pending(df, path, AS_OF, stamp=STAMP) == [202402]
    assert rows(refresh.read_cube(spark, path)) == before


def test_snapshot_that_dies_keeps_the_table(spark, rows):
    spark.sql("DROP TABLE IF EXISTS kept_rows")
    df = spark.range(5).selectExpr("cast(id AS int) AS a", "'v' AS b")
    first = rows(snapshot(df, "kept_rows", df.schema))
    with pytest.raises(Exception, match="lost"):
        snapshot(broken(df), "kept_rows", df.schema)
    assert rows(spark.table("kept_rows")) == first == rows(recover(df, "kept_rows"))
    # A table may be made anew from its own rows.
    assert snapshot(spark.table("kept_rows").filter("a < 2"), "kept_rows", df.schema).count() == 2
    assert newest(spark, root_of(df, "kept_rows"))[0] == 2


def test_cube_of_loads_is_the_cube_of_all(spark, facts, rows):
    df = two_months(facts).unionByName(facts({"policy_transaction_movement_sk": None}, {"policy_transaction_movement_sk": None, "accountable_period": 202402}))
    late = F.col("transaction_date_sk") % 2 == 0
    path = work_path(spark, "loads")
    for name, load in (("b", df.filter(late)), ("a", df.filter(~late)), ("b", df.filter(late))):
        state.add_load(load, name, path)
    spark.sql("DROP TABLE IF EXISTS key_state")
    state.store_keys(state.key_counts(df.filter(late)), "key_state", buckets=4)
    keys = state.merge_keys(spark.table("key_state"), df.filter(~late))
    periods = [202401, 202402]
    columns = ["periodo_contable", "tipo_indicador", "nombre_campo", "total_registros", "cantidad_mala", "porcentaje", "es_total", "nombre_natural"]
    for nulls in ("group", "ignore"):
        got = state.merged_cube(spark, path, keys, AS_OF, periods=periods, nulls=nulls, stamp=STAMP)
        assert rows(got, *columns) == rows(quality_cube(df, AS_OF, periods=periods, nulls=nulls, stamp=STAMP), *columns)
    assert rows(state.uniqueness_of(keys)) == rows(uniqueness(universe(df)))


def test_masks_of_a_load_come_from_one_reading(spark, facts, rows):
    df = two_months(facts).unionByName(facts(
        {"transaction_date_sk": None}, {"transaction_date_sk": 202401}, {"transaction_date_sk": 20240145, "product_code": None},
        {"accountable_period": 202402}, {"accountable_period": None}, {"accountable_period": 2024010, "product_code": "A B1"},
        {"transaction_accounting_ts": None}, {"accountable_period": 202403, "transaction_date_sk": 20240399}))
    joint = av.joint_masks(df)
    assert rows(av.product_masks_of(joint)) == rows(av.product_masks(df))
    assert rows(av.month_masks_of(joint)) == rows(av.month_masks(df))
    path = work_path(spark, "loads")
    state.add_load(df, "a", path)
    assert rows(spark.read.parquet(f"{path}/{state.DAYS}/load=a")) == rows(joint)
    assert rows(state.merged_masks(spark, path, state.PRODUCT_DAYS)) == rows(av.product_masks(df))
    assert rows(state.merged_masks(spark, path, state.MONTH_DAYS)) == rows(av.month_masks(df))


def test_old_keys_stay_where_they_are(spark, facts):
    """The state is joined by its buckets: the only exchange below the join is that of the load's keys."""
    spark.sql("DROP TABLE IF EXISTS key_state_plan")
    df = two_months(facts)
    state.store_keys(state.key_counts(df), "key_state_plan", buckets=4)
    text = plan(state.merge_keys(spark.table("key_state_plan"), df)).split("\n\n")[0]
    side = text[text.index("SortMergeJoin"):]
    table, load = sorted((side[:side.index("key_state_plan")], side[side.index("key_state_plan"):]), key=lambda t: "Exchange" in t)
    assert "SortMergeJoin" in text and "Exchange" not in table, text
    assert load.count("Exchange") == 2, text  # one folds the load's keys, one sends them to their buckets


def test_numbers_are_dense_and_stay(spark):
    first = spark.createDataFrame([(f"p{i:03}",) for i in range(50)] * 3 + [(None,)], "policy_number string")
    known = distinct.numbered(first.repartition(5))
    assert sorted(r.number for r in known.collect()) == list(range(50))
    more = distinct.numbered(first.unionByName(spark.createDataFrame([("a",), ("z",), ("z",)], "policy_number string")), known)
    assert sorted((r.policy_number, r.number) for r in more.collect()) == [("a", 50), ("z", 51)]


def test_bitmaps_count_over_any_group(spark):
    made = [(202401 + i % 3, "ab"[i % 2], f"p{i * 7 % 40}") for i in range(200)] + [(202401, "a", None), (2024010, "b", "p1")]
    df = spark.createDataFrame(made, "accountable_period int, source_system string, policy_number string")
    numbers = distinct.numbered(df).withColumn("number", F.col("number") * 30_000)  # many buckets
    maps = distinct.bitmaps(df, numbers, ["accountable_period", "source_system"])
    known = [r for r in made if r[2]]
    got = {(r.nivel, r.desde): r.polizas for r in distinct.calendar_counts(maps).collect()}
    for p in (202401, 202402, 202403, 2024010):
        assert got["mes", p] == len({k for q, _, k in known if q == p})
    assert got["trimestre", 202401] == got["año", 202401] == len({k for q, _, k in known if q < 999999}) and len(got) == 6
    by_source = {r.source_system: r.polizas for r in distinct.count_distinct_of(maps, ["source_system"]).collect()}
    assert by_source == {s: len({k for _, t, k in known if t == s}) for s in "ab"}


def test_bad_periods_share_a_partition(spark, facts, tmp_path, rows):
    bad = facts(*[{"accountable_period": 9_000_000 + i, "policy_transaction_movement_sk": i} for i in range(10_000)])
    df = two_months(facts).unionByName(bad).unionByName(facts({"accountable_period": 0}, {"accountable_period": None}))
    path = str(tmp_path / "fact")
    write_movements(df, path)
    folders = [p.name for p in (tmp_path / "fact").glob("accountable_period=*")]
    assert sorted(folders) == sorted(["accountable_period=0", "accountable_period=202401", "accountable_period=202402", "accountable_period=__HIVE_DEFAULT_PARTITION__"])
    back = read_movements(spark, path)
    assert rows(back.groupBy("accountable_period").count()) == rows(df.groupBy("accountable_period").count())
    months = back.filter("accountable_period = 202401")
    assert rows(months) == rows(df.filter("accountable_period = 202401"))
    assert "PartitionFilters: [isnotnull(accountable_period" in plan(months)


def test_scope_is_data(facts):
    df = facts({}, {"coverage_code": "8888"}, {"coverage_code": "77"}, {"source_system": "CO_new"}, {"receipt_type": "unificado-total"})
    assert universe(df).count() == 2
    own = Scope(excluded_coverages=("77",), sources=(("CO_new", ()), ("CO_iaxis", ())))
    assert universe(df, own).count() == 4
    assert universe(df, Scope(excluded_coverages=(), sources=())).count() == 0


def test_scratch_is_dropped(spark):
    session = spark.newSession()
    path = work_path(session, "gone")
    spark.range(3).write.parquet(path)
    assert path.startswith(scratch_folder(session)) and spark.read.parquet(path).count() == 3
    other = path.rsplit("/", 1)[0] + "-other"
    spark.range(3).write.parquet(other)
    before = scratch_folder
    try:
        tamiz.session.scratch_folder = lambda s: path
        drop_scratch(session)
    finally:
        tamiz.session.scratch_folder = before
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert spark.read.parquet(other).count() == 3


def test_absent_and_unreadable_values(spark):
    raw = spark.createDataFrame([("202401", "1", None), ("202401", "S", "n/a"), ("202402", None, "2024-01-01 05:00:00"), ("2024x", "x", "")],
                                "accountable_period string, current_record_flag string, load_ts string")
    got = {(r["periodo_contable"], r["tipo_indicador"], r["nombre_campo"]): (r["total_registros"], r["cantidad_mala"]) for r in loose_report(raw).collect()}
    assert got[202401, "completitud", "current_record_flag"] == (2, 0) and got[202401, "validez", "current_record_flag"] == (2, 1)
    assert got[202401, "completitud", "load_ts"] == (2, 1) and got[202401, "validez", "load_ts"] == (2, 1)
    assert got[202402, "completitud", "current_record_flag"] == (1, 1) and got[202402, "validez", "load_ts"] == (1, 0)
    assert got[None, "validez", "load_ts"] == (1, 1) and len(got) == 12
    typed = spark.createDataFrame([(1,)], "accountable_period int")
    assert loose_report(typed).count() == 0


def test_views_in_the_order_of_their_reads(spark, tmp_path):
    texts = {"c": "SELECT x FROM B WHERE x IN (SELECT id FROM a WHERE id > :least)", "B": "WITH t AS (SELECT id AS x FROM a) SELECT * FROM t;",
             "a": "SELECT id FROM range(5)", "d": "SELECT 1 AS x"}
    for name, text in texts.items():
        (tmp_path / f"{name}.sql").write_text(text)
    files = {name: tmp_path / f"{name}.sql" for name in texts}
    order = register_sql_views(spark, files, {"least": 2})
    assert sorted(order) == ["a", "b", "c", "d"] and order.index("a") < order.index("b") < order.index("c")
    assert sorted(r.x for r in spark.table("c").collect()) == [3, 4]
    files["a"].write_text("SELECT x AS id FROM c")
    with pytest.raises(ValueError, match="read each other"):
        register_sql_views(spark, files, {"least": 2})
