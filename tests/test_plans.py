"""What the plans read and shuffle on a stored fact."""

import re
from datetime import date, datetime

import pytest

from tamiz.operators import alerts as al
from tamiz.operators import availability, counts, premium, reconcile, uniqueness
from tamiz.operators import universe as un
from tamiz.plans.alerts import alerts
from tamiz.plans.cube import quality_cube
from tamiz.rules import completeness_rules, default_rules
from tamiz.session import work_path
from tamiz.sources.movements import read_movement_table, read_movements, write_movements

AS_OF = date(2024, 2, 10)


@pytest.fixture(scope="module")
def path(spark, facts):
    path = work_path(spark, "fact")
    write_movements(facts(*[{"policy_transaction_movement_sk": i, "accountable_period": p}
                            for i, p in enumerate((202001, 202312, 202401, 202402))]), path)
    return path


@pytest.fixture(scope="module")
def fact(spark, path):
    return read_movements(spark, path)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def scans(df) -> list[str]:
    return re.findall(r"\(\d+\) Scan parquet.*?(?=\n\n)", plan(df), re.S)


def schema(scan: str) -> set[str]:
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", scan).group(1)))


def exchanges(df) -> list[str]:
    return re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)[^\n]*", plan(df))


def test_universe_prunes_and_pushes(fact):
    scan, = scans(counts.rule_counts(un.since_months(un.universe(fact), AS_OF, 36), completeness_rules()))
    assert "accountable_period" in re.search(r"PartitionFilters: (.*)", scan).group(1)
    pushed = re.search(r"PushedFilters: (.*)", scan).group(1)
    for part in ("EqualTo(current_record_flag,1)", "coverage_code,8888", "transaction_delta_billed_premium_amount,0",
                 "EqualTo(source_system,CO_as400)"):
        assert part in pushed
    assert not {"transaction_accounting_ts", "load_ts", "accountable_period"} & schema(scan)


def test_all_rules_take_one_scan_and_one_exchange_by_period(fact):
    df = counts.rule_counts(un.universe(fact), default_rules())
    assert len(scans(df)) == 1 and exchanges(df) == ["hashpartitioning"]
    report = counts.rule_report(un.universe(fact), default_rules())
    assert len(scans(report)) == 1 and len(exchanges(report)) == 2


def test_cube_reads_each_grouping_once_with_its_own_columns(fact):
    df = quality_cube(fact, AS_OF, stamp=datetime(2024, 2, 10))
    found = scans(df)
    assert len(found) == 4
    universe = {"current_record_flag", "coverage_code", "source_system", "receipt_type",
                "transaction_delta_billed_premium_amount"}
    narrow = sorted((schema(s) for s in found), key=len)
    assert narrow[0] == {"transaction_date_sk"}
    assert narrow[1] == {"transaction_accounting_ts", "product_code", "transaction_date_sk"}
    assert narrow[2] == universe | {"policy_transaction_movement_sk"}
    assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_alerts_read_the_cube_once(fact):
    # Four reads for the cube, one for balances and one for arrivals.
    assert len(scans(alerts(fact, AS_OF, stamp=datetime(2024, 2, 10)))) == 6


def test_month_list_prunes_partitions(spark, fact):
    df = availability.availability_month(fact, AS_OF, periods=[202401, 202402])
    scan, = scans(df)
    assert "202401" in re.search(r"PartitionFilters: (.*)", scan).group(1)
    pushed = re.search(r"PushedFilters: (.*)", scan).group(1)
    assert "GreaterThanOrEqual(transaction_date_sk,20240100)" in pushed


def test_accounting_time_windows_reach_the_scan(fact):
    for periods in (None, [202401, 202402]):
        scan, = scans(availability.availability_rule4(fact, AS_OF, periods=periods))
        assert "GreaterThanOrEqual(transaction_accounting_ts," in scan
        assert schema(scan) == {"transaction_accounting_ts", "product_code", "transaction_date_sk"}


def test_date_key_windows_reach_the_scan(fact):
    for df in (availability.daily_counts(fact, AS_OF), availability.load_arrival(fact, AS_OF),
               al.daily_balance(fact, AS_OF)):
        assert "GreaterThanOrEqual(transaction_date_sk," in scans(df)[0]


def test_categories_are_joined_after_the_first_aggregate(fact):
    text = plan(premium.premium_by_category(fact, AS_OF)).split("\n\n")[0]
    join = text.index("BroadcastHashJoin")
    assert text.count("HashAggregate") == 4
    # The tree prints parents first: two aggregates above the join, two below it.
    assert text[:join].count("HashAggregate") == 2
    assert "broadcast" not in open(premium.__file__).read()


def test_latest_and_top_rows_are_cut_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("cast(id % 7 as string) ambito", "id fecha", "'Crítica' estado", "'k' clave",
                                      "1 periodo_contable")
    tree = plan(al.actionable_panel(df, 3)).split("\n\n")[0]
    # A limit per group on both sides of the exchange.
    assert tree.count("WindowGroupLimit") == 2, tree
    for query in (al.latest(df, "fecha", within="ambito"), al.latest(df, "fecha")):
        # Rows that tie for the newest are not brought together; only the maximum is.
        tree = plan(query).split("\n\n")[0]
        assert "Window" not in tree and tree.count("Exchange (") <= 2, tree
    assert "TakeOrderedAndProject" in plan(al.balance_panel(df.selectExpr("'saldo_ramo' ambito", "fecha", "estado", "clave")))


def test_a_fact_bucketed_by_key_counts_duplicates_without_an_exchange_of_keys(spark, fact):
    spark.sql("DROP TABLE IF EXISTS bucketed_fact")
    (fact.write.partitionBy("accountable_period").bucketBy(4, "policy_transaction_movement_sk")
     .saveAsTable("bucketed_fact"))
    df = uniqueness.uniqueness(un.universe(read_movement_table(spark, "bucketed_fact")))
    assert len(exchanges(df)) == 1
    assert len(exchanges(uniqueness.uniqueness(un.universe(fact)))) == 2


def test_reconcile_never_joins(spark):
    a = spark.range(100).selectExpr("id k", "id v")
    text = plan(reconcile.reconcile(a, a, ["k"], ["v"]))
    assert "Join" not in text and len(exchanges(reconcile.reconcile(a, a, ["k"], ["v"]))) == 1


def test_no_python_in_any_plan(fact):
    for df in (quality_cube(fact, AS_OF), alerts(fact, AS_OF), premium.premium_by_source(fact, AS_OF)):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


def test_policies_are_counted_apart_from_amounts(fact):
    df = premium.premium_by_source(fact, AS_OF)
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan(df))
    assert [k for k in keys if "policy_number" in k] and len(scans(df)) == 2
    # The shuffle that finds distinct policies carries its keys and nothing else.
    wide = [s for s in re.findall(r"\(\d+\) Exchange\nInput \[(\d+)\]: ([^\n]*)", plan(df)) if "policy_number" in s[1]]
    assert [int(n) for n, _ in wide] == [3]
