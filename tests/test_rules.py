import pytest
from pyspark.sql import functions as F

from tamiz.operators.counts import rule_counts, rule_report, to_long, totals, with_pct
from tamiz.rules import (Rule, accuracy_rules, check_rule_pack, completeness_rules, default_rules, optional_rules,
                         rule_catalog, validity_rules)

ALL = {r.code: r for r in default_rules() + optional_rules()}

BAD = {
    **{r.code: [{r.field: None}] for r in completeness_rules() if r.code not in ("C19", "C20", "C21")},
    "C19": [{"sseguro": None}],
    "C20": [{"receipt_type": None}],
    "C21": [{"receipt_number": None}, {"receipt_type": "not-unificado", "receipt_number": 5},
            {"receipt_type": "not-unificado", "source_system": "CO_as400"}],
    "E1": [{"source_system": None}, {"source_system": "co_iaxis"}, {"source_system": "Unknown"}],
    "E2": [{"current_record_flag": None}, {"current_record_flag": 2}],
    "E3": [{"receipt_type": None}, {"receipt_type": "otro"}, {"receipt_type": None, "source_system": "CO_as400"}],
    "W01": [{"source_system": None}, {"source_system": "Unknown"}],
    "W02": [{"coverage_code": None}, {"coverage_code": "Unknown"}],
    "W03": [{"product_code": v} for v in (None, "Unknown", "9007310", "A B1", " 6031 ", "X-1", "RC", "60\n", "ñ1")],
    "W04": [{"transaction_date_sk": v} for v in (None, -1, 202401, 202401155)],
    "W05": [{"transaction_type": v} for v in (None, "Unknown", "123")],
    "W06": [{"current_record_flag": None}, {"current_record_flag": 9}],
    "W07": [{"risk_number": None}, {"risk_number": "Unknown"}],
    "W08": [{"policy_number": None}, {"policy_number": "Unknown"}],
    "W09": [{"accountable_period": v} for v in (None, 2024010, 20240)],
    "W10": [{"policy_effective_date_sk": v} for v in (None, -1, 202401)],
    "W11": [{"inception_date_sk": v} for v in (None, -1, 202401011)],
    "W12": [{"transaction_effective_date_sk": v} for v in (None, -1, 0)],
    "X1": [{"policy_expiration_date_sk": v} for v in (None, -1, 7)],
}
GOOD_ROWS = {
    "C19": [{"sseguro": None, "source_system": "CO_as400"}, {"sseguro": None, "source_system": None}],
    "C20": [{"receipt_type": None, "source_system": "CO_as400"}],
    "C21": [{"receipt_number": None, "source_system": "CO_as400"},
            {"receipt_type": "not-unificado", "receipt_number": None}, {"receipt_type": None, "receipt_number": None}],
    "E2": [{"current_record_flag": 0}],
    "E3": [{"receipt_type": "unificado-total"}],
    "W03": [{"product_code": "RC", "source_system": "CO_as400"}, {"product_code": ""}, {"product_code": "900731"}],
    "W04": [{"transaction_date_sk": 99999999}],
    "W05": [{"transaction_type": "12"}],
    # A minus sign counts as a character, as in the printed form.
    "W10": [{"policy_effective_date_sk": -1234567}],
    "W09": [{"accountable_period": 202413}],
}


def test_each_rule_catches_its_bad_rows_and_only_them(facts):
    cases = [(code, row, 1) for code, bad in BAD.items() for row in bad]
    cases += [(code, row, 0) for code, good in GOOD_ROWS.items() for row in good]
    cases += [(code, {}, 0) for code in ALL]
    df = facts(*[row for _, row, _ in cases]).coalesce(1)
    flags = df.select(*[F.coalesce(F.expr(r.predicate).cast("int"), F.lit(0)).alias(c) for c, r in ALL.items()])
    wrong = [(code, row, expected) for (code, row, expected), got in zip(cases, flags.collect())
             if got[code] != expected]
    assert set(BAD) == set(ALL)
    assert wrong == []


def test_pack_sizes_and_self_check(spark, rows):
    assert [len(p()) for p in (completeness_rules, accuracy_rules, validity_rules)] == [22, 3, 12]
    assert check_rule_pack() == []
    assert sorted(r.code for r in default_rules() if r.masked) == [
        "C01", "C02", "C03", "C13", "C14", "C20", "E1", "E2", "W01", "W06"]
    listed = rule_catalog(spark).collect()
    assert {r.regla: r.predicado for r in listed} == {c: r.predicate for c, r in ALL.items()}
    assert {r.regla for r in listed if r.enmascarada} == {c for c, r in ALL.items() if r.masked}


def test_self_check_reports_problems():
    bad = [Rule("A", "validez", "nope", "nope IS NULL", ""), Rule("A", "validez", "nope", "nope IS NULL", "x")]
    found = " ".join(check_rule_pack(bad))
    for part in ("unknown field nope", "no explanation", "repeated code A", "repeated rule validez__nope", "no label"):
        assert part in found


def test_report_totals_equal_totals_operator(facts, rows):
    df = facts({}, {"branch_sk": None}, {"branch_sk": None, "accountable_period": 202402}, {"receipt_type": "otro"})
    pack = completeness_rules() + accuracy_rules()
    report = rule_report(df, pack)
    detail = with_pct(to_long(rule_counts(df, pack), pack))
    columns = ["periodo_contable", "tipo_indicador", "nombre_campo", "total_registros", "cantidad_mala", "porcentaje",
               "es_total"]
    assert rows(report.filter("es_total = 1"), *columns) == rows(totals(detail), *columns)
    assert rows(report.filter("es_total = 0"), *columns[:-1]) == rows(detail, *columns[:-1])
    by_name = {(r.periodo_contable, r.nombre_campo): r for r in report.filter("tipo_indicador = 'completitud'").collect()}
    assert by_name[202401, "branch_sk"].cantidad_mala == 1
    assert float(by_name[202401, "branch_sk"].porcentaje) == 66.67
    assert float(by_name[202402, "TOTAL_PERIODO"].porcentaje) == pytest.approx(95.45)
