"""The rule pack: each rule is a field and the SQL predicate of a bad row.

The predicate text is what runs and what the catalogue shows, so the two cannot drift.
Predicates follow SQL three-valued logic: a row counts only when the predicate is true.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.mappings import LONG_LABELS, SHORT_LABELS, lookup_table
from tamiz.model import ACCURACY, COMPLETENESS, MOVEMENT_SCHEMA, VALIDITY

IAXIS, AS400 = "CO_iaxis", "CO_as400"
NOT_UNIFIED, UNIFIED_DETAIL, UNIFIED_TOTAL = "not-unificado", "unificado-detail", "unificado-total"
SOURCES = (IAXIS, AS400)
RECEIPT_TYPES = (NOT_UNIFIED, UNIFIED_DETAIL, UNIFIED_TOTAL)


@dataclass(frozen=True)
class Rule:
    code: str
    dimension: str
    field: str
    predicate: str
    text: str
    masked: bool = False  # the shared universe already drops every row this rule could catch

    @property
    def counter(self) -> str:
        return f"{self.dimension}__{self.field}"

    def bad_rows(self):
        return F.expr(f"count_if({self.predicate}) AS `{self.counter}`")


# ---- predicate builders ---------------------------------------------------------------

def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def not_null(field: str, unless: str | None = None) -> str:
    return f"{field} IS NULL" + (f" AND {unless}" if unless else "")


def in_domain(field: str, values) -> str:
    return f"{field} IS NULL OR {field} NOT IN ({_sql_list(values)})"


def not_unknown(field: str) -> str:
    return f"{field} IS NULL OR {field} = 'Unknown'"


def max_length(field: str, n: int) -> str:
    return f"{not_unknown(field)} OR length({field}) > {n}"


def digits(field: str, n: int) -> str:
    """Not exactly ``n`` digits, as a range test on an integer column."""
    return f"{field} IS NULL OR {field} NOT BETWEEN {10 ** (n - 1)} AND {10 ** n - 1}"


def printed_length(field: str, n: int) -> str:
    """Not ``n`` characters when printed; a minus sign takes one. No string is built."""
    low, high = 10 ** (n - 1), 10 ** n - 1
    neg_low, neg_high = -(10 ** (n - 1) - 1), -(10 ** (n - 2))
    return (f"{field} IS NULL OR NOT ({field} BETWEEN {low} AND {high} "
            f"OR {field} BETWEEN {neg_low} AND {neg_high})")


def product_format(field: str = "product_code", source: str = "source_system") -> str:
    """Up to six letters or digits; digits only for the iaxis source."""
    return (f"{field} IS NULL OR NOT {field} RLIKE r'^[A-Za-z0-9]{{0,6}}\\z' "
            f"OR ({source} = '{IAXIS}' AND {field} RLIKE '[A-Za-z]')")


# ---- the pack ---------------------------------------------------------------------------

_NEVER_EMPTY = "El campo debe venir informado en cada movimiento."
_NO_WILDCARD = "Ni vacío ni el comodín 'Unknown'."
_EIGHT = "Clave de fecha de 8 posiciones (AAAAMMDD)."
_NOT_AS400 = f"source_system <> '{AS400}'"


def completeness_rules() -> list[Rule]:
    plain = [
        ("C01", "source_system"), ("C02", "accountable_period"), ("C03", "coverage_code"),
        ("C04", "branch_sk"), ("C05", "product_code"), ("C06", "transaction_date_sk"),
        ("C07", "policy_effective_date_sk"), ("C08", "policy_expiration_date_sk"),
        ("C09", "inception_date_sk"), ("C10", "transaction_type"),
        ("C11", "transaction_effective_date_sk"), ("C12", "transaction_type_description"),
        ("C13", "current_record_flag"), ("C14", "transaction_delta_billed_premium_amount"),
        ("C15", "transaction_delta_commission_amount"), ("C16", "risk_number"), ("C17", "policy_number"),
        ("C18", "transaction_delta_billed_premium_amount_raw"),
    ]
    masked = {"C01", "C02", "C03", "C13", "C14"}
    rules = [Rule(code, COMPLETENESS, name, not_null(name), _NEVER_EMPTY, code in masked) for code, name in plain]
    return rules + [
        Rule("C19", COMPLETENESS, "sseguro", not_null("sseguro", unless=_NOT_AS400),
             "Exigido salvo en AS400, que no lo maneja."),
        Rule("C20", COMPLETENESS, "receipt_type", not_null("receipt_type", unless=_NOT_AS400),
             "Exigido salvo en AS400, que no lo maneja.", True),
        Rule("C21", COMPLETENESS, "receipt_number",
             f"(receipt_number IS NULL AND {_NOT_AS400} AND receipt_type <> '{NOT_UNIFIED}') "
             f"OR (receipt_type = '{NOT_UNIFIED}' AND receipt_number IS NOT NULL)",
             "Los recibos unificados de iAxis llevan número; los no unificados no deben llevarlo."),
        Rule("C22", COMPLETENESS, "policy_transaction_movement_sk", not_null("policy_transaction_movement_sk"),
             _NEVER_EMPTY),
    ]


def accuracy_rules() -> list[Rule]:
    return [
        Rule("E1", ACCURACY, "source_system", in_domain("source_system", SOURCES),
             "Solo las dos fuentes conocidas.", True),
        Rule("E2", ACCURACY, "current_record_flag", in_domain("current_record_flag", (0, 1)),
             "Solo 0 (histórico) o 1 (vigente).", True),
        Rule("E3", ACCURACY, "receipt_type", in_domain("receipt_type", RECEIPT_TYPES),
             "Solo los tres tipos de recibo conocidos."),
    ]


def validity_rules() -> list[Rule]:
    return [
        Rule("W01", VALIDITY, "source_system", not_unknown("source_system"), _NO_WILDCARD, True),
        Rule("W02", VALIDITY, "coverage_code", not_unknown("coverage_code"), _NO_WILDCARD),
        Rule("W03", VALIDITY, "product_code", product_format(),
             "Hasta 6 letras o dígitos, sin espacios ni signos; en iAxis solo dígitos."),
        Rule("W04", VALIDITY, "transaction_date_sk", digits("transaction_date_sk", 8), "Ocho dígitos (AAAAMMDD)."),
        Rule("W05", VALIDITY, "transaction_type", max_length("transaction_type", 2),
             "Código de hasta 2 caracteres, distinto de 'Unknown'."),
        Rule("W06", VALIDITY, "current_record_flag", in_domain("current_record_flag", (0, 1)),
             "Solo 0 (histórico) o 1 (vigente).", True),
        Rule("W07", VALIDITY, "risk_number", not_unknown("risk_number"), _NO_WILDCARD),
        Rule("W08", VALIDITY, "policy_number", not_unknown("policy_number"), _NO_WILDCARD),
        Rule("W09", VALIDITY, "accountable_period", printed_length("accountable_period", 6),
             "Seis posiciones (AAAAMM)."),
        Rule("W10", VALIDITY, "policy_effective_date_sk", printed_length("policy_effective_date_sk", 8), _EIGHT),
        Rule("W11", VALIDITY, "inception_date_sk", printed_length("inception_date_sk", 8), _EIGHT),
        Rule("W12", VALIDITY, "transaction_effective_date_sk",
             printed_length("transaction_effective_date_sk", 8), _EIGHT),
    ]


def optional_rules() -> list[Rule]:
    """In the rule catalogue but off in the cube."""
    return [Rule("X1", VALIDITY, "policy_expiration_date_sk", printed_length("policy_expiration_date_sk", 8), _EIGHT)]


def default_rules() -> list[Rule]:
    return completeness_rules() + accuracy_rules() + validity_rules()


def rule_catalog(spark: SparkSession, rules: list[Rule] | None = None) -> DataFrame:
    """Documentation table of the pack: one row per rule with the predicate that runs."""
    rules = default_rules() + optional_rules() if rules is None else rules
    rows = [(r.code, r.dimension, r.field, r.text, r.predicate, str(r.masked).lower()) for r in rules]
    names = ["regla", "tipo_indicador", "nombre_campo", "explicacion", "predicado", "enmascarada"]
    return lookup_table(spark, rows, names).withColumn("enmascarada", F.col("enmascarada") == "true")


def with_explanation(report: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """A rule report or cube with the code, explanation, predicate and masking of each row's rule.

    Totals and rows of other dimensions belong to no rule and get NULL.
    """
    named = rule_catalog(report.sparkSession, default_rules() if rules is None else rules)
    return report.join(named, ["tipo_indicador", "nombre_campo"], "left")


def check_rule_pack(rules: list[Rule] | None = None) -> list[str]:
    """Inconsistencies of the pack; an empty list means it is sound."""
    rules = default_rules() + optional_rules() if rules is None else rules
    known = set(MOVEMENT_SCHEMA.fieldNames())
    counters, codes = [r.counter for r in rules], [r.code for r in rules]
    problems = [f"{r.code}: unknown field {r.field}" for r in rules if r.field not in known]
    problems += [f"{r.code}: no explanation" for r in rules if not r.text.strip()]
    problems += [f"{r.code}: no label for {r.field}" for r in rules if r.field not in LONG_LABELS]
    problems += [f"repeated code {c}" for c in sorted({c for c in codes if codes.count(c) > 1})]
    problems += [f"repeated rule {c}" for c in sorted({c for c in counters if counters.count(c) > 1})]
    problems += [f"no short label for {name}" for name in LONG_LABELS if name not in SHORT_LABELS]
    return problems
