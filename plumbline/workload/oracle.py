"""SQL twins of the rule types and reports, written independently of the Column builders."""

from __future__ import annotations

from plumbline.operators.program import RuleMapping
from plumbline.packs import Pack
from plumbline.workload import entities as e


def text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def condition(m: RuleMapping, as_of: str, order: str) -> str | None:
    """When a row passes, as DuckDB reads it."""
    f = m.fields
    a, b = f[0], f[-1]
    return {
        "RULE_1_DATE_NOT_NULL": f"{a} IS NOT NULL",
        "RULE_2_STRING_NOT_NULL": f"trim({a}) <> ''",
        "RULE_3_NUMERIC_NOT_NULL": f"{a} IS NOT NULL",
        "RULE_10_NUMERIC_NON_NEGATIVE": f"{a} >= 0",
        "RULE_11_NUMERIC_POSITIVE": f"{a} > 0",
        "RULE_12_DATE_NOT_FUTURE": f"CAST({a} AS DATE) <= DATE '{as_of}'",
        "RULE_13_DATE_NOT_PAST_LIMIT": f"CAST({a} AS DATE) >= DATE '{as_of}' - 3650",
        "RULE_14_DATE_NOT_FUTURE_LIMIT": f"CAST({a} AS DATE) <= DATE '{as_of}' + 3650",
        "RULE_20_ISO_COUNTRY_CODE": f"regexp_full_match({a}, '[A-Z]{{2}}')",
        "RULE_21_BOOLEAN_FLAG": f"trunc({a}) IN (0, 1)",
        "RULE_30_UNIQUE_IDENTIFIER": f"ROW_NUMBER() OVER (PARTITION BY {a} ORDER BY {order}) = 1",
        "RULE_40_TEMPORAL_WINDOW_CONSISTENCY": f"{a} <= {b}",
        "RULE_41_POSITIVE_IF_COUNT_NONZERO":
            f"{a} IS NOT NULL AND {b} IS NOT NULL AND ({a} = 0 OR {b} > 0)",
    }.get(m.rule)


def verdict(m: RuleMapping, as_of: str, order: str, masked: bool) -> str:
    """The verdict of one rule on one row."""
    passes = condition(m, as_of, order)
    if passes is None:
        return "CAST(NULL AS INTEGER)"
    skip = "WHEN status <> 1 THEN NULL " if masked else ""
    return f"CAST(CASE {skip}WHEN {passes} THEN 1 ELSE 0 END AS INTEGER)"


def verdicts(entity: str, program: list[RuleMapping], as_of: str, order: str, masked: bool, keep: str = "*") -> str:
    """CTE body: the entity's rows with one column v{id} per rule."""
    columns = ", ".join(f"{verdict(m, as_of, order, masked)} AS v{m.rule_mapping_id}" for m in program)
    return f"SELECT {keep}, {columns} FROM ({e.ENTITY_SQL[entity]}) AS t"


def encoded(program: list[RuleMapping], marker: str = "NULL") -> str:
    """The encoded result, from the v{id} columns."""
    parts = [
        f"'RULE_{m.rule_mapping_id}: ' || COALESCE(CAST(v{m.rule_mapping_id} AS VARCHAR), '{marker}')"
        for m in program
    ]
    return " || ' | ' || ".join(parts)


def counts(program: list[RuleMapping], source: str, group: str = "") -> str:
    """One row per rule (and group): relevant and passing rows."""
    head, tail = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return " UNION ALL ".join(
        f"SELECT {head}CAST({m.rule_mapping_id} AS BIGINT) AS rule_mapping_id, '{m.dq_rule_no}' AS dq_rule_no, "
        f"CAST(COUNT(v{m.rule_mapping_id}) AS BIGINT) AS dq_number_relevant_records, "
        f"CAST(COALESCE(SUM(v{m.rule_mapping_id}), 0) AS BIGINT) AS dq_number_pos_results FROM {source}{tail}"
        for m in program
    )


def hundredths(passed: str, checked: str) -> str:
    return (
        f"CASE WHEN {checked} > 0 THEN "
        f"(CAST({passed} AS HUGEINT) * 20000 + {checked}) // (2 * CAST({checked} AS HUGEINT)) END"
    )


def pct(passed: str, checked: str) -> str:
    return f"CAST({hundredths(passed, checked)} AS DOUBLE) / 100"


def values(rows: list[tuple], names: str) -> str:
    body = ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


def mapping_values(packs: list[Pack]) -> str:
    rows = [
        (m.rule_mapping_id, m.dq_rule_no, r.rule, p.entity, r.field, r.description, r.threshold_pct, r.category,
         p.owner_dept, p.owner_user)
        for p in packs
        for r, m in zip(sorted(p.rules, key=lambda x: x.rule_mapping_id), e.pack_program(p))
    ]
    return values(
        rows,
        "rule_mapping_id, dq_rule_no, generic_rule_desc_short, source_table, source_field, rule_description, "
        "threshold_pct, dq_category, owner_dept, owner_user",
    )


def generic_values() -> str:
    rows = [(r[0], r[2], r[5]) for r in e.generic_rules()]
    return values(rows, "generic_rule_desc_short, dq_category, applicable_types")


def history() -> str:
    """CTEs log, m and g: the audit log of both entities and the registry."""
    orders, customer = e.log_program("orders_gold"), e.log_program("customer_gold")
    ordinal = "CASE rule_mapping_id " + " ".join(
        f"WHEN {m.rule_mapping_id} THEN {i}" for i, m in enumerate(orders, 1)
    ) + " END"
    return f"""WITH ov AS MATERIALIZED ({verdicts("orders_gold", orders, e.ORDERS_AS_OF, "order_id", True)}),
cv AS MATERIALIZED ({verdicts("customer_gold", customer, e.CUSTOMER_AS_OF, "cust_id", True)}),
oc AS ({counts(orders, "ov", "run_month, month_no")}),
cc AS ({counts(customer, "cv")}),
log AS MATERIALIZED (
  SELECT CAST(month_no * {len(orders)} + {ordinal} AS BIGINT) AS dq_run_id, run_month AS dq_execution_timestamp,
         dq_rule_no, dq_number_relevant_records, dq_number_pos_results FROM oc
  UNION ALL
  SELECT CAST({e.CUSTOMER_RUN_ID_BASE} + rule_mapping_id AS BIGINT), TIMESTAMP '{e.CUSTOMER_RUN_TS}',
         dq_rule_no, dq_number_relevant_records, dq_number_pos_results FROM cc
),
m AS ({mapping_values(e.registry_packs())}),
g AS ({generic_values()})"""


REL, POS = "r.dq_number_relevant_records", "r.dq_number_pos_results"


LATEST = (
    "r.dq_execution_timestamp = (SELECT MAX(r2.dq_execution_timestamp) FROM log r2 "
    "JOIN m m2 ON r2.dq_rule_no = m2.dq_rule_no WHERE m2.source_table = '{entity}')"
)


def latest_rows(entity: str, columns: str) -> str:
    """Log rows of the entity's latest run, found first and by itself."""
    return f"""{history()},
newest AS MATERIALIZED (
  SELECT MAX(r2.dq_execution_timestamp) AS ts FROM log r2 JOIN m m2 ON r2.dq_rule_no = m2.dq_rule_no
  WHERE m2.source_table = '{entity}')
SELECT {columns} FROM log r JOIN newest ON r.dq_execution_timestamp = newest.ts"""


def _scope(entity: str | None, latest: bool) -> str:
    parts = []
    if entity:
        parts.append(f"m.source_table = '{entity}'")
    if latest and entity:
        parts.append(LATEST.format(entity=entity))
    elif latest:
        parts.append("r.dq_execution_timestamp = (SELECT MAX(dq_execution_timestamp) FROM log)")
    return " AND ".join(parts) or "TRUE"


def _sums(checks: str, passed: str) -> str:
    return (
        f"CAST(SUM({REL}) AS BIGINT) AS {checks}, CAST(SUM({POS}) AS BIGINT) AS {passed}, "
        f"CAST(SUM({REL} - {POS}) AS BIGINT) AS TOTAL_FAILED"
    )


_APPLIED = f"COUNT(DISTINCT CASE WHEN {REL} > 0 THEN r.dq_rule_no END)"
_SKIPPED = f"COUNT(DISTINCT CASE WHEN {REL} = 0 THEN r.dq_rule_no END)"


def overall(entity: str | None, latest: bool = False, joined: bool = True) -> str:
    names = ("TOTAL_CHECKS", "TOTAL_PASSED") if latest else ("TOTAL_RELEVANT_RECORDS", "TOTAL_POS_RESULTS")
    join = "JOIN m ON r.dq_rule_no = m.dq_rule_no" if joined else ""
    last = ", strftime(MAX(r.dq_execution_timestamp), '%Y-%m-%d %H:%M') AS LAST_RUN" if latest else ""
    return f"""{history()}
SELECT COUNT(DISTINCT r.dq_rule_no) AS TOTAL_RULES, {_APPLIED} AS RULES_APPLIED, {_SKIPPED} AS RULES_SKIPPED,
       {_sums(*names)}, {pct(f"SUM({POS})", f"SUM({REL})")} AS OVERALL_PASS_PCT{last}
FROM log r {join} WHERE {_scope(entity, latest)}"""


def by_category(entity: str | None, latest: bool = False) -> str:
    names = ("TOTAL_CHECKS", "TOTAL_PASSED") if latest else ("TOTAL_RELEVANT_RECORDS", "TOTAL_POS_RESULTS")
    applied = "" if latest else f"{_APPLIED} AS RULES_APPLIED, "
    return f"""{history()}
SELECT COALESCE(m.dq_category, g.dq_category) AS DQ_CATEGORY, COUNT(DISTINCT r.dq_rule_no) AS TOTAL_RULES, {applied}
       {_sums(*names)}, {pct(f"SUM({POS})", f"SUM({REL})")} AS PASS_PCT
FROM log r JOIN m ON r.dq_rule_no = m.dq_rule_no
JOIN g ON m.generic_rule_desc_short = g.generic_rule_desc_short
WHERE {_scope(entity, latest)} GROUP BY 1"""


def _rule_rows(columns: str, entity: str | None, latest: bool, extra: str = "TRUE") -> str:
    return f"""{history()}
SELECT {columns}
FROM log r JOIN m ON r.dq_rule_no = m.dq_rule_no
JOIN g ON m.generic_rule_desc_short = g.generic_rule_desc_short
WHERE {_scope(entity, latest)} AND {extra}"""


_STATUS = f"CASE WHEN {REL} = 0 THEN 'SKIPPED' WHEN {POS} = {REL} THEN 'PASS' ELSE 'BREACH' END"
_THRESHOLD = "CAST(m.threshold_pct AS DOUBLE)"


def rule_detail(entity: str | None, latest: bool = False) -> str:
    category = "COALESCE(m.dq_category, g.dq_category) AS DQ_CATEGORY"
    score = f"{REL} - {POS} AS FAILED, {pct(POS, REL)} AS PASS_PCT, {_STATUS} AS STATUS"
    if latest:
        return _rule_rows(
            f"r.dq_rule_no AS DQ_RULE_NO, {category}, m.source_field AS SOURCE_FIELD, "
            f"g.generic_rule_desc_short AS RULE_TYPE, m.rule_description AS RULE_DESC, {REL} AS CHECKS, "
            f"{POS} AS PASSED, {score}, {_THRESHOLD} AS THRESHOLD_PCT, m.owner_dept AS OWNER_DEPT, "
            "m.owner_user AS OWNER_USER", entity, latest)
    return _rule_rows(
        f"r.dq_run_id, r.dq_rule_no, {category}, m.source_field, g.generic_rule_desc_short, {REL}, {POS}, {score}, "
        f"{_THRESHOLD} AS threshold_pct, m.owner_dept, m.owner_user", entity, latest)


def breach_register(entity: str | None, latest: bool = False) -> str:
    category = "COALESCE(m.dq_category, g.dq_category) AS DQ_CATEGORY"
    extra = f"{REL} > 0 AND {pct(POS, REL)} < m.threshold_pct"
    score = f"{REL} - {POS} AS FAILED_RECORDS, {pct(POS, REL)} AS PASS_PCT, {_THRESHOLD} AS REQUIRED_PCT"
    if latest:
        return _rule_rows(
            f"r.dq_rule_no AS DQ_RULE_NO, {category}, m.source_field AS SOURCE_FIELD, "
            f"m.rule_description AS RULE_DESC, {REL} AS CHECKS, {POS} AS PASSED, {score}, "
            "m.owner_dept AS OWNER_DEPT, m.owner_user AS OWNER_USER", entity, latest, extra)
    return _rule_rows(
        f"r.dq_rule_no, {category}, m.source_field, g.generic_rule_desc_short, m.rule_description, {REL}, {POS}, "
        f"{score}, m.owner_dept, m.owner_user, r.dq_execution_timestamp", entity, latest, extra)


def trend(entity: str | None) -> str:
    named, grouped, by = ("", "1, 2", "") if entity else ("m.source_table, ", "1, 2, 3", "source_table, ")
    return f"""{history()},
t AS (
  SELECT r.dq_execution_timestamp, {named}COALESCE(m.dq_category, g.dq_category) AS DQ_CATEGORY,
         {_sums("TOTAL_CHECKS", "TOTAL_PASSED")}
  FROM log r JOIN m ON r.dq_rule_no = m.dq_rule_no
  JOIN g ON m.generic_rule_desc_short = g.generic_rule_desc_short
  WHERE {_scope(entity, False)} GROUP BY {grouped}
),
s AS (SELECT *, {hundredths("TOTAL_PASSED", "TOTAL_CHECKS")} AS score FROM t)
SELECT dq_execution_timestamp, {by}DQ_CATEGORY, TOTAL_CHECKS, TOTAL_PASSED, TOTAL_FAILED,
       CAST(score AS DOUBLE) / 100 AS PASS_PCT,
       CAST(score - LAG(score) OVER (PARTITION BY {by}DQ_CATEGORY ORDER BY dq_execution_timestamp) AS DOUBLE) / 100 AS CHANGE
FROM s"""
