"""Running the rules of an entity: enrich, count, log, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plumbline.functions.encoding import NOT_EVALUATED
from plumbline.operators.groups import first_of_group
from plumbline.operators.program import load_program, with_templates
from plumbline.operators.validation import check_program
from plumbline.operators.verdicts import enrich_counted
from plumbline.plans import reports
from plumbline.schemas import RESULTS, RULE_MAPPINGS, RULES_GENERIC
from plumbline.sources.audit import append_run, check_new_run, recent_log
from plumbline.sources.store import Store


@dataclass(frozen=True)
class RunOutcome:
    """What a run did: where it wrote, and the totals."""

    table: str
    report_date: str
    run_ts: dt.datetime
    total_rows: int
    total_checks: int
    passed_checks: int
    overall_dq_pct: float | None
    rules: list[tuple[str, int, int]]

    def line(self) -> str:
        return (
            f"SUCCESS: {self.total_rows} rows -> {self.table} | "
            f"Overall DQ%: {self.overall_dq_pct}% ({self.passed_checks}/{self.total_checks} checks)"
        )


def percentage(passed: int, checks: int) -> float | None:
    """Pass percentage, half up to two places, as the reports give it."""
    if not checks:
        return None
    return (passed * 20_000 + checks) // (2 * checks) / 100


def run_entity(
    store: Store,
    entity: str,
    as_of: dt.date | str | None = None,
    run_ts: dt.datetime | None = None,
    report_date: str | None = None,
    order_by: Sequence[str] | None = None,
    marker: str = NOT_EVALUATED,
    use_templates: bool = False,
) -> RunOutcome:
    """Apply an entity's active rules and append the counts to the audit log.

    The enriched table is written beside the old one in one pass over the entity,
    which counts the verdicts as it goes. It takes the old one's place when it is
    whole, and the log is appended last: a run that is refused or fails changes
    neither. Which duplicate comes first is said by ``order_by``, else by what the
    entity's pack declared, then by the rows' values.
    """
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    program = load_program(store.read(RULE_MAPPINGS), store.catalog, store.schema, entity)
    if use_templates:
        program = with_templates(program, store.read(RULES_GENERIC), as_of)
    check_program(program, store.read(entity).schema)
    check_new_run(store, run_ts, [m.dq_rule_no for m in program])
    if order_by is None:
        order_by = store.order(entity)

    df = store.read_entity(entity, positions=any(m.is_unique_rule or (m.template and first_of_group(m.template)) for m in program))
    out = f"{entity}_dq"
    enriched, counted = enrich_counted(df, program, as_of, order_by, marker)
    staged = store.stage(out, enriched)
    seen = counted.get
    rules = [(m.dq_rule_no, seen[f"r{i}"], seen[f"p{i}"]) for i, m in enumerate(program)]
    store.swap(staged, out)
    append_run(store, run_ts, rules)
    checks, passed = sum(r[1] for r in rules), sum(r[2] for r in rules)
    return RunOutcome(
        store.name(out), report_date or str(dt.date.today()), run_ts, seen["n"], checks, passed,
        percentage(passed, checks), rules,
    )


def entity_reports(store: Store, entity: str | None, latest: bool = False) -> dict[str, DataFrame]:
    """The four reports of an entity, or of all of them; over all, the total counts every rule in the log.

    Reports of the latest run read the log's partitions from the newest back.
    """
    mappings, generic = store.read(RULE_MAPPINGS), store.read(RULES_GENERIC)
    if not latest:
        results = store.read(RESULTS)
    else:
        results = recent_log(store, reports.of_entity(mappings, entity) if entity else None)
    return {
        "overall": reports.overall(results, mappings if entity else None, entity, latest),
        "by_category": reports.by_category(results, mappings, generic, entity, latest),
        "rule_detail": reports.rule_detail(results, mappings, generic, entity, latest),
        "breach_register": reports.breach_register(results, mappings, generic, entity, latest),
    }
