"""Rule application: pass conditions, typed verdicts, encoded result column."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from plumbline.functions.encoding import NOT_EVALUATED, encode_conditions
from plumbline.functions.rules import column, out_of_scope, row_rule, verdict
from plumbline.operators.groups import first_of_group, take_windows, with_group_values
from plumbline.operators.program import RuleMapping
from plumbline.operators.templates import template_passes
from plumbline.operators.uniqueness import mark_first
from plumbline.schemas import RESULT_COLUMN
from plumbline.sources.staging import POSITION

log = logging.getLogger(__name__)

STATUS = "status"


@dataclass(frozen=True)
class Judged:
    """An entity frame with, per rule, the condition under which a row passes."""

    df: DataFrame
    columns: list[str]
    conditions: list[tuple[RuleMapping, Column | None]]
    skipped: Column | None


def verdict_column(rule_mapping_id: int) -> str:
    return f"_DQ_{rule_mapping_id}"


def judge(
    df: DataFrame,
    program: Sequence[RuleMapping],
    as_of: dt.date | str | None = None,
    order_by: Sequence[str] = (),
) -> Judged:
    """Resolve every mapping of the program to a pass condition.

    A rule type that is neither built in nor given a template has no condition.
    Uniqueness is judged over all rows, those out of scope included.
    """
    columns = [c for c in df.columns if c not in POSITION]
    skipped = out_of_scope(STATUS) if STATUS in columns else None
    df, templates = _without_windows(df, {m.rule_mapping_id: m.template for m in program if m.template})
    unique_fields = [m.source_field for m in program if m.is_unique_rule]
    firsts: dict[str, Column] = {}
    if unique_fields:
        df, firsts = mark_first(df, unique_fields, order_by)

    conditions = []
    for m in program:
        if m.is_unique_rule:
            passes = firsts[m.source_field]
        elif m.is_row_rule:
            passes = row_rule(m.rule, m.fields, as_of)
        elif m.template:
            passes = template_passes(templates[m.rule_mapping_id])
        else:
            log.warning("%s: nobody defines %s, its verdicts are NULL", m.dq_rule_no, m.rule)
            passes = None
        conditions.append((m, passes))
    return Judged(df, columns, conditions, skipped)


def _without_windows(df: DataFrame, templates: dict[int, str]) -> tuple[DataFrame, dict[int, str]]:
    """Templates whose windows have become columns of the frame: first rows are marked, aggregates are looked up.

    A window of any other form stays in its template, as Spark runs it.
    """
    plain, values = {}, {}
    for n, (rule, template) in enumerate(templates.items()):
        first = first_of_group(template)
        if first is None:
            plain[rule], found = take_windows(template, f"_dq_group_{n}_")
            values |= found
            continue
        field, order = first
        held = df.columns
        marked, flags = mark_first(df, [field], order)
        df = marked.select(*[column(c) for c in held], flags[field].alias(f"_dq_ordered_{n}"))
        plain[rule] = f"`_dq_ordered_{n}`"
    return with_group_values(df, values), plain


def apply_rules(
    df: DataFrame,
    program: Sequence[RuleMapping],
    as_of: dt.date | str | None = None,
    order_by: Sequence[str] = (),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The entity's columns (or those in ``keep``) and one typed verdict column per rule."""
    judged = judge(df, program, as_of, order_by)
    verdicts = []
    for m, passes in judged.conditions:
        value = verdict(passes)
        if judged.skipped is not None and passes is not None:
            value = F.when(~judged.skipped, value)
        verdicts.append(value.alias(verdict_column(m.rule_mapping_id)))
    kept = judged.columns if keep is None else keep
    return judged.df.select(*[column(c) for c in kept], *verdicts)


def enrich(
    df: DataFrame,
    program: Sequence[RuleMapping],
    as_of: dt.date | str | None = None,
    order_by: Sequence[str] = (),
    marker: str = NOT_EVALUATED,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The entity's columns (or those in ``keep``) and the encoded ``DQ_RESULT``."""
    judged = judge(df, program, as_of, order_by)
    encoded = encode_conditions(
        [(m.rule_mapping_id, passes) for m, passes in judged.conditions], judged.skipped, marker
    )
    kept = judged.columns if keep is None else keep
    return judged.df.select(*[column(c) for c in kept], encoded.alias(RESULT_COLUMN))


def enrich_counted(
    df: DataFrame,
    program: Sequence[RuleMapping],
    as_of: dt.date | str | None = None,
    order_by: Sequence[str] = (),
    marker: str = NOT_EVALUATED,
) -> tuple[DataFrame, Observation]:
    """The enriched frame, and what its next action will have observed: ``n`` rows and, for the i-th rule, ``r{i}``
    evaluated and ``p{i}`` passing ones.

    Counting is part of the write: fixed counters per task, no second scan and nothing to shuffle.
    """
    judged = judge(df, program, as_of, order_by)
    encoded = encode_conditions(
        [(m.rule_mapping_id, passes) for m, passes in judged.conditions], judged.skipped, marker
    )
    in_scope = F.lit(True) if judged.skipped is None else ~judged.skipped
    flags, counters = {}, [F.count(F.lit(1)).alias("n")]
    for i, (_, passes) in enumerate(judged.conditions):
        if passes is None:
            counters += [F.count(F.lit(None)).alias(f"r{i}"), F.count(F.lit(None)).alias(f"p{i}")]
            continue
        flags[f"_dq_pass_{i}"] = F.coalesce(passes, F.lit(False))
        counters += [
            F.count(F.when(F.col("_dq_in_scope"), 1)).alias(f"r{i}"),
            F.count(F.when(F.col("_dq_in_scope") & F.col(f"_dq_pass_{i}"), 1)).alias(f"p{i}"),
        ]
    kept = [column(c) for c in judged.columns]
    counted = Observation()
    rows = judged.df.select(
        *kept, encoded.alias(RESULT_COLUMN), in_scope.alias("_dq_in_scope"), *[v.alias(n) for n, v in flags.items()]
    ).observe(counted, *counters)
    return rows.select(*kept, RESULT_COLUMN), counted
