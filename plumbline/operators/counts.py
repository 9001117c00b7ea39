"""Counting verdicts: per rule, and over the whole run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.encoding import (
    checks_in_row,
    label,
    passes_in_row,
)
from plumbline.functions.rules import column, out_of_scope
from plumbline.functions.scores import pass_pct, rule_score
from plumbline.operators.program import RuleMapping
from plumbline.operators.uniqueness import late_rows_per_group
from plumbline.operators.verdicts import STATUS, apply_rules, verdict_column
from plumbline.schemas import RESULT_COLUMN

RELEVANT = "dq_number_relevant_records"
POSITIVE = "dq_number_pos_results"


def rule_counts(
    verdicts: DataFrame, program: Sequence[RuleMapping], by: Sequence[Column | str] = ()
) -> DataFrame:
    """Relevant and passing rows per rule, all rules in one pass over typed verdicts.

    One aggregate row per group holds every counter; it is turned into one row
    per rule afterwards, so the shuffle does not grow with the number of rules.
    """
    if not program:
        empty = verdicts.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("false").drop("_n")
        return empty.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in (
            ("rule_mapping_id", "bigint"), ("dq_rule_no", "string"), (RELEVANT, "bigint"), (POSITIVE, "bigint"))])
    counters = [
        F.expr(sql)
        for i, m in enumerate(program)
        for v in [f"`{verdict_column(m.rule_mapping_id)}`"]
        for sql in (f"count({v}) AS _r{i}", f"coalesce(sum({v}), 0) AS _p{i}")
    ]
    wide = verdicts.groupBy(*by).agg(*counters)
    group_columns = [f"`{c}`" for c in wide.columns[: -len(counters)]]
    rows = ", ".join(
        f"{m.rule_mapping_id}L, {_sql_text(m.dq_rule_no)}, _r{i}, _p{i}" for i, m in enumerate(program)
    )
    per_rule = f"stack({len(program)}, {rows}) AS (rule_mapping_id, dq_rule_no, {RELEVANT}, {POSITIVE})"
    return wide.selectExpr(*group_columns, per_rule)


def program_counts(
    df: DataFrame,
    program: Sequence[RuleMapping],
    as_of: dt.date | str | None = None,
    order_by: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """The same as ``rule_counts`` of ``apply_rules``, for counts alone.

    Row rules, and the relevant rows of uniqueness rules, are counted in one pass. A uniqueness rule passes all of
    these but the later rows of repeated values, and only rows of repeated values are looked at again: no row is marked.
    """
    unique = [m for m in program if m.is_unique_rule]
    if not unique:
        return rule_counts(apply_rules(df, program, as_of, keep=by), program, by)
    masked = STATUS in df.columns
    in_scope = ~out_of_scope(STATUS) if masked else F.lit(True)
    kept = list(dict.fromkeys([*by, STATUS] if masked else by))
    judged = apply_rules(df, [m for m in program if not m.is_unique_rule], as_of, keep=kept)
    all_first = {verdict_column(m.rule_mapping_id): F.when(in_scope, 1) for m in unique}
    parts = rule_counts(judged.withColumns(all_first), program, by)
    late = late_rows_per_group(df, [m.source_field for m in unique], order_by, in_scope, by)
    for m in unique:
        rows = late[m.source_field].select(
            *[column(c) for c in by],
            F.lit(m.rule_mapping_id).cast("long").alias("rule_mapping_id"),
            F.lit(m.dq_rule_no).alias("dq_rule_no"),
            F.lit(0).cast("long").alias(RELEVANT),
            (-F.col("_dq_count")).alias(POSITIVE),
        )
        parts = parts.unionByName(rows)
    return parts.groupBy(*[column(c) for c in by], "rule_mapping_id", "dq_rule_no").agg(
        F.sum(RELEVANT).alias(RELEVANT), F.sum(POSITIVE).alias(POSITIVE)
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def result_patterns(enriched: DataFrame) -> DataFrame:
    """Distinct encoded results with their number of rows.

    Shows which verdicts occur together. Counts need no patterns: `rule_counts_from_results` and `run_summary` read
    the rows themselves.
    """
    return enriched.groupBy(RESULT_COLUMN).agg(F.count(F.lit(1)).alias("n_rows"))


def _weight(results: DataFrame) -> Column:
    """How many rows a row stands for: patterns say it, rows of a table are one each."""
    return F.col("n_rows") if "n_rows" in results.columns else F.lit(1).cast("long")


def rule_counts_from_results(results: DataFrame, program: Sequence[RuleMapping]) -> DataFrame:
    """Relevant and passing rows per rule, read back from the encoded column alone.

    ``results`` is a table with the column, whoever wrote it, or its ``result_patterns``. Two counters per rule fold in
    each task, so what is shuffled is a row per task, however many different strings there are. A rule absent from a
    row is not evaluated on it; blanks around a verdict do not matter.
    """
    if not program:
        return rule_counts(results.select(F.lit(1).alias("_n")).where("false"), [])
    bars = F.concat(F.lit("|"), F.replace(F.col(RESULT_COLUMN), F.lit(" "), F.lit("")), F.lit("|"))
    rows = results.select(bars.alias("_dq_bars"), _weight(results).alias("_dq_n"))
    counters = []
    for i, m in enumerate(program):
        passed, failed = (F.col("_dq_bars").contains(f"|{label(m.rule_mapping_id)}:{v}|") for v in (1, 0))
        counters += [F.sum(F.when(passed | failed, F.col("_dq_n"))).alias(f"_r{i}"), F.sum(F.when(passed, F.col("_dq_n"))).alias(f"_p{i}")]
    wide = rows.agg(*counters)
    per_rule = ", ".join(
        f"{m.rule_mapping_id}L, {_sql_text(m.dq_rule_no)}, coalesce(_r{i}, 0L), coalesce(_p{i}, 0L)" for i, m in enumerate(program)
    )
    return wide.selectExpr(f"stack({len(program)}, {per_rule}) AS (rule_mapping_id, dq_rule_no, {RELEVANT}, {POSITIVE})")


def run_summary(results: DataFrame) -> DataFrame:
    """One row: total rows, checks, passed checks and overall pass percentage, from a table with the encoded column or
    from its ``result_patterns``; three sums, nothing is grouped."""
    n = _weight(results)
    totals = results.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_rows"),
        F.sum(checks_in_row(F.col(RESULT_COLUMN)) * n).alias("total_checks"),
        F.sum(passes_in_row(F.col(RESULT_COLUMN)) * n).alias("passed_checks"),
    )
    return totals.select("*", pass_pct(F.col("passed_checks"), F.col("total_checks")).alias("overall_dq_pct"))


def with_score(counts: DataFrame) -> DataFrame:
    """Per-rule score beside the counts; 0.0 for a rule that evaluated nothing."""
    return counts.withColumn("score", rule_score(F.col(POSITIVE), F.col(RELEVANT)))
