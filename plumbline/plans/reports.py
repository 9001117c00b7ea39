"""Report queries over the audit log.

Every report takes the log, the mappings and the catalogue, for one entity or
for all (``entity=None``), over all history or for the latest run only
(``latest=True``). The log is summed per rule before it meets the registry, so
the joins move one row per rule however long the history is. Join strategies
are left to the optimizer, which broadcasts the registry only while it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scores import pass_hundredths, pass_pct, rule_status
from plumbline.operators.counts import POSITIVE, RELEVANT

_TS = "dq_execution_timestamp"


def of_entity(mappings: DataFrame, entity: str | None) -> DataFrame:
    """Mappings of one entity; retired ones keep their history, so ``active`` is not asked."""
    return mappings if entity is None else mappings.where(F.col("source_table") == entity)


def latest_timestamp(results: DataFrame, mappings: DataFrame, entity: str | None) -> DataFrame:
    """One row: the entity's newest timestamp. The log meets the registry as one row per rule."""
    rules = of_entity(mappings, entity).select("dq_rule_no")
    return (
        results.groupBy("dq_rule_no")
        .agg(F.max(_TS).alias(_TS))
        .join(rules, "dq_rule_no", "left_semi")
        .agg(F.max(_TS).alias(_TS))
    )


def latest_run(results: DataFrame, mappings: DataFrame, entity: str | None) -> DataFrame:
    """The log rows that carry the entity's newest timestamp."""
    return results.join(F.broadcast(latest_timestamp(results, mappings, entity)), _TS)  # one row


def _log(results: DataFrame, mappings: DataFrame, entity: str | None, latest: bool) -> DataFrame:
    return latest_run(results, mappings, entity) if latest else results


def _per_rule(results: DataFrame) -> DataFrame:
    """Sums of a rule's history, and whether it ever was applied or skipped."""
    return results.groupBy("dq_rule_no").agg(
        F.sum(RELEVANT).alias("checks"),
        F.sum(POSITIVE).alias("passed"),
        F.max(F.col(RELEVANT) > 0).alias("applied"),
        F.max(F.col(RELEVANT) == 0).alias("skipped"),
        F.max(_TS).alias("last_ts"),
    )


def with_catalogue(mappings: DataFrame, generic: DataFrame, entity: str | None) -> DataFrame:
    """Mappings with their effective category; those without a catalogue row drop out."""
    rules = generic.select("generic_rule_desc_short", F.col("dq_category").alias("_generic_category"))
    return (
        of_entity(mappings, entity)
        .join(rules, "generic_rule_desc_short")
        .withColumn("DQ_CATEGORY", F.coalesce("dq_category", "_generic_category"))
        .drop("_generic_category")
    )


def _distinct_rules(condition: Column | None = None) -> Column:
    rule = F.col("dq_rule_no")
    return F.count_distinct(rule if condition is None else F.when(condition, rule))


def _totals(checks: str, passed: str) -> list[Column]:
    return [
        F.sum("checks").alias(checks),
        F.sum("passed").alias(passed),
        F.sum(F.col("checks") - F.col("passed")).alias("TOTAL_FAILED"),
    ]


def overall(
    results: DataFrame, mappings: DataFrame | None = None, entity: str | None = None, latest: bool = False
) -> DataFrame:
    """One row: rules, checks, passes and pass percentage. Without ``mappings`` the log alone counts, all entities."""
    if mappings is None:
        newest = F.broadcast(results.agg(F.max(_TS).alias(_TS)))  # one row
        joined = _per_rule(results.join(newest, _TS) if latest else results)
    else:
        joined = _per_rule(_log(results, mappings, entity, latest)).join(
            of_entity(mappings, entity).select("dq_rule_no"), "dq_rule_no"
        )
    checks, passed = ("TOTAL_CHECKS", "TOTAL_PASSED") if latest else ("TOTAL_RELEVANT_RECORDS", "TOTAL_POS_RESULTS")
    row = joined.agg(
        _distinct_rules().alias("TOTAL_RULES"),
        _distinct_rules(F.col("applied")).alias("RULES_APPLIED"),
        _distinct_rules(F.col("skipped")).alias("RULES_SKIPPED"),
        *_totals(checks, passed),
        F.max("last_ts").alias("last_ts"),
    )
    row = row.withColumn("OVERALL_PASS_PCT", pass_pct(F.col(passed), F.col(checks)))
    if latest:
        row = row.withColumn("LAST_RUN", F.date_format("last_ts", "yyyy-MM-dd HH:mm"))
    return row.drop("last_ts")


def by_category(
    results: DataFrame, mappings: DataFrame, generic: DataFrame, entity: str | None = None, latest: bool = False
) -> DataFrame:
    """Pass percentage per quality category."""
    joined = _per_rule(_log(results, mappings, entity, latest)).join(
        with_catalogue(mappings, generic, entity).select("dq_rule_no", "DQ_CATEGORY"), "dq_rule_no"
    )
    checks, passed = ("TOTAL_CHECKS", "TOTAL_PASSED") if latest else ("TOTAL_RELEVANT_RECORDS", "TOTAL_POS_RESULTS")
    applied = [] if latest else [_distinct_rules(F.col("applied")).alias("RULES_APPLIED")]
    return (
        joined.groupBy("DQ_CATEGORY")
        .agg(_distinct_rules().alias("TOTAL_RULES"), *applied, *_totals(checks, passed))
        .withColumn("PASS_PCT", pass_pct(F.col(passed), F.col(checks)))
        .orderBy("DQ_CATEGORY")
    )


def with_mapping(results: DataFrame, mappings: DataFrame) -> DataFrame:
    """Log entries with the mapping of their rule."""
    return results.join(mappings, "dq_rule_no")


def _rule_rows(
    results: DataFrame, mappings: DataFrame, generic: DataFrame, entity: str | None, latest: bool
) -> DataFrame:
    rules = with_catalogue(mappings, generic, entity).select(
        "dq_rule_no", "DQ_CATEGORY", "source_field", "generic_rule_desc_short", "rule_description",
        "threshold_pct", "owner_dept", "owner_user",
    )
    return with_mapping(_log(results, mappings, entity, latest), rules).select(
        "*",
        (F.col(RELEVANT) - F.col(POSITIVE)).alias("FAILED"),
        pass_pct(F.col(POSITIVE), F.col(RELEVANT)).alias("PASS_PCT"),
        rule_status(F.col(POSITIVE), F.col(RELEVANT)).alias("STATUS"),
    )


# Column names of the latest-run reports, as their readers know them.
_LATEST_NAMES = {
    "dq_rule_no": "DQ_RULE_NO",
    "source_field": "SOURCE_FIELD",
    "rule_description": "RULE_DESC",
    RELEVANT: "CHECKS",
    POSITIVE: "PASSED",
    "owner_dept": "OWNER_DEPT",
    "owner_user": "OWNER_USER",
}


def _renamed(names: list[str], renames: dict[str, str]) -> list[Column]:
    return [F.col(n).alias(renames.get(n, n)) for n in names]


def rule_detail(
    results: DataFrame, mappings: DataFrame, generic: DataFrame, entity: str | None = None, latest: bool = False
) -> DataFrame:
    """One row per log entry with score, status, threshold and owner."""
    rows = _rule_rows(results, mappings, generic, entity, latest).orderBy("DQ_CATEGORY", "dq_rule_no")
    if not latest:
        return rows.select(
            "dq_run_id", "dq_rule_no", "DQ_CATEGORY", "source_field", "generic_rule_desc_short", RELEVANT,
            POSITIVE, "FAILED", "PASS_PCT", "STATUS", "threshold_pct", "owner_dept", "owner_user",
        )
    names = ["dq_rule_no", "DQ_CATEGORY", "source_field", "generic_rule_desc_short", "rule_description", RELEVANT,
             POSITIVE, "FAILED", "PASS_PCT", "STATUS", "threshold_pct", "owner_dept", "owner_user"]
    renames = {"generic_rule_desc_short": "RULE_TYPE", "threshold_pct": "THRESHOLD_PCT"}
    return rows.select(*_renamed(names, _LATEST_NAMES | renames))


def breach_register(
    results: DataFrame, mappings: DataFrame, generic: DataFrame, entity: str | None = None, latest: bool = False
) -> DataFrame:
    """Log entries below their threshold, worst first."""
    rows = (
        _rule_rows(results, mappings, generic, entity, latest)
        .where((F.col(RELEVANT) > 0) & (F.col("PASS_PCT") < F.col("threshold_pct")))
        .orderBy("PASS_PCT", "dq_rule_no")
    )
    names = ["dq_rule_no", "DQ_CATEGORY", "source_field", "generic_rule_desc_short", "rule_description", RELEVANT,
             POSITIVE, "FAILED", "PASS_PCT", "threshold_pct", "owner_dept", "owner_user", _TS]
    renames = {"FAILED": "FAILED_RECORDS", "threshold_pct": "REQUIRED_PCT"}
    if latest:
        names = [n for n in names if n not in ("generic_rule_desc_short", _TS)]
        renames = _LATEST_NAMES | renames
    return rows.select(*_renamed(names, renames))


def category_series(categories: DataFrame) -> DataFrame:
    """Chart series: pass percentage and failures per category."""
    return categories.select("DQ_CATEGORY", "PASS_PCT", "TOTAL_FAILED")


def trend(results: DataFrame, mappings: DataFrame, generic: DataFrame, entity: str | None = None) -> DataFrame:
    """Pass percentage per run and category, with the change since the category's run before.

    Over all entities each has its own rows, named by ``source_table``.
    """
    key = ["DQ_CATEGORY"] if entity else ["source_table", "DQ_CATEGORY"]
    rules = with_catalogue(mappings, generic, entity).select("dq_rule_no", *key)
    runs = (
        results.withColumnsRenamed({RELEVANT: "checks", POSITIVE: "passed"})
        .join(rules, "dq_rule_no")
        .groupBy(_TS, *key)
        .agg(*_totals("TOTAL_CHECKS", "TOTAL_PASSED"))
    )
    score = pass_hundredths(F.col("TOTAL_PASSED"), F.col("TOTAL_CHECKS"))
    by_run = Window.partitionBy(*key).orderBy(_TS)
    change = F.col("_score") - F.lag("_score").over(by_run)
    return (
        runs.withColumn("_score", score)
        .withColumns({"PASS_PCT": F.col("_score").cast("double") / 100, "CHANGE": change.cast("double") / 100})
        .drop("_score")
        .orderBy(_TS, *key)
    )
