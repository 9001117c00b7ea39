"""The audit log: one appended row per rule and run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.scores import pass_pct
from plumbline.operators.counts import POSITIVE, RELEVANT
from plumbline.schemas import RESULTS, RESULTS_SCHEMA
from plumbline.sources.store import Store, run_date


def run_instant(run_ts: dt.datetime) -> Column:
    """The run's timestamp; without a zone it is read in the session's."""
    return F.lit(run_ts if run_ts.tzinfo else run_ts.isoformat(sep=" ")).cast("timestamp")


def check_new_run(store: Store, run_ts: dt.datetime, rules: Sequence[str]) -> int:
    """The log's highest run id; refuses a run whose timestamp the log already has for one of the rules.

    Only the partition of the run's day is searched; the highest id is one column of the log.
    """
    instant = run_instant(run_ts)
    day = store.spark.range(1).select(run_date(instant).cast("string")).first()[0]
    same_run = (F.col("dq_execution_timestamp") == instant) & F.col("dq_rule_no").isin(list(rules))
    if not store.read_log(day, day).where(same_run).isEmpty():
        raise ValueError(f"run {run_ts} is already in the audit log")
    return store.read(RESULTS).agg(F.coalesce(F.max("dq_run_id"), F.lit(0))).first()[0]


def append_run(store: Store, run_ts: dt.datetime, counts: Sequence[tuple[str, int, int]]) -> None:
    """Append (rule number, relevant, passing) of one run, numbered on from the log.

    A run is identified by its timestamp: appending the same one twice is refused,
    so repeating a run that failed after this step cannot double the history. Runs
    that end at the same time append one after the other.
    """
    if not counts:
        return
    schema = StructType([f for f in RESULTS_SCHEMA if f.name != "dq_execution_timestamp"])
    with store.exclusive(RESULTS):
        start = check_new_run(store, run_ts, [c[0] for c in counts])
        rows = [(start + i, rule, rel, pos) for i, (rule, rel, pos) in enumerate(counts, 1)]
        run = store.spark.createDataFrame(rows, schema)
        store.append(RESULTS, run.withColumn("dq_execution_timestamp", run_instant(run_ts)))


def recent_log(store: Store, rules: DataFrame | None = None) -> DataFrame:
    """The part of the log that holds the latest run of the rules (``dq_rule_no``), or of any.

    Days are tried from the newest back, twice as many each time, until one has an entry of the rules: what is read is
    at most about twice what lies after that run, and other partitions are not opened.
    """
    days = store.log_days()
    if days is None:
        return store.read(RESULTS)
    end, step = len(days), 1
    while end:
        begin = max(0, end - step)
        log = store.read_log(days[begin], days[end - 1])
        if rules is None or not log.join(rules.select("dq_rule_no"), "dq_rule_no", "left_semi").isEmpty():
            return log
        end, step = begin, step * 2
    return store.read(RESULTS)


def latest_entries(log: DataFrame, n: int = 30) -> DataFrame:
    """The newest rows of the log with their pass percentage."""
    return (
        log.select(
            "dq_run_id",
            "dq_execution_timestamp",
            "dq_rule_no",
            RELEVANT,
            POSITIVE,
            pass_pct(F.col(POSITIVE), F.col(RELEVANT)).alias("pass_pct"),
        )
        .orderBy(F.col("dq_run_id").desc())
        .limit(n)
    )
