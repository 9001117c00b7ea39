"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
``--compare`` also times the plain form of the same work (chained windows, one
aggregate job per rule over the encoded text) and prints it to stderr.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from plumbline.functions.encoding import rule_evaluated, rule_passed  # noqa: E402
from plumbline.operators.counts import rule_counts  # noqa: E402
from plumbline.operators.program import RuleMapping  # noqa: E402
from plumbline.operators.verdicts import apply_rules, enrich_counted, judge  # noqa: E402
from plumbline.functions.rules import verdict  # noqa: E402
from plumbline.sources.staging import scratch_path, with_position  # noqa: E402
from plumbline.workload.queries import REGISTER  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
AS_OF = "2000-01-01"
REPEATS = 2

_RULES = [
    ("RULE_30_UNIQUE_IDENTIFIER", "l_orderkey"), ("RULE_3_NUMERIC_NOT_NULL", "l_orderkey"),
    ("RULE_3_NUMERIC_NOT_NULL", "l_partkey"), ("RULE_2_STRING_NOT_NULL", "l_returnflag"),
    ("RULE_10_NUMERIC_NON_NEGATIVE", "l_quantity"), ("RULE_11_NUMERIC_POSITIVE", "l_discount"),
    ("RULE_12_DATE_NOT_FUTURE", "l_shipdate"), ("RULE_21_BOOLEAN_FLAG", "l_tax"),
    ("RULE_30_UNIQUE_IDENTIFIER", "l_partkey"), ("RULE_30_UNIQUE_IDENTIFIER", "l_suppkey"),
    ("RULE_1_DATE_NOT_NULL", "l_shipdate"), ("RULE_13_DATE_NOT_PAST_LIMIT", "l_shipdate"),
    ("RULE_14_DATE_NOT_FUTURE_LIMIT", "l_shipdate"), ("RULE_20_ISO_COUNTRY_CODE", "l_linestatus"),
    ("RULE_2_STRING_NOT_NULL", "l_linestatus"), ("RULE_3_NUMERIC_NOT_NULL", "l_suppkey"),
    ("RULE_3_NUMERIC_NOT_NULL", "l_linenumber"), ("RULE_10_NUMERIC_NON_NEGATIVE", "l_extendedprice"),
    ("RULE_11_NUMERIC_POSITIVE", "l_quantity"), ("RULE_11_NUMERIC_POSITIVE", "l_extendedprice"),
    ("RULE_11_NUMERIC_POSITIVE", "l_tax"), ("RULE_10_NUMERIC_NON_NEGATIVE", "l_tax"),
    ("RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "l_tax|l_discount"),
    ("RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "l_linenumber|l_quantity"),
    ("RULE_41_POSITIVE_IF_COUNT_NONZERO", "l_linenumber|l_discount"),
]
PROGRAM = [RuleMapping(i, f"DQ_{i}", rule, field) for i, (rule, field) in enumerate(_RULES, 501)]

REGISTERED = [
    "p01_customer_pack", "p02_fund_trans_pack", "p03_telco_pack", "e01_encode_result", "a01_run_summary",
    "a02_rule_counts", "a02_rule_counts_from_results", "d11_unique_hot_null", "d11_unique_long_text",
    "w01_first_of_tied_rows", "w01_first_by_many_values", "q02_by_category", "q04_breach_register",
    "f05_latest_run_rows", "q01_overall", "q07_rule_detail_latest", "q09_entity_reports_all", "q12_trend",
    "q12_trend_per_entity", "d16_unique_template", "w01_first_after_rewrite", "s05_append_audit", "k01_onboard_entity", "r01_upsert_rules", "r03_upsert_mappings", "k02_run_entity",
]


def force(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def lineitem(spark: SparkSession) -> DataFrame:
    return with_position(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"))


def run_rules(spark: SparkSession, n: int) -> None:
    """Enrich and store, counting in the same pass: a whole run over lineitem."""
    frame, counted = enrich_counted(lineitem(spark), PROGRAM[:n], AS_OF, ["l_orderkey", "l_linenumber"])
    frame.write.parquet(scratch_path(spark, "bench"))
    assert counted.get["n"]


def count_rules(spark: SparkSession, n: int) -> None:
    """Typed verdicts and counts, without the encoded table."""
    program = PROGRAM[:n]
    force(rule_counts(apply_rules(lineitem(spark), program, AS_OF, ["l_orderkey", "l_linenumber"], keep=[]), program))


def plain_run(spark: SparkSession, n: int) -> None:
    """The same run, written plainly: a window per uniqueness rule, a job per rule."""
    program = PROGRAM[:n]
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    order = F.monotonically_increasing_id()
    for m in program:
        if m.is_unique_rule:
            rank = F.row_number().over(Window.partitionBy(*m.fields).orderBy(order))
            value = F.when(rank == 1, 1).otherwise(0)
        else:
            value = verdict(judge(df, [m], AS_OF).conditions[0][1])
        df = df.withColumn(f"_v{m.rule_mapping_id}", value)
    texts = [F.concat(F.lit(f"RULE_{m.rule_mapping_id}: "), F.col(f"_v{m.rule_mapping_id}").cast("string"))
             for m in program]
    path = scratch_path(spark, "plain")
    df.withColumn("DQ_RESULT", F.concat_ws(" | ", *texts)).drop(
        *[f"_v{m.rule_mapping_id}" for m in program]).write.parquet(path)
    stored = spark.read.parquet(path)
    for m in program:
        result = F.col("DQ_RESULT")
        stored.agg(
            F.count_if(rule_evaluated(result, m.rule_mapping_id)), F.count_if(rule_passed(result, m.rule_mapping_id))
        ).collect()


def best(action) -> float:
    seconds = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("plumbline-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for n in (1, 8, 25):
        times[f"run_lineitem_{n}_rules"] = best(lambda: run_rules(spark, n))
        times[f"count_lineitem_{n}_rules"] = best(lambda: count_rules(spark, n))
    for key in REGISTERED:
        times[key] = best(lambda: force(REGISTER[key].run(spark, SF_DIR)))
    if "--compare" in sys.argv:
        for n in (1, 8, 25):
            print(f"plain_run_{n}_rules {best(lambda: plain_run(spark, n))}", file=sys.stderr)
    print(json.dumps({
        "metric": "total seconds, best of 2 per query", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
