"""Runs that are refused or fail, packs from files, orders that packs declare, programs at the edge."""

import dataclasses
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from plumbline.functions.encoding import decode
from plumbline.operators.counts import rule_counts
from plumbline.operators.program import RuleMapping, with_templates
from plumbline.operators.validation import check_program
from plumbline.operators.verdicts import apply_rules, enrich_counted
from plumbline.packs import PackRule, load_pack, read_pack
from plumbline.packs.base_rules import ALL_RULES
from plumbline.plans import reports
from plumbline.plans.onboarding import onboard
from plumbline.plans.runs import entity_reports, run_entity
from plumbline.schemas import RESULTS
from plumbline.sources.registry import generic_rule_rows
from tests.test_flows import DAY, small_pack, store, things  # noqa: F401


def state(store):  # noqa: F811
    return sorted(tuple(r) for r in store.read("things_dq").collect()), store.read(RESULTS).count(), store.tables()


def test_refused_and_failing_runs_change_nothing(spark, store):  # noqa: F811
    onboard(store, small_pack(), things(spark), DAY)
    run_entity(store, "things", "2024-01-01", dt.datetime(2024, 1, 1))
    before = state(store)
    spark.sql(f"ALTER TABLE {store.name('things')} RENAME TO {store.schema}.other")
    things(spark).withColumn("v", F.lit(-1)).write.saveAsTable(store.name("things"))
    with pytest.raises(ValueError, match="already in the audit log"):
        run_entity(store, "things", "2024-01-01", dt.datetime(2024, 1, 1))
    assert state(store)[0] == before[0]
    store.discard("things")
    broken = things(spark).withColumn("v", F.when(F.col("k") > 2, F.raise_error(F.lit("broken")).cast("int")).otherwise(1))
    broken.createOrReplaceTempView("broken")
    with pytest.raises(Exception, match="broken"):
        store.stage("things_dq", broken)
    store.discard("other")
    assert state(store)[:2] == before[:2] and not [t for t in store.tables() if "__" in t]


def test_one_log_file_per_run(spark, store):  # noqa: F811
    store.create_registry()
    rows = spark.range(40).repartition(7).select(F.col("id").alias("dq_run_id"), F.current_timestamp().alias("dq_execution_timestamp"),
        F.lit("r").alias("dq_rule_no"), F.lit(1).cast("long").alias("dq_number_relevant_records"), F.lit(1).cast("long").alias("dq_number_pos_results"))
    store.append(RESULTS, rows)
    assert len(store.read(RESULTS).inputFiles()) == 1


def test_counting_a_run_shuffles_nothing(spark):
    """Independent rules that fail one row in five: as many verdict strings as rows, and no exchange for the counts."""
    df = spark.range(500).select(*[F.expr(f"IF(xxhash64(id, {i}) % 5 = 0, NULL, id)").alias(f"c{i}") for i in range(25)])
    program = [RuleMapping(i, f"r{i}", "RULE_3_NUMERIC_NOT_NULL", f"c{i}") for i in range(25)]
    frame, counted = enrich_counted(df, program)
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    assert len({r.DQ_RESULT for r in frame.collect()}) > 400
    seen = counted.get
    assert seen["n"] == 500
    expected = df.agg(*[F.count(f"c{i}") for i in range(25)]).first()
    assert [seen[f"p{i}"] for i in range(25)] == list(expected) and all(seen[f"r{i}"] == 500 for i in range(25))


def test_order_comes_from_the_pack(spark, store):  # noqa: F811
    rows = spark.createDataFrame([(1, "a", 0), (2, "a", 1), (3, "b", 1)], "k int, v string, status int")
    pack = dataclasses.replace(small_pack(rules=(PackRule(1, "RULE_30_UNIQUE_IDENTIFIER", "v", "", 100.0, None),)), order_by=("k",))
    onboard(store, pack, rows, DAY)
    assert store.order("things") == ["k"]
    out = run_entity(store, "things", run_ts=dt.datetime(2024, 1, 1))
    assert out.rules[0][1:] == (2, 1)  # the first 'a' is out of scope, the second is a duplicate


def test_pack_from_a_file(tmp_path):
    pack = load_pack("telco_gold")
    path = tmp_path / "pack.json"
    path.write_text(json.dumps(dataclasses.asdict(pack)))
    assert read_pack(path) == pack
    path.write_text(json.dumps(dataclasses.asdict(pack) | {"owner": "x"}))
    with pytest.raises(ValueError, match="unknown owner"):
        read_pack(path)


def test_command_line_takes_a_pack_and_prints_every_row(spark, tmp_path, capsys):
    import uuid

    from plumbline.__main__ import main

    schema = f"cli_{uuid.uuid4().hex[:8]}"
    rules = tuple(PackRule(i, "RULE_11_NUMERIC_POSITIVE", "v", "", 100.0, None) for i in range(1, 61))
    path = tmp_path / "own.json"
    path.write_text(json.dumps(dataclasses.asdict(small_pack(rules=rules))))
    things(spark).createOrReplaceTempView("things_source")
    where = ["--dq-schema", schema, "--target-table", "things"]
    main(["onboard", *where, "--source", "things_source", "--location", str(tmp_path / schema), "--pack", str(path)])
    main(["run", *where, "--as-of", "2024-01-01"])
    capsys.readouterr()
    main(["report", *where, "--latest"])
    printed = capsys.readouterr().out
    assert all(f"DQ_{i}_NUMERIC_POSITIVE_v" in printed for i in range(1, 61)) and "more)" not in printed
    main(["report", *where, "--latest", "--rows", "5"])
    assert "(55 more)" in capsys.readouterr().out


@pytest.mark.parametrize("rule, fields, kinds", [
    ("RULE_12_DATE_NOT_FUTURE", "a", "a bigint"), ("RULE_13_DATE_NOT_PAST_LIMIT", "a", "a double"),
    ("RULE_14_DATE_NOT_FUTURE_LIMIT", "a", "a int"), ("RULE_21_BOOLEAN_FLAG", "a", "a date"),
    ("RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "a|b", "a string, b int"), ("RULE_41_POSITIVE_IF_COUNT_NONZERO", "a|b", "a string, b int"),
])
def test_rules_that_cannot_judge_a_type_are_refused(spark, rule, fields, kinds):
    schema = spark.createDataFrame([], kinds).schema
    with pytest.raises(ValueError, match="cannot judge"):
        check_program([RuleMapping(1, "n", rule, fields)], schema)


def test_empty_program(spark):
    counts = rule_counts(apply_rules(spark.range(3), [], keep=["id"]), [])
    assert counts.count() == 0 and counts.columns[0] == "rule_mapping_id"
    assert spark.range(1).select(decode(F.lit("")).alias("m")).first().m == {}


def test_uniqueness_template_becomes_the_rule(spark):
    generic = generic_rule_rows(spark, ALL_RULES).withColumn("generic_rule_desc_short", F.concat(F.lit("U_"), "generic_rule_desc_short"))
    program = with_templates([RuleMapping(1, "n", "U_RULE_30_UNIQUE_IDENTIFIER", "v")], generic)
    assert program[0].is_unique_rule and program[0].template is None


def test_reports_over_all_entities(spark, store):  # noqa: F811
    """A rule the registry lacks counts in the total; the latest run is honoured without a registry."""
    onboard(store, small_pack(), things(spark), DAY)
    for day in (1, 2):
        run_entity(store, "things", "2024-01-01", dt.datetime(2024, 1, day))
    from plumbline.sources.audit import append_run

    append_run(store, dt.datetime(2024, 1, 2), [("unregistered", 10, 10)])
    total = entity_reports(store, None)["overall"].first()
    assert (total.TOTAL_RULES, total.TOTAL_RELEVANT_RECORDS, total.TOTAL_POS_RESULTS) == (4, 34, 26)
    latest = reports.overall(store.read(RESULTS), latest=True).first()
    assert (latest.TOTAL_RULES, latest.TOTAL_CHECKS, latest.LAST_RUN) == (4, 22, "2024-01-02 00:00")
