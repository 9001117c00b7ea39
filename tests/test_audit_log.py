"""The reports' audit log: every rule of both entities, counted as their verdicts are."""

from pyspark.sql import functions as F

from plumbline.operators.counts import POSITIVE, RELEVANT, program_counts, rule_counts
from plumbline.operators.program import RuleMapping
from plumbline.operators.verdicts import apply_rules
from plumbline.workload import entities as e
from plumbline.workload.queries import audit_log


def test_log_holds_every_rule(spark, sf_dir):
    held = {r.dq_rule_no: r for r in audit_log(spark, sf_dir).groupBy("dq_rule_no").agg(
        F.sum(RELEVANT).alias("n"), F.sum(POSITIVE).alias("p")).collect()}
    for entity, as_of, key in (("orders_gold", e.ORDERS_AS_OF, "order_id"), ("customer_gold", e.CUSTOMER_AS_OF, "cust_id")):
        program = e.program_of(entity)
        assert any(m.is_unique_rule for m in program)
        df = getattr(e, entity)(spark, sf_dir)
        for r in rule_counts(apply_rules(df, program, as_of, [key], keep=[]), program).collect():
            got = held.pop(r.dq_rule_no)
            assert (got.n, got.p) == (r[RELEVANT], r[POSITIVE])
    assert not held


def test_counts_alone_are_the_verdicts_counts(spark):
    """Hot and null values, first rows out of scope or tied in the declared order, two rules of a field, groups."""
    rows = [(i, i % 7 if i % 3 else None, f"t{i % 40}" * 30, i // 4, i % 5 % 2, i % 6 or None) for i in range(300)]
    schema = "k int, v int, t string, o int, status int, month int"
    program = [RuleMapping(i, f"r{i}", rule, f) for i, (rule, f) in enumerate([
        ("RULE_30_UNIQUE_IDENTIFIER", "v"), ("RULE_3_NUMERIC_NOT_NULL", "v"), ("RULE_30_UNIQUE_IDENTIFIER", "t"),
        ("RULE_30_UNIQUE_IDENTIFIER", "v"), ("RULE_99_UNKNOWN", "v"), ("RULE_30_UNIQUE_IDENTIFIER", "month")])]
    full = spark.createDataFrame(rows, schema)
    for df in (full, full.drop("status"), full.limit(0)):
        for order in (["k"], ["o"], ["v"], []):
            for by in ([], ["month"]):
                want = rule_counts(apply_rules(df, program, None, order, keep=by), program, by)
                got = program_counts(df, program, None, order, by)
                assert got.columns == want.columns
                assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr), (order, by)
