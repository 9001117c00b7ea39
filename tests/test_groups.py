"""Values of a row's group, against windows; templates with windows; counts read back from stored results."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators.counts import result_patterns, rule_counts_from_results, run_summary
from plumbline.operators.groups import GroupValue, first_of_group, take_windows, with_group_values
from plumbline.operators.program import RuleMapping, with_templates
from plumbline.operators.verdicts import apply_rules
from plumbline.sources.registry import generic_rule_rows


def rows(spark, n=3000):
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.expr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 6 = 1 THEN 'hot' WHEN id % 6 = 2 THEN 'p' || (id DIV 12) ELSE 's' || id END").alias("a b"),
        F.expr("IF(id % 4 = 0, NULL, id % 11)").alias("w"),
        F.expr("CAST(id % 17 AS DECIMAL(9,2))").alias("d"),
    )


@pytest.mark.parametrize("most", [None, 0])
def test_group_values_match_windows(spark, most):
    sql = ("COUNT(*) OVER (PARTITION BY `a b`) + count(w) over (partition by `a b`, d) * MIN(d) OVER (PARTITION BY w) + "
           "coalesce(SUM(w) OVER (PARTITION BY `a b`), 0) + MAX(k) OVER (PARTITION BY k) + AVG(w) OVER (PARTITION BY `a b`)")
    taken, values = take_windows(sql, "_dq_g")
    assert "OVER" not in taken.upper() and len(values) == 6
    df = rows(spark).repartition(5)
    options = {} if most is None else {"max_broadcast": most}
    found = with_group_values(df, values, **options)
    a = sorted(tuple(r) for r in found.select("k", F.expr(taken).alias("v")).collect())
    b = sorted(tuple(r) for r in df.select("k", F.expr(sql).alias("v")).collect())
    assert a == b and found.schema["_dq_g0"].dataType.simpleString() == "bigint"
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_other_windows_stay_as_they_are():
    for sql in ("RANK() OVER (PARTITION BY a ORDER BY b) = 1", "SUM(a) OVER (PARTITION BY b ORDER BY c) > 1",
                "MIN(a + 1) OVER (PARTITION BY b) = a", "MIN(a) OVER (PARTITION BY lower(b)) = a", "COUNT(*) > 1"):
        assert take_windows(sql, "x") == (sql, {}) and first_of_group(sql) is None
    assert first_of_group("row_number() over (partition by `a``b` order by c, `d e`) = 1") == ("a`b", ("c", "d e"))


def test_no_rows_and_no_repeats(spark):
    _, values = take_windows("COUNT(*) OVER (PARTITION BY w) + SUM(w) OVER (PARTITION BY w)", "g")
    assert with_group_values(rows(spark).limit(0), values).count() == 0
    alone = with_group_values(spark.range(5).withColumnRenamed("id", "w"), values).collect()
    assert [(r.w, r.g0, r.g1) for r in sorted(alone)] == [(i, 1, i) for i in range(5)]


def test_window_templates_judge_without_a_window(spark):
    names = {"U_ONE": "COUNT(*) OVER (PARTITION BY {v}) = 1", "U_FIRST": "ROW_NUMBER() OVER (PARTITION BY {v} ORDER BY {o}) = 1",
             "U_MIN": "{o} = MIN({o}) OVER (PARTITION BY {v})"}
    generic = generic_rule_rows(spark, [(n, "", "", "", t, "", "", "") for n, t in names.items()])
    fields = {"U_ONE": "v", "U_FIRST": "v|o", "U_MIN": "o|v"}
    program = with_templates([RuleMapping(i, n, n, fields[n]) for i, n in enumerate(names)], generic)
    df = rows(spark).select("k", F.col("a b").alias("v"), F.expr("-k").alias("o"), F.expr("k % 5 <> 1").cast("int").alias("status"))
    judged = apply_rules(df, program, order_by=["k"], keep=["k"])
    assert "Window" not in judged._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(tuple(r) for r in judged.collect())
    want = df.selectExpr("k", *[f"IF(status = 1, CAST({t} AS INT), NULL)" for t in (
        "COUNT(*) OVER (PARTITION BY v) = 1", "ROW_NUMBER() OVER (PARTITION BY v ORDER BY o) = 1", "o = MIN(o) OVER (PARTITION BY v)")])
    assert got == sorted(tuple(r) for r in want.collect())


def test_results_are_counted_without_grouping_them(spark):
    """Spacing of others' writers, absent rules and both markers."""
    texts = ["RULE_1: 1 | RULE_11: 0 | RULE_2: NULL", "RULE_11:1|RULE_1:0", "RULE_2: N | RULE_1: 1", "", None, "RULE_111: 1"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "DQ_RESULT string")
    program = [RuleMapping(1, "a", "x", "f"), RuleMapping(11, "b", "x", "f"), RuleMapping(2, "c", "x", "f"), RuleMapping(7, "d", "x", "f")]
    want = {(1, "a", 9, 6), (11, "b", 6, 3), (2, "c", 0, 0), (7, "d", 0, 0)}
    for results in (df, result_patterns(df)):
        counts = rule_counts_from_results(results, program)
        assert {tuple(r) for r in counts.collect()} == want
    plan = rule_counts_from_results(df, program)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("Exchange") == 1
    summary = run_summary(spark.createDataFrame([("RULE_1: 1 | RULE_2: 0",), ("RULE_1: NULL | RULE_2: 1",)], "DQ_RESULT string"))
    assert tuple(summary.first()) == (2, 3, 2, 66.67) and "hashpartitioning" not in summary._jdf.queryExecution().executedPlan().toString()
    assert rule_counts_from_results(df, []).count() == 0
