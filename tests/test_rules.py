"""Truth tables of the rule types, the mask and the encoding."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.functions import encoding
from plumbline.functions.rules import ROW_RULES, out_of_scope, row_rule, verdict
from plumbline.operators.program import RuleMapping, rule_number
from plumbline.operators.templates import fill_template, template_passes
from plumbline.operators.verdicts import apply_rules, enrich
from plumbline.packs.base_rules import ALL_RULES
from plumbline.schemas import RESULT_COLUMN

AS_OF = dt.date(2020, 6, 15)
NAN = float("nan")


def day(n):
    return AS_OF + dt.timedelta(days=n)


CASES = [
    ("RULE_1_DATE_NOT_NULL", "date", [(day(0), 1), (None, 0)]),
    ("RULE_2_STRING_NOT_NULL", "string", [("a", 1), (" a ", 1), ("\t", 1), (None, 0), ("", 0), ("  ", 0)]),
    ("RULE_3_NUMERIC_NOT_NULL", "double", [(0.0, 1), (NAN, 1), (None, 0)]),
    ("RULE_10_NUMERIC_NON_NEGATIVE", "double", [(0.0, 1), (-0.0, 1), (5.0, 1), (NAN, 1), (None, 0), (-0.01, 0)]),
    ("RULE_11_NUMERIC_POSITIVE", "double", [(0.01, 1), (NAN, 1), (None, 0), (0.0, 0), (-1.0, 0)]),
    ("RULE_12_DATE_NOT_FUTURE", "date", [(day(0), 1), (day(-1), 1), (day(1), 0), (None, 0)]),
    ("RULE_12_DATE_NOT_FUTURE", "timestamp_ntz", [(dt.datetime(2020, 6, 15, 23, 59), 1), (dt.datetime(2020, 6, 16), 0)]),
    ("RULE_12_DATE_NOT_FUTURE", "string", [("2020-06-15", 1), ("2020-06-16", 0), ("soon", 0)]),
    ("RULE_13_DATE_NOT_PAST_LIMIT", "date", [(day(-3650), 1), (day(-3651), 0), (None, 0)]),
    ("RULE_14_DATE_NOT_FUTURE_LIMIT", "date", [(day(3650), 1), (day(3651), 0), (None, 0)]),
    ("RULE_20_ISO_COUNTRY_CODE", "string",
     [("DE", 1), ("ZZ", 1), (None, 0), ("de", 0), ("DEU", 0), ("D1", 0), ("", 0), ("DE\n", 1)]),
    ("RULE_21_BOOLEAN_FLAG", "double", [(0.0, 1), (1.0, 1), (0.7, 1), (-0.5, 1), (None, 0), (2.0, 0), (-1.0, 0)]),
    ("RULE_21_BOOLEAN_FLAG", "boolean", [(True, 1), (False, 1), (None, 0)]),
    ("RULE_21_BOOLEAN_FLAG", "string", [("1", 1), ("0", 1), ("2", 0), ("yes", 0)]),
]


@pytest.mark.parametrize("rule,kind,rows", CASES, ids=[f"{c[0]}-{c[1]}" for c in CASES])
def test_one_column_rules(spark, rule, kind, rows):
    df = spark.createDataFrame([(i, v, w) for i, (v, w) in enumerate(rows)], f"i int, v {kind}, want int")
    got = df.select("i", "want", verdict(row_rule(rule, ["v"], AS_OF)).alias("got")).orderBy("i").collect()
    assert [(r.i, r.got) for r in got] == [(r.i, r.want) for r in got]


@pytest.mark.parametrize(
    "rule,rows",
    [
        ("RULE_40_TEMPORAL_WINDOW_CONSISTENCY",
         [(1.0, 2.0, 1), (2.0, 2.0, 1), (3.0, 2.0, 0), (None, 2.0, 0), (1.0, None, 0), (None, None, 0)]),
        ("RULE_41_POSITIVE_IF_COUNT_NONZERO",
         [(0.0, 0.0, 1), (0.0, -1.0, 1), (3.0, 0.5, 1), (3.0, 0.0, 0), (3.0, -1.0, 0), (0.0, None, 0), (None, 5.0, 0)]),
    ],
)
def test_two_column_rules(spark, rule, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a double, b double, want int")
    got = df.select("i", "want", verdict(row_rule(rule, ["a", "b"], AS_OF)).alias("got")).orderBy("i").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_arity_is_checked():
    with pytest.raises(ValueError):
        row_rule("RULE_40_TEMPORAL_WINDOW_CONSISTENCY", ["a"])


@pytest.mark.parametrize("kind,rows", [
    ("int", [(1, False), (0, True), (2, True), (None, False)]),
    ("string", [("1", False), ("0", True), ("gone", False), (None, False)]),
])
def test_mask(spark, kind, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, status {kind}, want boolean")
    got = df.select("i", "want", out_of_scope().alias("got")).orderBy("i").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_no_status_column_means_no_mask(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    step = RuleMapping(7, "DQ_7", "RULE_3_NUMERIC_NOT_NULL", "v")
    got = [r[0] for r in enrich(df, [step]).select(RESULT_COLUMN).collect()]
    assert sorted(got) == ["RULE_7: 0", "RULE_7: 1"]


PROGRAM = [
    RuleMapping(1, "DQ_1", "RULE_3_NUMERIC_NOT_NULL", "v"),
    RuleMapping(10, "DQ_10", "RULE_11_NUMERIC_POSITIVE", "v"),
    RuleMapping(101, "DQ_101", "RULE_NOBODY_KNOWS", "v"),
]


@pytest.mark.parametrize("marker", ["NULL", "N"])
def test_encode_and_decode(spark, marker):
    df = spark.createDataFrame([(1, 5, 1), (2, -5, 1), (3, None, None), (4, 5, 0)], "id int, v int, status int")
    result = F.col(RESULT_COLUMN)
    decoded = encoding.decode(result)
    rows = enrich(df, PROGRAM, marker=marker).select(
        "*", *[decoded[f"RULE_{m.rule_mapping_id}"].alias(f"d{m.rule_mapping_id}") for m in PROGRAM],
        encoding.checks_in_row(result).alias("checks"), encoding.passes_in_row(result).alias("passes"),
        encoding.rule_evaluated(result, 1).alias("e1"), encoding.rule_passed(result, 1).alias("p1"),
    ).orderBy("id").collect()
    assert [r[RESULT_COLUMN] for r in rows] == [
        f"RULE_1: 1 | RULE_10: 1 | RULE_101: {marker}",
        f"RULE_1: 1 | RULE_10: 0 | RULE_101: {marker}",
        f"RULE_1: 0 | RULE_10: 0 | RULE_101: {marker}",
        f"RULE_1: {marker} | RULE_10: {marker} | RULE_101: {marker}",
    ]
    assert [(r.d1, r.d10, r.d101) for r in rows] == [(1, 1, None), (1, 0, None), (0, 0, None), (None,) * 3]
    assert [(r.checks, r.passes) for r in rows] == [(2, 2), (2, 1), (2, 0), (0, 0)]
    assert [(r.e1, r.p1) for r in rows] == [(True, True), (True, True), (True, False), (False, False)]

    typed = apply_rules(df, PROGRAM)
    again = typed.select("id", encoding.encode_verdicts(
        [(m.rule_mapping_id, F.col(f"_DQ_{m.rule_mapping_id}")) for m in PROGRAM], marker).alias("s"))
    assert [r.s for r in again.orderBy("id").collect()] == [r[RESULT_COLUMN] for r in rows]


def test_no_mappings_give_an_empty_result(spark):
    df = spark.createDataFrame([(1,)], "v int")
    result = F.col(RESULT_COLUMN)
    row = enrich(df, []).select(result, encoding.checks_in_row(result), encoding.passes_in_row(result)).first()
    assert tuple(row) == ("", 0, 0)


def test_columns_with_dots_and_blanks(spark):
    df = spark.createDataFrame([(1, "x")], "`a.b` int, `c d` string")
    program = [RuleMapping(1, "a", "RULE_10_NUMERIC_NON_NEGATIVE", "a.b"),
               RuleMapping(2, "b", "RULE_2_STRING_NOT_NULL", "c d"),
               RuleMapping(3, "c", "RULE_30_UNIQUE_IDENTIFIER", "a.b")]
    assert enrich(df, program).first()[RESULT_COLUMN] == "RULE_1: 1 | RULE_2: 1 | RULE_3: 1"


def test_rule_numbers():
    assert rule_number(212, "RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "a|b") == "DQ_212_TEMPORAL_WINDOW_CONSISTENCY_a_vs_b"
    assert rule_number(101, "RULE_30_UNIQUE_IDENTIFIER", "id") == "DQ_101_UNIQUE_IDENTIFIER_id"


TEMPLATES = {r[0]: r[4] for r in ALL_RULES}


def test_templates_agree_with_the_rules_where_they_should(spark):
    df = spark.createDataFrame(
        [(AS_OF, "DE", 1.0, 0, 1), (day(4000), "de", -1.0, 3, 2), (day(-4000), " ", 0.0, 1, 0), (None,) * 5],
        "d date, s string, n double, flag int, other int",
    )
    field = {"DATE": "d", "STRING": "s", "NUMERIC": "n"}
    for rule in ROW_RULES:
        if rule in ("RULE_41_POSITIVE_IF_COUNT_NONZERO",):
            continue
        fields = (["flag", "other"] if ROW_RULES[rule].arity == 2 else
                  ["flag"] if "FLAG" in rule else
                  ["s"] if "ISO" in rule else [next(c for k, c in field.items() if k in rule)])
        sql = fill_template(TEMPLATES[rule], fields, AS_OF)
        rows = df.select(
            verdict(row_rule(rule, fields, AS_OF)).alias("a"), verdict(template_passes(sql)).alias("b")
        ).collect()
        assert [r.a for r in rows] == [r.b for r in rows], rule


def test_template_of_rule_41_is_laxer(spark):
    df = spark.createDataFrame([(0, None), (None, 5.0), (3, 1.0)], "c int, a double")
    sql = fill_template(TEMPLATES["RULE_41_POSITIVE_IF_COUNT_NONZERO"], ["c", "a"])
    rows = df.select(
        verdict(row_rule("RULE_41_POSITIVE_IF_COUNT_NONZERO", ["c", "a"])).alias("rule"),
        verdict(template_passes(sql)).alias("template"),
    ).collect()
    assert [tuple(r) for r in rows] == [(0, 1), (0, 1), (1, 1)]


@pytest.mark.parametrize("marker", ["NULL", "N"])
def test_one_verdict_is_searched_for(spark, marker):
    texts = [f"RULE_1: 1 | RULE_10: 0 | RULE_101: {marker}", f"RULE_1: {marker} | RULE_10: 1 | RULE_101: 0", "RULE_10: 1", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "r string")
    for rule in (1, 10, 101, 7):
        rows = df.select(encoding.verdict_of(F.col("r"), rule).alias("v"), encoding.decode(F.col("r"))[f"RULE_{rule}"].alias("d")).collect()
        assert [r.v for r in rows] == [r.d for r in rows]
    assert df.select(encoding.verdict_of(F.col("r"), 10)).schema[0].dataType.simpleString() == "int"


def test_e03_builds_no_map_per_row(spark):
    from plumbline.workload.queries import REGISTER

    plan = REGISTER["e03_decode_per_row"].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "map_from_entries" not in plan and "lambdafunction" not in plan
