"""Checking mappings against the catalogue and the entity's columns before a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DatetimeType,
    NumericType,
    StringType,
    StructType,
)

from plumbline.functions.rules import ROW_RULES, UNIQUE_RULE
from plumbline.operators.program import RuleMapping

# The catalogue's names of column types.
TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "LONG",
    "double": "DOUBLE",
    "float": "FLOAT",
    "decimal": "DECIMAL",
    "string": "STRING",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}

# What a rule can judge without ending the job, wider than what the catalogue recommends: texts are cast where a
# malformed one can fail the row instead.
JUDGED_KINDS = {
    "RULE_2_STRING_NOT_NULL": (StringType, NumericType, DatetimeType, BooleanType),
    "RULE_10_NUMERIC_NON_NEGATIVE": (NumericType,),
    "RULE_11_NUMERIC_POSITIVE": (NumericType,),
    "RULE_12_DATE_NOT_FUTURE": (DatetimeType, StringType),
    "RULE_13_DATE_NOT_PAST_LIMIT": (DatetimeType, StringType),
    "RULE_14_DATE_NOT_FUTURE_LIMIT": (DatetimeType, StringType),
    "RULE_20_ISO_COUNTRY_CODE": (StringType,),
    "RULE_21_BOOLEAN_FLAG": (NumericType, BooleanType, StringType),
    "RULE_40_TEMPORAL_WINDOW_CONSISTENCY": (NumericType,),
    "RULE_41_POSITIVE_IF_COUNT_NONZERO": (NumericType,),
}

NO_CATALOGUE_ROW = "NO_CATALOGUE_ROW"
UNKNOWN_RULE = "UNKNOWN_RULE"
WRONG_ARITY = "WRONG_ARITY"
MISSING_COLUMN = "MISSING_COLUMN"
TYPE_NOT_APPLICABLE = "TYPE_NOT_APPLICABLE"


def type_name(simple: str) -> str:
    base = simple.split("(")[0]
    return TYPE_NAMES.get(base, base.upper())


def entity_columns(spark: SparkSession, entities: dict[str, StructType]) -> DataFrame:
    """Column inventory of the entity tables: one row per table and column."""
    rows = [
        (table, f.name, type_name(f.dataType.simpleString()))
        for table, schema in entities.items()
        for f in schema.fields
    ]
    return spark.createDataFrame(rows, "source_table string, field string, column_type string")


def _arities(spark: SparkSession) -> DataFrame:
    rows = [(name, rule.arity) for name, rule in ROW_RULES.items()] + [(UNIQUE_RULE, 1)]
    return spark.createDataFrame(rows, "generic_rule_desc_short string, arity int")


def validate_mappings(mappings: DataFrame, generic: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per problem of a mapping: (rule_mapping_id, dq_rule_no, field, problem).

    The catalogue and the column inventory are small and join by size; the
    mappings may be as many as they like.
    """
    spark = mappings.sparkSession
    known = generic.select("generic_rule_desc_short", "applicable_types", F.lit(True).alias("in_catalogue"))
    fields = F.split("source_field", r"\|")
    base = (
        mappings.select("rule_mapping_id", "dq_rule_no", "generic_rule_desc_short", "source_table", "source_field")
        .join(known, "generic_rule_desc_short", "left")
        .join(_arities(spark), "generic_rule_desc_short", "left")
    )
    of_mapping = base.select(
        "rule_mapping_id",
        "dq_rule_no",
        F.col("source_field").alias("field"),
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("in_catalogue").isNull(), F.lit(NO_CATALOGUE_ROW)),
                    F.when(F.col("arity").isNull(), F.lit(UNKNOWN_RULE)),
                    F.when(F.size(fields) != F.col("arity"), F.lit(WRONG_ARITY)),
                )
            )
        ).alias("problem"),
    )
    of_field = (
        base.select("*", F.explode(fields).alias("field"))
        .join(columns, ["source_table", "field"], "left")
        .select(
            "rule_mapping_id",
            "dq_rule_no",
            "field",
            F.when(F.col("column_type").isNull(), F.lit(MISSING_COLUMN))
            .when(
                ~F.array_contains(F.split("applicable_types", ","), F.col("column_type")),
                F.lit(TYPE_NOT_APPLICABLE),
            )
            .alias("problem"),
        )
        .where("problem IS NOT NULL")
    )
    return of_mapping.unionByName(of_field)


def check_program(program: Sequence[RuleMapping], schema: StructType) -> None:
    """Refuse a program that cannot run on the entity.

    That is a wrong number of fields, a missing column, or a column of a type the
    rule cannot judge, which would end the job in analysis or at a malformed value.
    """
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    problems = []
    for m in program:
        if not (m.is_row_rule or m.is_unique_rule or m.template):
            continue
        arity = 1 if m.is_unique_rule else ROW_RULES[m.rule].arity if m.is_row_rule else len(m.fields)
        if len(m.fields) != arity:
            problems.append(f"{m.dq_rule_no}: {m.rule} reads {arity} field(s), got {m.source_field!r}")
        problems += [f"{m.dq_rule_no}: no column {f!r}" for f in m.fields if f.lower() not in kinds]
        for f in m.fields:
            kind, judged = kinds.get(f.lower()), JUDGED_KINDS.get(m.rule)
            if kind is not None and judged and not isinstance(kind, judged):
                name = "text" if isinstance(kind, StringType) else kind.simpleString()
                problems.append(f"{m.dq_rule_no}: {m.rule} cannot judge the {name} column {f!r}")
    if problems:
        raise ValueError("mappings do not fit the entity: " + "; ".join(problems))
