"""Explicit schemas of the registry tables and the audit log."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

RULES_GENERIC = "dq_rules_generic"
VALIDATION_REQUEST = "dq_validation_request"
RULE_MAPPINGS = "dq_rule_mappings"
RESULTS = "dq_results"

RESULT_COLUMN = "DQ_RESULT"

#: The log's partitions: the day of a run, in UTC. Readers see the log without it.
RUN_DATE = "dq_run_date"


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind(), nullable) for name, kind, nullable in fields])


_STAMP = (
    ("active", IntegerType, True),
    ("created_date", DateType, True),
    ("created_by", StringType, True),
)

RULES_GENERIC_SCHEMA = _struct(
    ("generic_rule_id", LongType, True),
    ("generic_rule_desc_short", StringType, False),
    ("rule_description", StringType, True),
    ("dq_category", StringType, True),
    ("rule_detail", StringType, True),
    ("rule_logic_template", StringType, True),
    ("applicable_types", StringType, True),
    ("bcbs239_principle", StringType, True),
    ("solvencyii_pillar", StringType, True),
    *_STAMP,
)

VALIDATION_REQUEST_SCHEMA = _struct(
    ("dq_val_request_id", LongType, True),
    ("dq_validation_request_short", StringType, False),
    ("owner_dept", StringType, True),
    ("owner_user", StringType, True),
    *_STAMP,
)

RULE_MAPPINGS_SCHEMA = _struct(
    ("rule_mapping_id", LongType, True),
    ("dq_rule_no", StringType, False),
    ("dq_val_request_id", LongType, True),
    ("generic_rule_desc_short", StringType, False),
    ("source_catalog", StringType, True),
    ("source_schema", StringType, True),
    ("source_table", StringType, True),
    ("source_field", StringType, True),
    ("rule_description", StringType, True),
    ("threshold_pct", DoubleType, True),
    ("dq_category", StringType, True),
    ("owner_dept", StringType, True),
    ("owner_user", StringType, True),
    *_STAMP,
)

RESULTS_SCHEMA = _struct(
    ("dq_run_id", LongType, True),
    ("dq_execution_timestamp", TimestampType, False),
    ("dq_rule_no", StringType, False),
    ("dq_number_relevant_records", LongType, False),
    ("dq_number_pos_results", LongType, False),
)

REGISTRY_SCHEMAS = {
    RULES_GENERIC: RULES_GENERIC_SCHEMA,
    VALIDATION_REQUEST: VALIDATION_REQUEST_SCHEMA,
    RULE_MAPPINGS: RULE_MAPPINGS_SCHEMA,
    RESULTS: RESULTS_SCHEMA,
}
