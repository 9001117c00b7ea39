"""A governance registry derived from the part and supplier tables, of any size."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators.validation import entity_columns
from plumbline.packs.base_rules import ALL_RULES
from plumbline.sources.registry import generic_rule_rows, rule_number_column, stamped
from plumbline.workload import entities as e

CREATED = dt.date(2024, 1, 1)
_RULE_NAMES = [r[0] for r in ALL_RULES] + ["RULE_99_UNKNOWN"]
_FIELDS = ["id", "total", "order_date", "sent_txn_cnt_3m|sent_txn_cnt_12m", "no_such_field"]
_TABLES = ["customer_gold", "orders_gold", "fund_trans_gold"]


def _choose(expr: str, options: list[str]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(options)) + " END"


MAPPINGS = {
    "rule_mapping_id": "p_partkey + 1000",
    "dq_validation_request_short": "'REQUEST_' || p_brand",
    "generic_rule_desc_short": _choose(f"p_partkey % {len(_RULE_NAMES)}", _RULE_NAMES),
    "source_catalog": "CASE WHEN p_size % 11 = 0 THEN 'archive' ELSE 'spark_catalog' END",
    "source_schema": "CASE WHEN p_size % 7 = 0 THEN 'draft' ELSE 'dq' END",
    "source_table": _choose(f"p_partkey % {len(_TABLES)}", _TABLES),
    "source_field": _choose(f"p_partkey % {len(_FIELDS)}", _FIELDS),
    "rule_description": "p_name",
    "threshold_pct": "CAST(90 + p_size % 10 AS DOUBLE)",
    "dq_category": "CASE WHEN p_size % 4 <> 0 THEN 'ACCURACY' END",
    "owner_dept": "p_brand",
    "owner_user": "p_type",
    "active": "CASE WHEN p_size % 9 = 0 THEN 0 ELSE 1 END",
    "p_size": "p_size",
}

RULES = {
    "generic_rule_desc_short": "'RULE_' || CAST(100 + p_partkey AS VARCHAR(20)) || '_PART_CHECK'",
    "rule_description": "p_name",
    "dq_category": _choose("p_partkey % 3", ["ACCURACY", "VALIDITY", "COMPLETENESS"]),
    "ordinal": "p_partkey",
    "p_size": "p_size",
}

REQUESTS = {
    "dq_validation_request_short": "'REQUEST_' || s_name",
    "owner_dept": "'Nation desk ' || CAST(s_nationkey AS VARCHAR(20))",
    "owner_user": "s_name",
    "ordinal": "s_suppkey",
    "s_acctbal": "s_acctbal",
}

REGISTERED_MAPPINGS = "p_size < 25"
REGISTERED_REQUESTS = "s_acctbal < 4000"


def derived(spark: SparkSession, sf_dir: str, table: str, formulas: dict[str, str]) -> DataFrame:
    return e.read(spark, sf_dir, table).select(*[F.expr(sql).alias(n) for n, sql in formulas.items()])


def mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "part", MAPPINGS)
    number = rule_number_column(
        F.col("rule_mapping_id"), F.col("generic_rule_desc_short"), F.col("source_field")
    )
    return df.withColumn("dq_rule_no", number)


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped(derived(spark, sf_dir, "part", RULES), CREATED)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped(derived(spark, sf_dir, "supplier", REQUESTS), CREATED)


def entity_schemas(spark: SparkSession, sf_dir: str) -> dict[str, StructType]:
    return {
        "customer_gold": e.customer_gold(spark, sf_dir, positions=False).schema,
        "orders_gold": e.orders_gold(spark, sf_dir, positions=False).schema,
        "fund_trans_gold": e.fund_trans_gold(spark, sf_dir).schema,
    }


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_columns(spark, entity_schemas(spark, sf_dir))


def catalogue(spark: SparkSession) -> DataFrame:
    return generic_rule_rows(spark, ALL_RULES, CREATED)


# SQL twins: column types of the tested fields, stated rather than looked up.
COLUMN_TYPES = {
    ("customer_gold", "id"): "LONG",
    ("orders_gold", "total"): "DOUBLE",
    ("orders_gold", "order_date"): "DATE",
    ("fund_trans_gold", "sent_txn_cnt_3m"): "LONG",
    ("fund_trans_gold", "sent_txn_cnt_12m"): "LONG",
}


def sql(table: str, formulas: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{s} AS {n}' for n, s in formulas.items())} FROM {table}"


MAPPINGS_SQL = (
    "SELECT *, 'DQ_' || CAST(rule_mapping_id AS VARCHAR) || '_' || "
    "array_to_string(string_split(generic_rule_desc_short, '_')[3:], '_') || '_' || "
    f"replace(source_field, '|', '_vs_') AS dq_rule_no FROM ({sql('part', MAPPINGS)}) AS p"
)
