"""Entities derived from the supplied tables, with deterministic defects.

Column formulas are SQL texts that Spark and the SQL check both read, so the two
sides judge the same rows. Every formula covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.program import RuleMapping, pack_program
from plumbline.packs import Pack, PackRule, load_pack
from plumbline.packs.base_rules import ALL_RULES
from plumbline.sources.staging import POSITION, with_position

CUSTOMER_AS_OF = "2010-01-01"
ORDERS_AS_OF = "2000-01-01"
CUSTOMER_RUN_ID_BASE = 1_000_000
CUSTOMER_RUN_TS = "2001-09-01 06:30:00"

CUSTOMER = {
    "cust_id": "c_custkey",
    "id": "CASE WHEN c_custkey % 50 = 7 THEN c_custkey - 1 ELSE c_custkey END",
    "email": "CASE WHEN c_custkey % 40 <> 3 THEN 'u' || CAST(c_custkey % 1400 AS VARCHAR(20)) || '@x.test' END",
    "first_name": "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN '  ' ELSE c_name END",
    "last_name": "CASE WHEN c_custkey % 43 <> 0 THEN c_mktsegment END",
    "document_id": "CASE WHEN c_custkey % 16 = 5 THEN NULL WHEN c_custkey % 57 = 0 THEN '' "
                   "ELSE 'D' || CAST(c_custkey AS VARCHAR(20)) END",
    "join_date": "CASE WHEN c_custkey % 61 <> 0 THEN DATE '1990-01-01' + CAST(c_custkey % 9000 AS INT) END",
    "passport_expiry": "CASE WHEN c_custkey % 211 <> 0 THEN DATE '2001-01-01' + CAST(c_custkey % 7000 AS INT) END",
    "status": "CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END",
    "is_resident": "CASE WHEN c_custkey % 37 <> 0 THEN CAST(c_custkey % 3 AS INT) END",
    "country": "CASE c_custkey % 4 WHEN 0 THEN 'DE' WHEN 1 THEN 'de' WHEN 2 THEN 'DEU' END",
    "tot_rel_bal": "CASE WHEN c_custkey % 29 <> 0 THEN c_acctbal END",
    "revenue_tot": "c_acctbal + 500",
    "revenue_12m": "c_acctbal - 500",
    "card_balance_amount": "CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END",
    "loan_balance_amount": "CASE WHEN c_custkey % 83 = 0 THEN CAST(-1 AS DOUBLE) ELSE abs(c_acctbal) END",
    "total_deposits_amount": "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END",
    "income_monthly": "CASE WHEN c_custkey % 19 = 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END",
    "income_annual": "CASE WHEN c_custkey % 47 <> 0 THEN c_acctbal * 12 END",
}

# A third of the orders share one doc_ref (NULL); February rows are out of scope.
ORDERS = {
    "order_id": "o_orderkey",
    "doc_ref": "CASE WHEN o_orderkey % 3 <> 0 THEN 'R' || CAST(o_orderkey - "
               "CASE WHEN o_orderkey % 20 = 11 THEN 1 ELSE 0 END AS VARCHAR(20)) END",
    "order_date": "CASE WHEN o_orderkey % 41 <> 0 THEN CAST(o_orderdate AS DATE) END",
    "priority": "CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 67 = 0 THEN ' ' ELSE o_orderpriority END",
    "total": "CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 53 = 0 THEN -o_totalprice "
             "WHEN o_orderkey % 71 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END",
    "country": "CASE o_orderkey % 5 WHEN 0 THEN 'de' WHEN 1 THEN NULL WHEN 2 THEN 'D1' ELSE 'DE' END",
    "flag": "CASE WHEN o_orderkey % 43 <> 0 THEN CAST(o_orderkey % 3 AS DOUBLE) - 0.5 END",
    "item_count": "CASE WHEN o_orderkey % 47 <> 0 THEN o_orderkey % 4 END",
    "open_value": "CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END",
    "status": "CASE WHEN month(o_orderdate) = 2 THEN 0 ELSE 1 END",
    "run_month": "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP)",
    "month_no": "CAST(year(o_orderdate) * 12 + month(o_orderdate) - 23941 AS BIGINT)",
}


def _window(metric: str, since: str, extra: str = "") -> str:
    inside = f"o_orderdate >= TIMESTAMP '{since} 00:00:00'{extra}"
    if metric == "cnt":
        return f"CAST(SUM(CASE WHEN {inside} THEN 1 ELSE 0 END) AS BIGINT)"
    return f"CAST(SUM(CASE WHEN {inside} THEN CAST(o_totalprice AS DECIMAL(15, 2)) END) AS DOUBLE)"


_SINCE = {"3m": "2001-05-01", "6m": "2001-02-01", "12m": "2000-08-01"}
_FINISHED = " AND o_orderstatus = 'F'"

FUND = {
    "sent_txn_cnt_3m": _window("cnt", _SINCE["3m"]),
    "sent_txn_cnt_12m": _window("cnt", _SINCE["12m"]),
    "rcvd_txn_cnt_3m": _window("cnt", _SINCE["3m"], _FINISHED),
    "rcvd_txn_cnt_12m": _window("cnt", _SINCE["12m"], _FINISHED),
    "sent_txn_amt_3m": _window("amt", _SINCE["3m"]),
    "sent_txn_amt_6m": _window("amt", _SINCE["6m"]),
    "sent_txn_amt_12m": f"CASE WHEN o_custkey % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE {_window('amt', _SINCE['12m'])} END",
    "rcvd_txn_amt_3m": _window("amt", _SINCE["3m"], _FINISHED),
    "rcvd_txn_amt_6m": _window("amt", _SINCE["6m"], _FINISHED),
    "rcvd_txn_amt_12m": _window("amt", _SINCE["12m"], _FINISHED),
}

_AMOUNT = "CAST(value AS DECIMAL(15, 2))"

TELCO = {
    "avg_phone_bill_amt_lst12mo": f"CASE WHEN user_id % 11 <> 0 THEN CAST(SUM({_AMOUNT}) AS DOUBLE) END",
    "phone_bill_amt": f"CAST(SUM(CASE WHEN event_type = 'purchase' THEN {_AMOUNT} END) AS DOUBLE)",
    "number_payment_delays_last12mo": "CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT)",
    "pct_increase_annual_number_of_delays_last_3_year": "CAST(user_id % 7 - 1 AS DOUBLE)",
    "user_phone": "CASE WHEN user_id % 13 = 0 THEN NULL WHEN user_id % 17 = 0 THEN '  ' "
                  "ELSE '+49' || CAST(user_id AS VARCHAR(20)) END",
    "is_pre_paid": "CASE WHEN user_id % 19 <> 0 THEN user_id % 3 END",
    "_rescued_data": "MAX(props)",
}

_ORDER_RULES = (
    (401, "RULE_30_UNIQUE_IDENTIFIER", "doc_ref", "doc_ref identifies an order", 95.0, "UNIQUENESS"),
    (402, "RULE_1_DATE_NOT_NULL", "order_date", "order_date is known", 97.5, "COMPLETENESS"),
    (403, "RULE_2_STRING_NOT_NULL", "priority", "priority is known", 97.0, "COMPLETENESS"),
    (404, "RULE_3_NUMERIC_NOT_NULL", "total", "total is known", 97.0, "COMPLETENESS"),
    (405, "RULE_10_NUMERIC_NON_NEGATIVE", "total", "total is not negative", 95.5, "ACCURACY"),
    (406, "RULE_11_NUMERIC_POSITIVE", "total", "total is positive", 94.0, "ACCURACY"),
    (407, "RULE_12_DATE_NOT_FUTURE", "order_date", "order_date is not ahead", 97.0, "ACCURACY"),
    (408, "RULE_13_DATE_NOT_PAST_LIMIT", "order_date", "order_date is recent", 90.0, "ACCURACY"),
    (409, "RULE_14_DATE_NOT_FUTURE_LIMIT", "order_date", "order_date is not far ahead", 97.5, "ACCURACY"),
    (410, "RULE_20_ISO_COUNTRY_CODE", "country", "country has two letters", 40.0, "VALIDITY"),
    (411, "RULE_21_BOOLEAN_FLAG", "flag", "flag is 0 or 1", 60.0, None),
    (412, "RULE_41_POSITIVE_IF_COUNT_NONZERO", "item_count|total", "items have a value", 90.0, None),
    (413, "RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "open_value|total", "open value within total", 60.0, "CONSISTENCY"),
    (414, "RULE_99_UNKNOWN", "total", "a rule type nobody defined", 100.0, "ACCURACY"),
)

ORDERS_PACK = Pack(
    entity="orders_gold",
    request_short="REQUEST_orders_gold",
    owner_dept="Order Desk",
    owner_user="order.steward",
    rules=tuple(PackRule(*r) for r in _ORDER_RULES),
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _columns(formulas: dict[str, str]) -> list:
    return [F.expr(sql).alias(name) for name, sql in formulas.items()]


def customer_gold(spark: SparkSession, sf_dir: str, positions: bool = True) -> DataFrame:
    df = read(spark, sf_dir, "customer")
    if not positions:
        return df.select(*_columns(CUSTOMER))
    return with_position(df).select(*_columns(CUSTOMER), *POSITION)


def orders_gold(spark: SparkSession, sf_dir: str, positions: bool = True) -> DataFrame:
    df = read(spark, sf_dir, "orders")
    if not positions:
        return df.select(*_columns(ORDERS))
    return with_position(df).select(*_columns(ORDERS), *POSITION)


def fund_trans_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(*_columns(FUND))
    return grouped.withColumnRenamed("o_custkey", "cust_id")


def telco_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = read(spark, sf_dir, "events").groupBy("user_id").agg(*_columns(TELCO))
    return grouped.withColumnRenamed("user_id", "cust_id")


def program_of(entity: str) -> list[RuleMapping]:
    return pack_program(ORDERS_PACK if entity == "orders_gold" else load_pack(entity))


def log_program(entity: str) -> list[RuleMapping]:
    """What an entity's audit log is counted from in the report queries and their SQL twins: all its rules."""
    return program_of(entity)


# SQL twins ---------------------------------------------------------------


def _select(formulas: dict[str, str], source: str, key: str = "", group: str = "") -> str:
    columns = [f"{sql} AS {name}" for name, sql in formulas.items()]
    if key:
        columns.insert(0, f"{group} AS {key}")
    tail = f" GROUP BY {group}" if group else ""
    return f"SELECT {', '.join(columns)} FROM {source}{tail}"


ENTITY_SQL = {
    "customer_gold": _select(CUSTOMER, "customer"),
    "orders_gold": _select(ORDERS, "orders"),
    "fund_trans_gold": _select(FUND, "orders", "cust_id", "o_custkey"),
    "telco_gold": _select(TELCO, "events", "cust_id", "user_id"),
}


def registry_packs() -> list[Pack]:
    return [load_pack("customer_gold"), ORDERS_PACK]


def generic_rules() -> list[tuple]:
    return list(ALL_RULES)
