"""Rule pack of the telco table; its snapshot leaves the ingestion artefact out."""

from plumbline.packs import Pack, PackRule

# Ids, rule types, fields, descriptions, thresholds, categories.
_RULES = (
    (301, "RULE_30_UNIQUE_IDENTIFIER", "cust_id", "cust_id is the primary key - must be unique across all telco_gold records", 100.0, "UNIQUENESS"),
    (302, "RULE_3_NUMERIC_NOT_NULL", "avg_phone_bill_amt_lst12mo", "avg_phone_bill_amt_lst12mo must not be NULL - core billing metric", 100.0, "COMPLETENESS"),
    (303, "RULE_3_NUMERIC_NOT_NULL", "phone_bill_amt", "phone_bill_amt must not be NULL - current billing amount", 100.0, "COMPLETENESS"),
    (304, "RULE_3_NUMERIC_NOT_NULL", "number_payment_delays_last12mo", "number_payment_delays_last12mo must not be NULL - payment behaviour metric", 100.0, "COMPLETENESS"),
    (305, "RULE_2_STRING_NOT_NULL", "user_phone", "user_phone must not be NULL or blank - required contact identifier", 100.0, "COMPLETENESS"),
    (306, "RULE_10_NUMERIC_NON_NEGATIVE", "avg_phone_bill_amt_lst12mo", "avg_phone_bill_amt_lst12mo must be >= 0 - billing average cannot be negative", 100.0, "ACCURACY"),
    (307, "RULE_11_NUMERIC_POSITIVE", "phone_bill_amt", "phone_bill_amt must be > 0 - active subscribers always have a positive bill", 100.0, "ACCURACY"),
    (308, "RULE_10_NUMERIC_NON_NEGATIVE", "number_payment_delays_last12mo", "number_payment_delays_last12mo must be >= 0 - delay count cannot be negative", 100.0, "ACCURACY"),
    (309, "RULE_10_NUMERIC_NON_NEGATIVE", "pct_increase_annual_number_of_delays_last_3_year", "pct_increase_annual_number_of_delays_last_3_year must be >= 0 - percentage increase cannot be negative", 100.0, "ACCURACY"),
    (310, "RULE_21_BOOLEAN_FLAG", "is_pre_paid", "is_pre_paid must be 0 or 1 - boolean prepaid indicator", 100.0, "VALIDITY"),
)

PACK = Pack(
    entity="telco_gold",
    request_short="DQ_VAL_REQUEST_3_telco_gold",
    owner_dept="Dept. Telco Risk",
    owner_user="Mrs. Elena Fischer",
    rules=tuple(PackRule(*r) for r in _RULES),
    exclude_columns=("_rescued_data",),
    order_by=("cust_id",),
)
