"""Rule pack of the fund transaction table; it brings the two-column rule types."""

from plumbline.packs import Pack, PackRule
from plumbline.packs.base_rules import TWO_COLUMN_RULES

# Ids, rule types, fields, descriptions, thresholds, categories.
_RULES = (
    (201, "RULE_30_UNIQUE_IDENTIFIER", "cust_id", "cust_id is the primary key - must be unique across all fund_trans_gold records", 100.0, "UNIQUENESS"),
    (202, "RULE_3_NUMERIC_NOT_NULL", "sent_txn_cnt_12m", "sent_txn_cnt_12m must not be NULL - core sent volume metric (12m)", 100.0, "COMPLETENESS"),
    (203, "RULE_3_NUMERIC_NOT_NULL", "sent_txn_amt_12m", "sent_txn_amt_12m must not be NULL - core sent amount metric (12m)", 100.0, "COMPLETENESS"),
    (204, "RULE_3_NUMERIC_NOT_NULL", "rcvd_txn_cnt_12m", "rcvd_txn_cnt_12m must not be NULL - core received volume metric (12m)", 100.0, "COMPLETENESS"),
    (205, "RULE_3_NUMERIC_NOT_NULL", "rcvd_txn_amt_12m", "rcvd_txn_amt_12m must not be NULL - core received amount metric (12m)", 100.0, "COMPLETENESS"),
    (206, "RULE_10_NUMERIC_NON_NEGATIVE", "sent_txn_amt_12m", "sent_txn_amt_12m must be >= 0 - transaction amount cannot be negative", 100.0, "ACCURACY"),
    (207, "RULE_10_NUMERIC_NON_NEGATIVE", "rcvd_txn_amt_12m", "rcvd_txn_amt_12m must be >= 0 - transaction amount cannot be negative", 100.0, "ACCURACY"),
    (208, "RULE_10_NUMERIC_NON_NEGATIVE", "sent_txn_amt_6m", "sent_txn_amt_6m must be >= 0 - transaction amount cannot be negative", 100.0, "ACCURACY"),
    (209, "RULE_10_NUMERIC_NON_NEGATIVE", "rcvd_txn_amt_6m", "rcvd_txn_amt_6m must be >= 0 - transaction amount cannot be negative", 100.0, "ACCURACY"),
    (210, "RULE_10_NUMERIC_NON_NEGATIVE", "sent_txn_amt_3m", "sent_txn_amt_3m must be >= 0 - transaction amount cannot be negative", 100.0, "ACCURACY"),
    (211, "RULE_10_NUMERIC_NON_NEGATIVE", "rcvd_txn_amt_3m", "rcvd_txn_amt_3m must be >= 0 - transaction amount cannot be negative", 100.0, "ACCURACY"),
    (212, "RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "sent_txn_cnt_3m|sent_txn_cnt_12m", "sent_txn_cnt_3m must be <= sent_txn_cnt_12m - 3m window cannot exceed 12m window", 100.0, "CONSISTENCY"),
    (213, "RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "rcvd_txn_cnt_3m|rcvd_txn_cnt_12m", "rcvd_txn_cnt_3m must be <= rcvd_txn_cnt_12m - 3m window cannot exceed 12m window", 100.0, "CONSISTENCY"),
    (214, "RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "sent_txn_amt_3m|sent_txn_amt_12m", "sent_txn_amt_3m must be <= sent_txn_amt_12m - 3m window cannot exceed 12m window", 100.0, "CONSISTENCY"),
    (215, "RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "rcvd_txn_amt_3m|rcvd_txn_amt_12m", "rcvd_txn_amt_3m must be <= rcvd_txn_amt_12m - 3m window cannot exceed 12m window", 100.0, "CONSISTENCY"),
    (216, "RULE_41_POSITIVE_IF_COUNT_NONZERO", "sent_txn_cnt_12m|sent_txn_amt_12m", "sent_txn_amt_12m must be > 0 when sent_txn_cnt_12m > 0 - zero amount with non-zero count is a data integrity failure", 100.0, "ACCURACY"),
    (217, "RULE_41_POSITIVE_IF_COUNT_NONZERO", "rcvd_txn_cnt_12m|rcvd_txn_amt_12m", "rcvd_txn_amt_12m must be > 0 when rcvd_txn_cnt_12m > 0 - zero amount with non-zero count is a data integrity failure", 100.0, "ACCURACY"),
    (218, "RULE_41_POSITIVE_IF_COUNT_NONZERO", "sent_txn_cnt_3m|sent_txn_amt_3m", "sent_txn_amt_3m must be > 0 when sent_txn_cnt_3m > 0 - shortest window is most sensitive to integrity failures", 100.0, "ACCURACY"),
)

PACK = Pack(
    entity="fund_trans_gold",
    request_short="DQ_VAL_REQUEST_2_fund_trans_gold",
    owner_dept="Dept. Transaction Data",
    owner_user="Mr. Alex Smith",
    rules=tuple(PackRule(*r) for r in _RULES),
    new_generic_rules=TWO_COLUMN_RULES,
    order_by=("cust_id",),
)
