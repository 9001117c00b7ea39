"""The rule catalogue every store starts with.

Column order: short name, description, category, detail, SQL template,
applicable types, BCBS 239 principle, Solvency II pillar.
"""

# Names, categories, templates, types and regulation tags.
BASE_RULES: tuple[tuple, ...] = (
    ("RULE_1_DATE_NOT_NULL", "Date Not Null", "COMPLETENESS",
     "The date or timestamp is filled in.",
     "CASE WHEN {field} IS NOT NULL THEN 1 ELSE 0 END",
     "DATE,TIMESTAMP", "P3,P4", "Pillar1,QRT"),
    ("RULE_2_STRING_NOT_NULL", "String Not Null", "COMPLETENESS",
     "The text is filled in with something other than spaces.",
     "CASE WHEN {field} IS NOT NULL AND trim({field}) != '' THEN 1 ELSE 0 END",
     "STRING", "P3,P4", "Pillar1,QRT"),
    ("RULE_3_NUMERIC_NOT_NULL", "Numeric Not Null", "COMPLETENESS",
     "The number is filled in.",
     "CASE WHEN {field} IS NOT NULL THEN 1 ELSE 0 END",
     "INTEGER,LONG,DOUBLE,DECIMAL,FLOAT", "P3,P4", "Pillar1"),
    ("RULE_10_NUMERIC_NON_NEGATIVE", "Numeric Non-Negative", "ACCURACY",
     "The number is zero or greater.",
     "CASE WHEN {field} >= 0 THEN 1 ELSE 0 END",
     "INTEGER,LONG,DOUBLE,DECIMAL,FLOAT", "P3", "Pillar1"),
    ("RULE_11_NUMERIC_POSITIVE", "Numeric Positive", "ACCURACY",
     "The number is greater than zero.",
     "CASE WHEN {field} > 0 THEN 1 ELSE 0 END",
     "INTEGER,LONG,DOUBLE,DECIMAL,FLOAT", "P3", "Pillar1"),
    ("RULE_12_DATE_NOT_FUTURE", "Date Not in Future", "ACCURACY",
     "The date is no later than the day of the run.",
     "CASE WHEN {field} <= current_date() THEN 1 ELSE 0 END",
     "DATE,TIMESTAMP", "P3", "QRT"),
    ("RULE_13_DATE_NOT_PAST_LIMIT", "Date Within Reasonable Past", "ACCURACY",
     "The date is at most 3650 days before the day of the run.",
     "CASE WHEN {field} >= date_sub(current_date(), 3650) THEN 1 ELSE 0 END",
     "DATE,TIMESTAMP", "P3,P5", "Pillar1"),
    ("RULE_14_DATE_NOT_FUTURE_LIMIT", "Date Within Future Limit", "ACCURACY",
     "The date is at most 3650 days after the day of the run.",
     "CASE WHEN {field} <= date_add(current_date(), 3650) THEN 1 ELSE 0 END",
     "DATE,TIMESTAMP", "P3", "QRT"),
    ("RULE_20_ISO_COUNTRY_CODE", "ISO 3166-1 Alpha-2 Country Code", "VALIDITY",
     "The text has the form of a two-letter country code.",
     "CASE WHEN {field} RLIKE '^[A-Z]{2}$' THEN 1 ELSE 0 END",
     "STRING", "P3", "QRT"),
    ("RULE_21_BOOLEAN_FLAG", "Boolean Flag (0 or 1)", "VALIDITY",
     "The flag is 0 or 1.",
     "CASE WHEN {field} IN (0, 1) THEN 1 ELSE 0 END",
     "INTEGER", "P3", "Pillar2"),
    ("RULE_30_UNIQUE_IDENTIFIER", "Unique Identifier", "UNIQUENESS",
     "The first row of each value passes, every later one fails.",
     "ROW_NUMBER() OVER (PARTITION BY {field} ORDER BY {field}) = 1",
     "STRING,INTEGER,LONG", "P3", "Pillar1"),
)

# The two rule types that arrive with the fund_trans_gold pack.
TWO_COLUMN_RULES: tuple[tuple, ...] = (
    ("RULE_40_TEMPORAL_WINDOW_CONSISTENCY", "Temporal Window Consistency", "CONSISTENCY",
     "A metric over the short window is no greater than over the long one; fields 'short|long'.",
     "CASE WHEN {field_3m} <= {field_12m} THEN 1 ELSE 0 END",
     "LONG,DOUBLE", "P3", "Pillar3"),
    ("RULE_41_POSITIVE_IF_COUNT_NONZERO", "Positive Amount if Count Non-Zero", "ACCURACY",
     "An amount is positive wherever its count is not zero; fields 'count|amount'.",
     "CASE WHEN {count_field} = 0 OR {amount_field} > 0 THEN 1 ELSE 0 END",
     "LONG,DOUBLE", "P2", "Pillar1"),
)

ALL_RULES = BASE_RULES + TWO_COLUMN_RULES
