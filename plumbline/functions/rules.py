"""Row-level rule types as boolean Column builders.

A builder says when a row passes. It may give NULL on NULL input: a verdict is
``when(passes, 1).otherwise(0)``, so NULL counts as a failure. Every builder
is a built-in expression, evaluated inside whole-stage codegen.

Uniqueness (``RULE_30_UNIQUE_IDENTIFIER``) depends on the other rows of the
table and lives in ``operators.uniqueness``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIQUE_RULE = "RULE_30_UNIQUE_IDENTIFIER"

# The reach of the two date limits, and the country code form.
DATE_LIMIT_DAYS = 3650
COUNTRY_CODE_PATTERN = "^[A-Z]{2}$"


@dataclass(frozen=True)
class RuleType:
    """A row-level rule type: how many fields it reads, and when a row passes."""

    arity: int
    passes: Callable[..., Column]


def column(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The day the date rules compare with: a literal, or the day of the run."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def _day(value: Column) -> Column:
    # try_cast: under ANSI mode a malformed text would end the whole job.
    return value.try_cast("date")


def _not_blank(value: Column, today: Column) -> Column:
    return F.trim(value) != ""


def _present(value: Column, today: Column) -> Column:
    return value.isNotNull()


def _non_negative(value: Column, today: Column) -> Column:
    return value >= 0


def _positive(value: Column, today: Column) -> Column:
    return value > 0


def _not_future(value: Column, today: Column) -> Column:
    return _day(value) <= today


def _within_past_limit(value: Column, today: Column) -> Column:
    return _day(value) >= F.date_sub(today, DATE_LIMIT_DAYS)


def _within_future_limit(value: Column, today: Column) -> Column:
    return _day(value) <= F.date_add(today, DATE_LIMIT_DAYS)


def _country_code(value: Column, today: Column) -> Column:
    return value.rlike(COUNTRY_CODE_PATTERN)


def _flag(value: Column, today: Column) -> Column:
    return value.try_cast("int").isin(0, 1)


def _short_within_long(short: Column, long: Column, today: Column) -> Column:
    return short <= long


def _amount_backs_count(count: Column, amount: Column, today: Column) -> Column:
    # Both sides must be known: "count = 0" alone does not excuse a NULL amount.
    return count.isNotNull() & amount.isNotNull() & ((amount > 0) | (count == 0))


ROW_RULES: dict[str, RuleType] = {
    "RULE_1_DATE_NOT_NULL": RuleType(1, _present),
    "RULE_2_STRING_NOT_NULL": RuleType(1, _not_blank),
    "RULE_3_NUMERIC_NOT_NULL": RuleType(1, _present),
    "RULE_10_NUMERIC_NON_NEGATIVE": RuleType(1, _non_negative),
    "RULE_11_NUMERIC_POSITIVE": RuleType(1, _positive),
    "RULE_12_DATE_NOT_FUTURE": RuleType(1, _not_future),
    "RULE_13_DATE_NOT_PAST_LIMIT": RuleType(1, _within_past_limit),
    "RULE_14_DATE_NOT_FUTURE_LIMIT": RuleType(1, _within_future_limit),
    "RULE_20_ISO_COUNTRY_CODE": RuleType(1, _country_code),
    "RULE_21_BOOLEAN_FLAG": RuleType(1, _flag),
    "RULE_40_TEMPORAL_WINDOW_CONSISTENCY": RuleType(2, _short_within_long),
    "RULE_41_POSITIVE_IF_COUNT_NONZERO": RuleType(2, _amount_backs_count),
}


def split_fields(source_field: str) -> list[str]:
    """Field names of a mapping: one, or two joined by ``|``."""
    return source_field.split("|")


def row_rule(rule: str, fields: Sequence[str], as_of: dt.date | str | None = None) -> Column:
    """Boolean Column of a row-level rule over the named fields."""
    rule_type = ROW_RULES[rule]
    if len(fields) != rule_type.arity:
        raise ValueError(f"{rule} reads {rule_type.arity} field(s), got {list(fields)}")
    return rule_type.passes(*[column(f) for f in fields], as_of_date(as_of))


def verdict(passes: Column | None) -> Column:
    """1 or 0; NULL for a rule nobody can evaluate."""
    if passes is None:
        return F.lit(None).cast("int")
    return F.when(passes, F.lit(1)).otherwise(F.lit(0))


def out_of_scope(status: str = "status") -> Column:
    """True on rows whose status says they are not evaluated.

    A NULL or malformed status does not take a row out of scope.
    """
    return F.coalesce(column(status).try_cast("int") != 1, F.lit(False))
