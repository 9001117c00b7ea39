"""Pass percentage and rule status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pass_hundredths(passed: Column, checked: Column) -> Column:
    """Pass percentage in whole hundredths, half up; NULL when nothing was checked.

    Decimal operands: counts of a large history times 20000 leave the BIGINT range.
    """
    p, c = (x.cast("decimal(24,0)") for x in (passed, checked))
    return F.call_function("div", p * 20000 + c, F.nullif(c * 2, F.lit(0).cast("decimal(24,0)")))


def pass_pct(passed: Column, checked: Column) -> Column:
    """Pass percentage rounded half up to two decimals; NULL when nothing was checked."""
    return pass_hundredths(passed, checked).cast("double") / 100


def rule_score(passed: Column, checked: Column) -> Column:
    """Pass percentage of one rule; 0.0 when nothing was checked."""
    return F.coalesce(pass_pct(passed, checked), F.lit(0.0))


def rule_status(passed: Column, checked: Column) -> Column:
    """SKIPPED, PASS or BREACH; any failure is a BREACH, whatever the threshold."""
    return (
        F.when(checked == 0, F.lit("SKIPPED"))
        .when(passed == checked, F.lit("PASS"))
        .otherwise(F.lit("BREACH"))
    )
