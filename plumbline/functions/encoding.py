"""The encoded verdict string: ``RULE_101: 1 | RULE_102: 0 | RULE_103: NULL``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator, label and the two spellings of "not evaluated".
SEPARATOR = " | "
NOT_EVALUATED = "NULL"
NOT_EVALUATED_SHORT = "N"


def label(rule_mapping_id: int) -> str:
    return f"RULE_{rule_mapping_id}"


def encode_conditions(
    conditions: Sequence[tuple[int, Column | None]],
    skipped: Column | None,
    marker: str = NOT_EVALUATED,
) -> Column:
    """Encode pass conditions straight to text.

    Every segment is one of two literals, separator included, so a row costs a
    single ``concat``. Rows out of scope share one constant string.
    """
    if not conditions:
        return F.lit("")
    pieces, prefix = [], ""
    for mapping_id, passes in conditions:
        head = f"{prefix}{label(mapping_id)}: "
        if passes is None:
            pieces.append(F.lit(head + marker))
        else:
            pieces.append(F.when(passes, F.lit(head + "1")).otherwise(F.lit(head + "0")))
        prefix = SEPARATOR
    encoded = F.concat(*pieces)
    if skipped is None:
        return encoded
    blank = SEPARATOR.join(f"{label(i)}: {marker}" for i, _ in conditions)
    return F.when(skipped, F.lit(blank)).otherwise(encoded)


def encode_verdicts(verdicts: Sequence[tuple[int, Column]], marker: str = NOT_EVALUATED) -> Column:
    """Encode typed verdict columns (1, 0 or NULL)."""
    segments = [
        F.concat(F.lit(f"{label(i)}: "), F.coalesce(v.cast("string"), F.lit(marker)))
        for i, v in verdicts
    ]
    return F.concat_ws(SEPARATOR, *segments)


def segments(encoded: Column) -> Column:
    """The encoded string as an array of ``RULE_n: v`` texts.

    Split on the bare bar, which needs no regular expression; the blanks around it
    are left to ``segment_label`` and ``segment_value``.
    """
    return F.split(encoded, r"\|")


def segment_label(segment: Column) -> Column:
    return F.trim(F.substring_index(segment, ":", 1))


def segment_value(segment: Column) -> Column:
    return F.trim(F.substring_index(segment, ":", -1))


def _occurrences(encoded: Column, verdict: str) -> Column:
    ending = f": {verdict}"
    without = F.replace(encoded, F.lit(ending), F.lit(""))
    return F.call_function("div", F.length(encoded) - F.length(without), F.lit(len(ending))).cast("int")


def checks_in_row(encoded: Column) -> Column:
    """Number of rules evaluated on the row."""
    return _occurrences(encoded, "0") + _occurrences(encoded, "1")


def passes_in_row(encoded: Column) -> Column:
    """Number of rules the row passes."""
    return _occurrences(encoded, "1")


def decode(encoded: Column) -> Column:
    """The encoded string as a map from rule label to verdict; both markers give NULL, an empty string no entry.

    Every segment is cut and cast; for the verdicts of some rules `verdict_of` is the cheaper way.
    """
    filled = F.filter(segments(encoded), lambda s: F.trim(s) != "")
    return F.map_from_entries(
        F.transform(filled, lambda s: F.struct(segment_label(s), segment_value(s).try_cast("int")))
    )


def rule_evaluated(encoded: Column, rule_mapping_id: int) -> Column:
    """Whether one rule was evaluated on the row, read from the encoded string."""
    return encoded.contains(f"{label(rule_mapping_id)}: 0") | rule_passed(encoded, rule_mapping_id)


def rule_passed(encoded: Column, rule_mapping_id: int) -> Column:
    """Whether the row passed one rule, read from the encoded string."""
    return encoded.contains(f"{label(rule_mapping_id)}: 1")


def verdict_of(encoded: Column, rule_mapping_id: int) -> Column:
    """One rule's verdict (1, 0 or NULL if it was not evaluated), searched for in the encoded string."""
    failed = encoded.contains(f"{label(rule_mapping_id)}: 0")
    return F.when(rule_passed(encoded, rule_mapping_id), 1).when(failed, 0)
