"""Values of a row's group beside the row: narrow aggregates that are looked up, in place of windows over wide rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.rules import column
from plumbline.operators.uniqueness import MAX_BROADCAST_BYTES, grouping_key
from plumbline.sources.staging import materialise

_NAME = r"`(?:[^`]|``)+`|[A-Za-z_]\w*"
_WINDOW = re.compile(
    rf"(?<![\w`])(?P<function>COUNT|SUM|MIN|MAX|AVG)\s*\(\s*(?P<argument>\*|{_NAME})\s*\)\s*"
    rf"OVER\s*\(\s*PARTITION\s+BY\s+(?P<keys>(?:{_NAME})(?:\s*,\s*(?:{_NAME}))*)\s*\)",
    re.IGNORECASE,
)
_FIRST = re.compile(
    rf"\s*ROW_NUMBER\s*\(\s*\)\s*OVER\s*\(\s*PARTITION\s+BY\s+(?P<key>{_NAME})\s+ORDER\s+BY\s+"
    rf"(?P<order>(?:{_NAME})(?:\s*,\s*(?:{_NAME}))*)\s*\)\s*=\s*1\s*",
    re.IGNORECASE,
)
#: A looked-up group: a key is up to 65 bytes, a value and the entry of a hash table as much again.
_ENTRY_BYTES = 160


@dataclass(frozen=True)
class GroupValue:
    """An aggregate over the rows that share the values of some columns; ``argument`` is a column or ``*``."""

    function: str
    argument: str
    keys: tuple[str, ...]


def _names(listed: str) -> tuple[str, ...]:
    return tuple(n[1:-1].replace("``", "`") if n.startswith("`") else n for n in re.findall(_NAME, listed))


def first_of_group(template: str) -> tuple[str, tuple[str, ...]] | None:
    """The column and the order of a template that asks for the first row of each value."""
    found = _FIRST.fullmatch(template)
    return (_names(found["key"])[0], _names(found["order"])) if found else None


def take_windows(template: str, prefix: str) -> tuple[str, dict[str, GroupValue]]:
    """The template with its aggregates over partitions replaced by columns named ``prefix`` and a number, and these."""
    found: dict[str, GroupValue] = {}

    def named(match: re.Match) -> str:
        argument = match["argument"] if match["argument"] == "*" else _names(match["argument"])[0]
        value = GroupValue(match["function"].upper(), argument, _names(match["keys"]))
        name = next((n for n, v in found.items() if v == value), f"{prefix}{len(found)}")
        found[name] = value
        return f"`{name}`"

    return _WINDOW.sub(named, template), found


def _aggregate(value: GroupValue, argument: Column | None) -> Column:
    if value.argument == "*":
        if value.function != "COUNT":
            raise ValueError(f"{value.function}(*) is no aggregate")
        return F.count(F.lit(1))
    return {"COUNT": F.count, "SUM": F.sum, "MIN": F.min, "MAX": F.max, "AVG": F.avg}[value.function](argument)


def with_group_values(
    df: DataFrame, values: dict[str, GroupValue], max_broadcast: int = MAX_BROADCAST_BYTES // _ENTRY_BYTES
) -> DataFrame:
    """Add a column per value, the same as the aggregate over a window partitioned by its keys.

    Values of the same keys are one narrow aggregate, in which a hot key folds to a row per task. A row whose keys
    occur once has the aggregate of itself. Only repeated keys are looked up: by a broadcast if they are few, else by a
    join on the keys, which Spark splits where one is hot. NULL keys are a group; no rows give no rows.
    """
    by_keys: dict[tuple[str, ...], list[str]] = {}
    for name, value in values.items():
        by_keys.setdefault(value.keys, []).append(name)
    for n, (names, wanted) in enumerate(by_keys.items()):
        keys = [grouping_key(df, k) for k in names]
        of_keys = [k.alias(f"_dq_key_{i}") for i, k in enumerate(keys)]
        arguments = {w: column(values[w].argument).alias(f"_dq_of_{w}") for w in wanted if values[w].argument != "*"}
        narrow = df.select(*of_keys, *arguments.values())
        grouped = narrow.groupBy(*[f"_dq_key_{i}" for i in range(len(keys))]).agg(
            F.count(F.lit(1)).alias("_dq_n"), *[_aggregate(values[w], F.col(f"_dq_of_{w}")).alias(w) for w in wanted]
        )
        repeated, seen = materialise(grouped, keep=F.col("_dq_n") > 1, repeated=F.count_if(F.col("_dq_n") > 1))
        alone = {w: _of_one_row(values[w]).cast(repeated.schema[w].dataType) for w in wanted}
        if not seen["repeated"]:
            df = df.withColumns(alone)
            continue
        found = repeated.select(
            *[F.col(f"_dq_key_{i}").alias(f"_dq_found_{n}_{i}") for i in range(len(keys))],
            F.lit(True).alias(f"_dq_hit_{n}"), *[F.col(w).alias(f"_dq_all_{w}") for w in wanted],
        )
        same = reduce(lambda a, b: a & b, [k.eqNullSafe(F.col(f"_dq_found_{n}_{i}")) for i, k in enumerate(keys)])
        joined = df.join(F.broadcast(found) if seen["repeated"] <= max_broadcast else found, same, "left")
        hit = F.col(f"_dq_hit_{n}").isNotNull()
        df = joined.select(
            *[column(c) for c in df.columns], *[F.when(hit, F.col(f"_dq_all_{w}")).otherwise(alone[w]).alias(w) for w in wanted]
        )
    return df


def _of_one_row(value: GroupValue) -> Column:
    if value.argument == "*":
        return F.lit(1)
    if value.function == "COUNT":
        return F.when(column(value.argument).isNotNull(), 1).otherwise(0)
    return column(value.argument)
