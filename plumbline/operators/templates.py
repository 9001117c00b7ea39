"""SQL templates of the catalogue, evaluated with ``F.expr``."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


_PLACEHOLDER = re.compile(r"\{([A-Za-z_]\w*)\}")  # not the {2} of a pattern


def fill_template(template: str, fields: Sequence[str], as_of: dt.date | str | None = None) -> str:
    """Put field names, in order of first mention, into the template's placeholders.

    With ``as_of`` the template's ``current_date()`` becomes that literal day.
    """
    names = list(dict.fromkeys(_PLACEHOLDER.findall(template)))
    if len(names) != len(fields):
        raise ValueError(f"template reads {names}, got {list(fields)}")
    by_name = dict(zip(names, fields))
    filled = _PLACEHOLDER.sub(lambda m: f"`{by_name[m.group(1)]}`", template)
    if as_of is not None:
        filled = filled.replace("current_date()", f"DATE'{as_of}'")
    return filled


_FIRST_OF_VALUE = re.compile(
    r"\s*ROW_NUMBER\s*\(\s*\)\s*OVER\s*\(\s*PARTITION\s+BY\s+\{\w+\}\s+ORDER\s+BY\s+\{\w+\}\s*\)\s*=\s*1\s*", re.IGNORECASE
)


def is_first_of_value(template: str) -> bool:
    """Whether a template asks for the first row of each value: the uniqueness rule, not a window over whole rows."""
    return bool(_FIRST_OF_VALUE.fullmatch(template))


def template_passes(sql: str) -> Column:
    """Pass condition of a filled template that yields 1 or 0, or true or false."""
    return F.expr(sql).cast("int") == 1
