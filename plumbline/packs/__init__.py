"""Rule packs: the declarative content that binds rule types to an entity.

A pack is a module here, or a JSON file of the user's: the fields of `Pack`, its rules as objects with the fields of
`PackRule`. Files are read, never executed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from importlib import import_module
from pathlib import Path


@dataclass(frozen=True)
class PackRule:
    """One binding of a rule type to a field (``"a|b"`` for two-column rules)."""

    rule_mapping_id: int
    rule: str
    field: str
    description: str
    threshold_pct: float
    category: str


@dataclass(frozen=True)
class Pack:
    """All bindings of one entity, with their owner and request name."""

    entity: str
    request_short: str
    owner_dept: str
    owner_user: str
    rules: tuple[PackRule, ...]
    new_generic_rules: tuple[tuple, ...] = ()
    exclude_columns: tuple[str, ...] = field(default=())
    #: Columns that say which of several duplicates is the first.
    order_by: tuple[str, ...] = field(default=())


def load_pack(entity: str) -> Pack:
    """Load the pack module named after the entity."""
    return import_module(f"{__name__}.{entity}").PACK


def _checked(kind: type, values: dict, where: str) -> dict:
    known = {f.name for f in fields(kind)}
    if unknown := sorted(set(values) - known):
        raise ValueError(f"{where}: unknown {', '.join(unknown)}; known are {', '.join(sorted(known))}")
    return values


def read_pack(path: str | Path) -> Pack:
    """Read a pack from a JSON file."""
    content = _checked(Pack, json.loads(Path(path).read_text(encoding="utf-8")), str(path))
    rules = tuple(PackRule(**_checked(PackRule, r, f"{path}, rule {i}")) for i, r in enumerate(content.pop("rules", []), 1))
    generic = tuple(tuple(r) for r in content.pop("new_generic_rules", []))
    lists = {k: tuple(content.pop(k)) for k in ("exclude_columns", "order_by") if k in content}
    return Pack(**content, rules=rules, new_generic_rules=generic, **lists)
