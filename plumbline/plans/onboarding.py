"""Onboarding an entity: registry rows and the snapshot its rules will read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from plumbline.packs import Pack
from plumbline.packs.base_rules import ALL_RULES
from plumbline.sources.registry import register_mappings, register_request, register_rules
from plumbline.sources.store import Store


def onboard(store: Store, pack: Pack, source: DataFrame, created_date: dt.date | None = None, update: bool = False) -> None:
    """Register a pack and snapshot its source. Safe to repeat, also after a failure: what exists is left alone, but a
    table without an order gets the pack's. With ``update`` registered rows take on what the pack says now."""
    store.create_registry()
    extra = [r for r in pack.new_generic_rules if r not in ALL_RULES]
    register_rules(store, [*ALL_RULES, *extra], created_date, update)
    register_request(store, pack, created_date, update)
    copied = store.snapshot(source, pack.entity, pack.exclude_columns, pack.order_by)
    if not copied and pack.order_by and not store.order(pack.entity):
        store.set_order(pack.entity, pack.order_by)
    register_mappings(store, pack, created_date=created_date, update=update)
