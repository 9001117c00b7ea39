"""Registry maintenance: upserts of rules, requests and mappings, insert-only unless asked to update."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.numbering import assign_ids
from plumbline.packs import Pack
from plumbline.schemas import (
    RULE_MAPPINGS,
    RULES_GENERIC,
    VALIDATION_REQUEST,
    RULES_GENERIC_SCHEMA,
)
from plumbline.sources.store import Store

CREATED_BY = "plumbline"


def stamped(df: DataFrame, created_date: dt.date | None = None, created_by: str = CREATED_BY) -> DataFrame:
    """Add the constant bookkeeping columns of a new registry row."""
    day = F.current_date() if created_date is None else F.lit(created_date)
    return df.withColumns(
        {"active": F.lit(1), "created_date": day, "created_by": F.lit(created_by)}
    )


def rule_number_column(rule_mapping_id: Column, rule: Column, source_field: Column) -> Column:
    """``DQ_{id}_{rule name after its second "_"}_{field}``, with ``|`` spelt ``_vs_``."""
    return F.concat_ws(
        "_",
        F.lit("DQ"),
        rule_mapping_id.cast("string"),
        F.regexp_replace(rule, "^[^_]*_[^_]*_", ""),
        F.replace(source_field, F.lit("|"), F.lit("_vs_")),
    )


def unregistered(new: DataFrame, registered: DataFrame, key: str) -> DataFrame:
    """The new rows whose key the registry does not hold yet."""
    return new.join(registered.select(key), key, "left_anti").select(*new.columns)


def numbered(
    new: DataFrame, registered: DataFrame, key: str, id_column: str, order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """Unregistered rows, numbered on from the registry's highest id."""
    start = registered.agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
    return assign_ids(unregistered(new, registered, key), id_column, start, list(order_by or [key]))


def resolve_request_ids(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """Replace the request's short name by its id; an unknown name fails the job."""
    ids = requests.select("dq_validation_request_short", "dq_val_request_id")
    missing = F.raise_error(
        F.concat(F.lit("validation request is not registered: "), F.col("dq_validation_request_short"))
    )
    return (
        rows.join(ids, "dq_validation_request_short", "left")
        .withColumn("dq_val_request_id", F.coalesce("dq_val_request_id", missing.cast("long")))
        .drop("dq_validation_request_short")
    )


def generic_rule_rows(spark: SparkSession, rules: Sequence[tuple], created_date: dt.date | None = None) -> DataFrame:
    """Catalogue rows of rule definitions, with their place in the list as ``ordinal``."""
    names = RULES_GENERIC_SCHEMA.fieldNames()[1:9]
    schema = "ordinal int, " + ", ".join(f"{n} string" for n in names)
    rows = [(i, *r) for i, r in enumerate(rules)]
    return stamped(spark.createDataFrame(rows, schema), created_date)


def request_row(spark: SparkSession, pack: Pack, created_date: dt.date | None = None) -> DataFrame:
    row = (pack.request_short, pack.owner_dept, pack.owner_user)
    schema = "dq_validation_request_short string, owner_dept string, owner_user string"
    return stamped(spark.createDataFrame([row], schema), created_date)


def mapping_rows(
    spark: SparkSession, pack: Pack, catalog: str, schema: str, table: str, created_date: dt.date | None = None
) -> DataFrame:
    """Mapping rows of a pack; the request is still named, not numbered."""
    rows = [
        (r.rule_mapping_id, pack.request_short, r.rule, catalog, schema, table, r.field, r.description,
         float(r.threshold_pct), r.category, pack.owner_dept, pack.owner_user)
        for r in pack.rules
    ]
    df = spark.createDataFrame(
        rows,
        "rule_mapping_id long, dq_validation_request_short string, generic_rule_desc_short string, "
        "source_catalog string, source_schema string, source_table string, source_field string, "
        "rule_description string, threshold_pct double, dq_category string, owner_dept string, owner_user string",
    )
    number = rule_number_column(
        F.col("rule_mapping_id"), F.col("generic_rule_desc_short"), F.col("source_field")
    )
    return stamped(df.withColumn("dq_rule_no", number), created_date)


def merged(registered: DataFrame, new: DataFrame, key: str, kept: Sequence[str]) -> DataFrame:
    """``registered`` with the rows of ``new`` in the place of those with the same key, but for the columns ``kept``.

    Each row of ``new`` has a key of its own. Other registered rows stay as they are.
    """
    changed = new.select(F.col(key).alias("_dq_key"), *[F.col(c).alias(f"_dq_new_{c}") for c in new.columns if c not in (key, *kept)])
    joined = registered.join(changed, F.col(key) == F.col("_dq_key"), "left")
    hit = F.col("_dq_key").isNotNull()
    return joined.select(*[
        F.when(hit, F.col(f"_dq_new_{c}")).otherwise(F.col(c)).alias(c) if f"_dq_new_{c}" in changed.columns else F.col(c)
        for c in registered.columns
    ])


def differing(registered: DataFrame, new: DataFrame, key: str, kept: Sequence[str]) -> int:
    """How many registered rows a merge would change."""
    columns = [c for c in new.columns if c in registered.columns and c not in kept]
    return new.select(*columns).join(registered.select(key), key, "left_semi").exceptAll(registered.select(*columns)).count()


STAMP = ("active", "created_date", "created_by")


def _upsert(
    store: Store, table: str, key: str, new: DataFrame, added: Callable[[DataFrame], DataFrame], kept: Sequence[str], update: bool
) -> None:
    """Add the rows whose key is not registered, while no other session writes the table; ``added`` completes them.

    With ``update`` registered rows take on the new values first, by a new version of the table; ids and stamps stay.
    """
    with store.exclusive(table):
        if update and differing(store.read(table), new, key, kept):
            store.overwrite(table, merged(store.read(table), new, key, kept))
        registered = store.read(table)
        store.append(table, added(registered).select(*registered.columns))


def register_rules(store: Store, rules: Sequence[tuple], created_date: dt.date | None = None, update: bool = False) -> None:
    """Add the rule types the catalogue does not hold, in the order given."""
    new, key = generic_rule_rows(store.spark, rules, created_date), "generic_rule_desc_short"

    def added(registered: DataFrame) -> DataFrame:
        return numbered(new, registered, key, "generic_rule_id", ["ordinal"])

    _upsert(store, RULES_GENERIC, key, new, added, ("generic_rule_id", "ordinal", *STAMP), update)


def register_request(store: Store, pack: Pack, created_date: dt.date | None = None, update: bool = False) -> None:
    """Add the pack's validation request unless it is there."""
    new, key = request_row(store.spark, pack, created_date), "dq_validation_request_short"

    def added(registered: DataFrame) -> DataFrame:
        return numbered(new, registered, key, "dq_val_request_id")

    _upsert(store, VALIDATION_REQUEST, key, new, added, ("dq_val_request_id", *STAMP), update)


def register_mappings(
    store: Store, pack: Pack, table: str | None = None, created_date: dt.date | None = None, update: bool = False
) -> None:
    """Add the pack's mappings whose id is not registered. Registered ones stay as they are, unless ``update`` lets them
    take on the pack's thresholds, owners, fields and texts."""
    new = mapping_rows(store.spark, pack, store.catalog, store.schema, table or pack.entity, created_date)
    new, key = resolve_request_ids(new, store.read(VALIDATION_REQUEST)), "rule_mapping_id"

    def added(registered: DataFrame) -> DataFrame:
        return unregistered(new, registered, key)

    _upsert(store, RULE_MAPPINGS, key, new, added, STAMP, update)


def show_rules(generic: DataFrame) -> DataFrame:
    return generic.select("generic_rule_id", "generic_rule_desc_short", "dq_category").orderBy("generic_rule_id")


def show_requests(requests: DataFrame) -> DataFrame:
    return requests.orderBy("dq_val_request_id")


def show_mappings(mappings: DataFrame, table: str | None = None) -> DataFrame:
    chosen = mappings if table is None else mappings.where(F.col("source_table") == table)
    return chosen.select(
        "rule_mapping_id", "dq_rule_no", "generic_rule_desc_short", "source_field", "dq_category"
    ).orderBy("rule_mapping_id")
