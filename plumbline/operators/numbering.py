"""Surrogate keys for new rows, without an identity column in the table format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.sources.staging import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def assign_ids(df: DataFrame, id_column: str, start: int, order_by: list[Column | str]) -> DataFrame:
    """Number the rows ``start + 1``, ``start + 2``, ... in the given order.

    The sort spreads over range partitions. The sorted rows are materialised, so
    that a partition and the place in it stay the same; then each partition needs
    only its offset, from as many counts as there are partitions.
    """
    placed, _ = materialise(df.drop(id_column).orderBy(*order_by))
    place = F.monotonically_increasing_id()
    placed = placed.select(
        "*",
        F.shiftright(place, _ROW_BITS).alias("_dq_part"),
        place.bitwiseAND((1 << _ROW_BITS) - 1).alias("_dq_place"),
    )
    before = Window.orderBy("_dq_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_dq_part")
        .agg(F.count(F.lit(1)).alias("_dq_size"))
        .select("_dq_part", F.coalesce(F.sum("_dq_size").over(before), F.lit(0)).alias("_dq_offset"))
    )
    return placed.join(F.broadcast(offsets), "_dq_part").select(
        (F.lit(start + 1) + F.col("_dq_offset") + F.col("_dq_place")).cast("long").alias(id_column),
        *[c for c in df.columns if c != id_column],
    )
