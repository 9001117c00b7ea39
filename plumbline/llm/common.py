"""What several operators share: reading tables, word patterns, iterating over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A word: a run of characters other than the six ASCII blanks. ``bytes.split()`` cuts at the same six.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BLANKS = "\t\n\x0b\x0c\r "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.length(text)  # ASCII only: the quick way does the same
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def without(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` without columns of these names, whatever their case: an operator's own columns replace them."""
    named = {c.lower() for c in columns}
    return df.drop(*[c for c in df.columns if c.lower() in named])


def extended(df: DataFrame, added: str) -> StructType:
    """The schema of ``df`` with further fields."""
    return StructType([*df.schema.fields, *StructType.fromDDL(added).fields])


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most_bytes`` of ``column``, one row at least: bounds what Python holds."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        if not batch.num_rows or values.nbytes <= most_bytes:
            yield batch
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def text_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array and where each begins, with the end last. Nulls are empty."""
    values = pa.compute.fill_null(values, "").cast(pa.large_string())
    _, places, data = values.buffers()
    offsets = np.frombuffer(places, np.int64)[values.offset : values.offset + len(values) + 1]
    begin, end = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    raw = np.frombuffer(data, np.uint8)[begin:end] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - begin


def per_batch(df: DataFrame, function, schema: str, column: str = "text") -> DataFrame:
    """``mapInArrow`` with ``function(batch) -> dict of columns`` over slices of bounded size."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in small_batches(batches, column):
            out = function(batch)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def to_arrow_schema(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
             "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
             "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches of a sorted partition, cut so that no group of integer ``keys`` spans two, and where groups begin in
    each, with its end last. What is held is a batch and the group at its end."""

    def begins(batch: pa.RecordBatch) -> list[int]:
        marks = np.column_stack([batch.column(k).to_numpy() for k in keys])
        return [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist()]

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch if held is None else pa.concat_batches([held, batch])
        cuts = begins(batch)
        held = batch.slice(cuts[-1])
        if cuts[-1]:
            yield batch.slice(0, cuts[-1]), cuts
    if held is not None:
        yield held, [0, held.num_rows]
