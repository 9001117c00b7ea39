"""Shared scratch space and materialisation of intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Where a row lies: its file, as a 128-bit digest of the path, and its index in the file.
POSITION = ("_dq_file_a", "_dq_file_b", "_dq_row")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="plumbline-")
    context.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, keep: Column | None = None, **measures: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` to reliable storage once and return it with its measures.

    ``measures`` are aggregates over the frame before the ``keep`` filter; they
    ride along with the write. The observed node sits in the last stage of that
    job, where a retried task is counted once.
    """
    shared_dir(df.sparkSession)
    observation = Observation()
    observed = df.observe(observation, *[m.alias(n) for n, m in measures.items()]) if measures else df
    if keep is not None:
        observed = observed.where(keep)
    stored = observed.checkpoint()
    return stored, (observation.get if measures else {})


def with_position(df: DataFrame) -> DataFrame:
    """Add the physical position of each row of a frame just read from Parquet.

    File and row index do not depend on how the scan is split, so they are the
    same in every scan of an unchanged table, and on a retried task.
    """
    path = F.col("_metadata.file_path")
    place = (F.xxhash64(path), F.xxhash64(F.lit(1), path), F.col("_metadata.row_index"))
    return df.select("*", *[value.alias(name) for name, value in zip(POSITION, place)])


def has_position(df: DataFrame) -> bool:
    return set(POSITION) <= set(df.columns)


def stage_with_position(df: DataFrame) -> DataFrame:
    """Write a derived frame to the shared folder, so that its rows have a position."""
    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return with_position(df.sparkSession.read.schema(df.schema).parquet(path))
