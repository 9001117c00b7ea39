"""The store: one catalog schema holding registry, snapshots, results and audit log.

A table that is replaced, or may be, is a view with nothing but the name of the version it shows. A version is a table of
its own, which is written whole before the view is pointed at it; pointing is one change of one catalogue entry, so
whoever reads finds the old version or the new one, and a crash at any step leaves the old one in place. The version
before the shown one is kept for readers that have planned with it. Snapshots are plain tables, which appear by one renaming.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.schemas import REGISTRY_SCHEMAS, RESULTS, RUN_DATE
from plumbline.sources.staging import with_position


ORDER_PROPERTY = "plumbline.order_by"
_BEFORE, _HELD_SINCE = "plumbline.before", "plumbline.held_since"
_VERSION = re.compile(r"__v[0-9a-f]{12}$")
_LOCK = "__lock"
#: Seconds after which a lock counts as left behind by a crash, and between two looks at one that is held.
LOCK_EXPIRES, LOCK_POLL = 900.0, 0.25


def run_date(instant: Column) -> Column:
    """The day of an instant in UTC, whatever the session's zone: days then follow each other as instants do."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))


@dataclass(frozen=True)
class Store:
    """Tables of one schema. ``table_format`` is any table format the cluster has."""

    spark: SparkSession
    schema: str
    catalog: str = "spark_catalog"
    table_format: str = "parquet"

    def name(self, table: str) -> str:
        return f"{self.catalog}.{self.schema}.{table}"

    def create(self, location: str | None = None) -> None:
        """Create the schema if it is absent."""
        at = f" LOCATION '{location}'" if location else ""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.catalog}.{self.schema}{at}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        """The table as it is now: a session keeps lists of files that other sessions may have added to."""
        self.spark.catalog.refreshTable(self.name(table))
        return self.spark.table(self.name(table))

    def read_entity(self, table: str, positions: bool = False) -> DataFrame:
        """The entity table, with the physical position of each row if a rule needs it.

        A table format without row positions gives the plain table; uniqueness then
        finds another row identity.
        """
        shown = self.version(table)
        df = self.read(shown)
        if not positions or self._described(shown).get("Provider", "").lower() != "parquet":
            return df
        return with_position(df)

    def _described(self, table: str) -> dict[str, str]:
        """What the catalogue says of a table besides its columns; nothing if there is none."""
        try:
            rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()
        except AnalysisException:
            if self.exists(table):
                raise
            return {}
        at = next((i for i, r in enumerate(rows) if r[0] == "# Detailed Table Information"), len(rows))
        return {r[0]: r[1] for r in rows[at + 1 :]}

    def version(self, table: str) -> str:
        """The table that is shown under this name: a version, or the table itself if it is none of ours."""
        described = self._described(table)
        shown = re.search(r"FROM \S*\.(\w+)$", described.get("View Text", ""))
        return shown.group(1) if described.get("Type") == "VIEW" and shown else table

    def append(self, table: str, df: DataFrame) -> None:
        """Append rows, columns in the table's order; nothing is written for no rows.

        Registry batches and runs are a few rows: they become one file (the log one per day).
        """
        if df.isEmpty():
            return
        shown = self.version(table)
        columns = self.read(shown).columns
        if RUN_DATE in columns and RUN_DATE not in df.columns:
            df = df.withColumn(RUN_DATE, run_date(F.col("dq_execution_timestamp")))
        df.select(*columns).coalesce(1).write.insertInto(self.name(shown))

    def overwrite(self, table: str, df: DataFrame) -> DataFrame:
        """Replace the table, its schema included, and read it back. The old one stays until the new one is whole."""
        self.swap(self.stage(table, df), table)
        return self.read(table)

    def stage(self, table: str, df: DataFrame) -> str:
        """Write a frame to a new version of ``table`` that nobody sees yet; what fails leaves nothing behind."""
        staged = f"{table}__v{uuid.uuid4().hex[:12]}"
        try:
            df.write.format(self.table_format).saveAsTable(self.name(staged))
        except Exception:
            self.discard(staged)
            raise
        return staged

    def swap(self, staged: str, table: str) -> None:
        """Show a staged version under the name ``table``, in one change of the catalogue.

        A table under that name that is none of ours is renamed to a version first, once; only then is the name free
        for a moment. The order kept with the old version goes over to the new one.
        """
        shown = self.version(table) if self.exists(table) else None
        if shown is not None:
            if (order := self.order(table)) and not self.order(staged):
                self.set_order(staged, order)
            if shown == table:
                shown = f"{table}__v{uuid.uuid4().hex[:12]}"
                self._run(f"ALTER TABLE {self.name(table)} RENAME TO {self.schema}.{shown}")
                self._set(staged, _BEFORE, shown)
                self._show(staged, table, new=True)
                return
            self._set(staged, _BEFORE, shown)
        self._show(staged, table, new=shown is None)
        if shown is not None and (oldest := self._properties(shown).get(_BEFORE)):
            self.discard(oldest)

    def _show(self, version: str, table: str, new: bool) -> None:
        columns = [c for c in self.read(version).columns if c != RUN_DATE or table != RESULTS]
        listed = ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
        self._run(f"{'CREATE' if new else 'ALTER'} VIEW {self.name(table)} AS SELECT {listed} FROM {self.name(version)}")

    def _run(self, statement: str) -> None:
        self.spark.sql(statement)

    def versions(self, table: str) -> list[str]:
        """All versions of a table, unseen ones too."""
        listed = self.spark.catalog.listTables(f"{self.catalog}.{self.schema}")
        return sorted(t.name for t in listed if _VERSION.sub("", t.name) == table and t.name != table)

    def vacuum(self, table: str) -> list[str]:
        """Drop versions that crashed writers left behind: all but the shown one and the one before. Not while others write."""
        shown = self.version(table)
        kept = {shown, self._properties(shown).get(_BEFORE)}
        dropped = [v for v in self.versions(table) if v not in kept]
        for version in dropped:
            self.discard(version)
        return dropped

    def discard(self, table: str) -> None:
        """Drop a table, with its versions if it has any."""
        if self._described(table).get("Type") == "VIEW":
            versions = self.versions(table)
            self._run(f"DROP VIEW IF EXISTS {self.name(table)}")
            for version in versions:
                self.discard(version)
        else:
            self._run(f"DROP TABLE IF EXISTS {self.name(table)}")

    @contextmanager
    def exclusive(self, table: str) -> Iterator[None]:
        """Hold ``table`` against other writers that ask too: numbering on from the highest id needs it.

        The lock is a table that exists: creating one is a step that only one of many sessions succeeds in. A lock older
        than ``LOCK_EXPIRES`` seconds was left by a crash and is broken.
        """
        lock = self.name(f"{table}{_LOCK}")
        while True:
            try:
                self._run(f"CREATE TABLE {lock} (n INT) USING {self.table_format} TBLPROPERTIES ('{_HELD_SINCE}' = '{time.time()}')")
                break
            except AnalysisException as error:
                if "ALREADY_EXISTS" not in (error.getCondition() or ""):
                    raise
            try:
                since = float(self._properties(f"{table}{_LOCK}").get(_HELD_SINCE, "inf"))
            except AnalysisException:  # let go of in the meantime
                continue
            if time.time() - since > LOCK_EXPIRES:
                self._run(f"DROP TABLE IF EXISTS {lock}")
            time.sleep(LOCK_POLL)
        try:
            yield
        finally:
            self._run(f"DROP TABLE IF EXISTS {lock}")

    def _properties(self, table: str) -> dict[str, str]:
        return dict(self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect())

    def _set(self, table: str, name: str, value: str) -> None:
        text = value.replace("\\", "\\\\").replace("'", "\\'")
        self._run(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('{name}' = '{text}')")

    def set_order(self, table: str, columns: Sequence[str]) -> None:
        """Keep with the table which columns say what duplicate comes first."""
        self._set(self.version(table), ORDER_PROPERTY, json.dumps(list(columns)))

    def order(self, table: str) -> list[str]:
        """The columns kept by `set_order`; none if nothing was kept."""
        return json.loads(self._properties(self.version(table)).get(ORDER_PROPERTY, "[]"))

    def snapshot(self, source: DataFrame, table: str, exclude: Sequence[str] = (), order_by: Sequence[str] = ()) -> bool:
        """Copy a source frame into the store unless the table exists; tell whether it was copied.

        The table appears whole, with ``order_by`` kept, or not at all.
        """
        if self.exists(table):
            return False
        staged = self.stage(table, source.drop(*exclude))
        try:
            if order_by:
                self.set_order(staged, order_by)
            self._run(f"ALTER TABLE {self.name(staged)} RENAME TO {self.schema}.{table}")
        except Exception:
            self.discard(staged)
            raise
        return True

    def create_registry(self) -> None:
        """Create the registry tables and the audit log where they are absent. The log is partitioned by its runs' day."""
        for table, schema in REGISTRY_SCHEMAS.items():
            if not self.exists(table):
                version = f"{table}__v{uuid.uuid4().hex[:12]}"
                day = f"`{RUN_DATE}` DATE" if table == RESULTS else ""
                self._run(
                    f"CREATE TABLE {self.name(version)} ({', '.join([_columns(schema), *([day] if day else [])])}) "
                    f"USING {self.table_format}{f' PARTITIONED BY (`{RUN_DATE}`)' if day else ''}"
                )
                try:
                    self._show(version, table, new=True)
                except AnalysisException:  # another session was first
                    self.discard(version)
                    if not self.exists(table):
                        raise

    def log_days(self) -> list[str] | None:
        """The days of the audit log's partitions, oldest first; None for a log that has none."""
        shown = self.version(RESULTS)
        if RUN_DATE not in self.read(shown).columns:
            return None
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name(shown)}").collect()  # one per day with runs
        return sorted(r[0].split("=", 1)[1] for r in rows)

    def read_log(self, first: str, last: str) -> DataFrame:
        """The audit log's runs of some days (UTC): only their partitions are read."""
        log = self.read(self.version(RESULTS))
        if RUN_DATE in log.columns:
            log = log.where(F.col(RUN_DATE).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        return log.drop(RUN_DATE)

    def tables(self) -> list[str]:
        """Names of the store's tables."""
        listed = self.spark.catalog.listTables(f"{self.catalog}.{self.schema}")
        return sorted(t.name for t in listed if not t.isTemporary and not _VERSION.search(t.name) and not t.name.endswith(_LOCK))

    def row_counts(self, tables: Sequence[str]) -> DataFrame:
        """One row per table with its row count, in a single job."""
        return count_rows({t: self.read(t) for t in tables})


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)


def count_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per frame: its name and row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)
