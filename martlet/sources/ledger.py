"""A batch ledger: staged files and one atomic commit per batch.

A batch is first written to folders of its own (one per table) and becomes part of
its tables by one ledger row, a single small file that Spark's job commit moves into
place: it is there whole or not at all.  Readers take the committed folders only, so

* a crashed write leaves files that nothing reads;
* a retried batch finds its id in the ledger and does nothing;
* a batch over several tables enters all of them at once;
* of two writers that race with one batch id, the earlier commit counts, for every
  reader alike.

A snapshot is a batch that stands for the batches it lists.  The ledger holds one row
of about 200 bytes per batch; only these rows reach the driver.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = "batch_id string, attempt string, committed_at timestamp_ntz, tables map<string,string>, included array<string>"


@dataclass(frozen=True)
class Entry:
    batch_id: str
    tables: dict[str, str]
    included: tuple[str, ...]


def conform(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """``batch`` in a table's column order and types; a missing or extra column fails."""
    have, want = set(batch.columns), [f.name for f in schema.fields]
    if have != set(want):
        raise ValueError(f"batch columns {sorted(have)} do not match table {sorted(want)}")
    return batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


class Ledger:
    """The committed batches of the tables below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")

    # ------------------------------------------------------------- reading
    def committed(self) -> list[Entry]:
        """Every batch, in commit order, the first commit of an id only."""
        try:
            rows = self._spark.read.schema(ENTRY).parquet(f"{self._path}/_ledger")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        first: dict[str, Entry] = {}
        for r in sorted(rows.collect(), key=lambda r: (r.committed_at, r.attempt)):
            first.setdefault(r.batch_id, Entry(r.batch_id, dict(r.tables), tuple(r.included or ())))
        return list(first.values())

    def live(self) -> list[Entry]:
        """The batches to read: the newest snapshot and what it does not include."""
        entries = self.committed()
        snapshots = [e for e in entries if e.included]
        if not snapshots:
            return entries
        newest = snapshots[-1]
        gone = set(newest.included)
        return [newest, *[e for e in entries if not e.included and e.batch_id not in gone]]

    def has(self, batch_id: str) -> bool:
        return any(e.batch_id == batch_id for e in self.committed())

    def folders(self, table: str) -> list[str]:
        return [f"{self._path}/{e.tables[table]}" for e in self.live() if table in e.tables]

    def read(self, table: str, schema: T.StructType | str | None = None) -> DataFrame:
        """All committed rows of ``table``; without a batch, ``schema`` with no rows."""
        parts = self.folders(table)
        if not parts:
            return self._spark.createDataFrame([], schema)
        reader = self._spark.read.schema(schema) if schema is not None else self._spark.read
        return reader.option("basePath", f"{self._path}/files").parquet(*parts).drop("batch")

    # ------------------------------------------------------------- writing
    def stage(self, batch_id: str, table: str, rows: DataFrame, partition_by: str | None = None) -> str:
        """Write ``rows`` to a new folder that no reader knows; returns its name."""
        folder = f"files/{table}/batch={_safe(batch_id)}-{uuid.uuid4().hex[:12]}"
        writer = rows.write.mode("errorifexists")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{self._path}/{folder}")
        return folder

    def staged(self, folder: str, schema: T.StructType | str) -> DataFrame:
        return self._spark.read.schema(schema).parquet(f"{self._path}/{folder}")

    def commit(self, batch_id: str, tables: dict[str, str], included: list[str] | None = None) -> None:
        """Make staged folders part of their tables, all at once."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = (batch_id, uuid.uuid4().hex, now, tables, included or [])
        (self._spark.createDataFrame([row], ENTRY).coalesce(1)
         .write.mode("append").parquet(f"{self._path}/_ledger"))

    def append(self, batch_id: str, tables: dict[str, DataFrame]) -> bool:
        """Stage and commit a batch; ``False`` if its id was committed before."""
        if self.has(batch_id):
            return False
        self.commit(batch_id, {name: self.stage(batch_id, name, rows) for name, rows in tables.items()})
        return True


def _safe(batch_id: str) -> str:
    return "".join(c if c.isalnum() or c in "-_" else "_" for c in batch_id)


def append_batch_once(ledger: Ledger, table: str, batch: DataFrame, batch_id: str, stamp_column: str = "_loaded_at") -> bool:
    """Append ``batch`` to a ledger table, stamped with one load time, unless
    ``batch_id`` was committed before: a retry changes nothing, the first commit's
    stamp stays.  The table's first batch defines its schema; later ones are cast
    to it (ANSI casts fail instead of wrapping)."""
    if ledger.has(batch_id):
        return False
    stamped = batch.withColumn(stamp_column, F.localtimestamp())
    if ledger.folders(table):
        stamped = conform(stamped, ledger.read(table).schema)
    ledger.commit(batch_id, {table: ledger.stage(batch_id, table, stamped)})
    return True
