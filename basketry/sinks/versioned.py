"""Versioned tables over plain Parquet: overwrite, append, schema rules, read as of a
version, history, rollback.

Layout under the table root::

    data/<batch-id>/part-*.parquet     immutable data written by one operation
    _commits/v<20-digit version>/      one JSON commit record per version

A commit record names the table schema and the list of live data batches. Data is
written first, the commit record last, so a version exists only when its record does;
a job that fails (or whose data-quality check fails) before committing leaves the
table unchanged. Appends write only their own batch; rollback writes only a record
that points at the batches of the target version. Both records and data are written
by Spark to paths that work on any Hadoop file system. One writer per table is
assumed (a second writer racing for the same version fails on the existing path).
"""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime, timezone
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMIT_SCHEMA = (
    "version long, timestamp string, operation string, "
    "operationParameters map<string,string>, table_schema string, "
    "batches array<string>, num_output_rows long"
)


class SchemaMismatchError(Exception):
    """The written DataFrame does not fit the table schema (schema enforcement)."""


class VersionNotFoundError(Exception):
    pass


class ConcurrentCommitError(Exception):
    """Another writer committed the version this write was going to create."""


def _fields(schema: StructType) -> dict[str, object]:
    """Types by lower-case name: Spark resolves column names without regard to case."""
    return {f.name.lower(): f.dataType for f in schema.fields}


def merged_schema(table: StructType, incoming: StructType, allow_new: bool) -> StructType:
    """Table schema after writing ``incoming``; raise on a type change or, unless
    ``allow_new``, on a column the table does not have. Names that differ in case only
    are one column, which keeps the table's spelling."""
    have = _fields(table)
    if len(_fields(incoming)) < len(incoming.fields):
        raise SchemaMismatchError(f"column names differ in case only: {incoming.names}")
    extra = [f for f in incoming.fields if f.name.lower() not in have]
    changed = [
        f"{f.name}: {have[f.name.lower()].simpleString()} -> {f.dataType.simpleString()}"
        for f in incoming.fields
        if f.name.lower() in have and have[f.name.lower()] != f.dataType
    ]
    if changed:
        raise SchemaMismatchError(f"column types differ: {', '.join(changed)}")
    if extra and not allow_new:
        raise SchemaMismatchError(
            "A schema mismatch detected when writing: new columns "
            f"{[f.name for f in extra]} (use merge_schema=True to add them)"
        )
    out = StructType(list(table.fields))
    for f in extra:
        out = out.add(f.name, f.dataType, True)
    return out


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- paths ----------------------------------------------------------------------
    @property
    def _commits(self) -> str:
        return f"{self.root}/_commits"

    def _record_path(self, version: int) -> str:
        return f"{self._commits}/v{version:020d}"

    def _batch_path(self, batch: str) -> str:
        return f"{self.root}/data/{batch}"

    # -- metadata -------------------------------------------------------------------
    def history(self) -> DataFrame:
        """One row per version: version, timestamp, operation, operationParameters,
        num_output_rows (newest first, as DESCRIBE HISTORY lists them)."""
        return self._records().select(
            "version",
            F.col("timestamp").cast("timestamp").alias("timestamp"),
            "operation",
            "operationParameters",
            "num_output_rows",
        ).orderBy(F.col("version").desc())

    def _records(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self._commits}/v*")
        except Exception as e:  # noqa: BLE001 - missing folder = no versions
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                return self.spark.createDataFrame([], COMMIT_SCHEMA)
            raise

    def versions(self) -> list[int]:
        """Committed versions, from a listing of the record folders (no job runs)."""
        try:
            files = self.spark.read.text(f"{self._commits}/v*").inputFiles()
        except Exception as e:  # noqa: BLE001 - missing folder = no versions
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                return []
            raise
        found = (re.search(r"/v(\d{20})/[^/]+$", f) for f in files)
        return sorted({int(m.group(1)) for m in found if m})

    def _record(self, version: int | None = None):
        known = self.versions()
        if version is None:
            if not known:
                return None
            version = known[-1]
        elif version not in known:
            raise VersionNotFoundError(f"{self.root} has no version {version}")
        # one small record file is read, however long the history is
        rows = self.spark.read.schema(COMMIT_SCHEMA).json(self._record_path(version)).collect()
        return rows[0].asDict()

    def latest_version(self) -> int | None:
        rec = self._record()
        return None if rec is None else rec["version"]

    def schema(self, version: int | None = None) -> StructType | None:
        rec = self._record(version)
        return None if rec is None else StructType.fromJson(json.loads(rec["table_schema"]))

    # -- reads ----------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """Latest version, or the given one (time travel), with that version's schema."""
        rec = self._record(version)
        if rec is None:
            raise VersionNotFoundError(f"{self.root} has no committed version")
        schema = StructType.fromJson(json.loads(rec["table_schema"]))
        paths = [self._batch_path(b) for b in rec["batches"]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # -- writes ---------------------------------------------------------------------
    def _write_batch(self, df: DataFrame) -> str:
        batch = uuid.uuid4().hex
        df.write.mode("errorifexists").parquet(self._batch_path(batch))
        return batch

    def _commit(self, prev, operation, params, schema: StructType, batches, n_rows) -> int:
        version = 0 if prev is None else prev["version"] + 1
        record = {
            "version": version,
            "timestamp": datetime.now(timezone.utc).isoformat(timespec="milliseconds"),
            "operation": operation,
            "operationParameters": {k: str(v) for k, v in params.items()},
            "table_schema": schema.json(),
            "batches": list(batches),
            "num_output_rows": int(n_rows),
        }
        rec_df = self.spark.createDataFrame([record], COMMIT_SCHEMA).coalesce(1)
        try:
            rec_df.write.mode("errorifexists").json(self._record_path(version))
        except Exception as e:  # noqa: BLE001
            if "PATH_ALREADY_EXISTS" not in str(e) and "already exists" not in str(e):
                raise
            if version in self.versions():
                raise ConcurrentCommitError(
                    f"{self.root}: version {version} was committed by another writer"
                ) from e
            # debris of a commit that died before its record was committed: replace it
            rec_df.write.mode("overwrite").json(self._record_path(version))
        return version

    def write(
        self,
        df: DataFrame,
        mode: str = "overwrite",
        *,
        overwrite_schema: bool = False,
        merge_schema: bool = False,
        check: Callable[[DataFrame], int | None] | None = None,
    ) -> int:
        """Write ``df`` as a new version and return it.

        overwrite: replaces the contents; the schema must fit the table's unless
        ``overwrite_schema`` (new schema wins) or ``merge_schema`` (new columns added).
        append: adds a batch; an unknown column is rejected unless ``merge_schema``;
        columns the batch lacks read as NULL.
        check: runs on the written data before the commit; raising aborts the commit.
        It may return the row count of the written data (saves a separate count).
        """
        if mode not in ("overwrite", "append"):
            raise ValueError(f"mode must be overwrite or append, not {mode!r}")
        rec = self._record()
        current = None if rec is None else StructType.fromJson(json.loads(rec["table_schema"]))
        if current is None or (mode == "overwrite" and overwrite_schema):
            schema = merged_schema(StructType([]), df.schema, allow_new=True)
        else:
            schema = merged_schema(current, df.schema, allow_new=merge_schema)
        batch = self._write_batch(df)
        written = self.spark.read.schema(df.schema).parquet(self._batch_path(batch))
        n = check(written) if check is not None else None
        if n is None:
            n = written.count()  # parquet footers hold row counts: no data pages read
        batches = [batch] if (mode == "overwrite" or rec is None) else list(rec["batches"]) + [batch]
        params = {"mode": "Overwrite" if mode == "overwrite" else "Append"}
        if merge_schema:
            params["mergeSchema"] = "true"
        if overwrite_schema:
            params["overwriteSchema"] = "true"
        return self._commit(rec, "WRITE", params, schema, batches, n)

    def overwrite(self, df: DataFrame, **kw) -> int:
        return self.write(df, "overwrite", **kw)

    def append(self, df: DataFrame, **kw) -> int:
        return self.write(df, "append", **kw)

    def rollback(self, version: int) -> int:
        """New version whose contents and schema equal ``version`` (no data copied)."""
        rec = self._record(version)
        schema = StructType.fromJson(json.loads(rec["table_schema"]))
        n = self.read(version).count()  # footer row counts only
        return self._commit(self._record(), "RESTORE", {"version": version}, schema, rec["batches"], n)
