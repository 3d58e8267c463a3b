"""Progress of a running round.

A round of model calls is one Spark job, and a job that is lost at its end would
lose every answer paid for. With a ledger each task writes its finished rows to
the shared folder as it goes, a small file at a time (a file is there whole or
not at all). A task that runs again takes those rows from its ledger instead of
asking for them, and a round whose driver is lost is finished by
:func:`recovered` before the next one begins.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address, as driver and tasks see it, and the path
    in it (local paths, and whatever Arrow reads: S3, GCS, HDFS)."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


class Ledger(NamedTuple):
    """Where the tasks of one batch of a log write what they have finished:
    a file per ``rows`` rows, or per ``seconds`` while rows come slower."""
    path: str
    batch: str
    rows: int = 1000
    seconds: float = 60.0

    @property
    def folder(self) -> str:
        return f"{self.path}/_progress/{self.batch}"

    def task(self, schema: T.StructType, key: Sequence[str]) -> TaskLedger:
        return TaskLedger(self, schema, list(key))


def new_ledger(path: str, rows: int = 1000, seconds: float = 60.0,
               batch: str | None = None) -> Ledger:
    return Ledger(path.rstrip("/"), batch or uuid.uuid4().hex, rows, seconds)


class TaskLedger:
    """The ledger inside a task: what earlier attempts of the task have finished,
    by key, and the files of this attempt."""

    def __init__(self, ledger: Ledger, schema: T.StructType, key: list[str]):
        context = TaskContext.get()
        self.key = key
        # An attempt's files are ordered after those of the attempts before it.
        self.attempt = context.attemptNumber()
        self.schema = to_arrow_schema(T.StructType([
            *schema.fields, T.StructField("attempt_no", T.IntegerType())]))
        self.fs, folder = filesystem(ledger.folder)
        self.folder = f"{folder}/task-{context.partitionId()}"
        self.files = 0
        self.finished = self._finished()

    def _finished(self) -> dict[tuple, dict]:
        found = self.fs.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True))
        out: dict[tuple, dict] = {}
        names = sorted(f.path for f in found if f.base_name.endswith(".parquet"))
        for name in names:
            with self.fs.open_input_file(name) as f:
                for row in pq.read_table(f).to_pylist():
                    out[tuple(row[k] for k in self.key)] = row
        return out

    def write(self, rows: pd.DataFrame) -> None:
        """One more file: written aside, then moved to its name."""
        self.fs.create_dir(self.folder, recursive=True)
        table = pa.Table.from_pandas(rows.assign(attempt_no=self.attempt), self.schema,
                                     preserve_index=False)
        name = f"{self.attempt:04d}-{self.files:08d}-{uuid.uuid4().hex[:8]}"
        aside = f"{self.folder}/_{name}.writing"
        with self.fs.open_output_stream(aside) as out:
            pq.write_table(table, out)
        self.fs.move(aside, f"{self.folder}/{name}.parquet")
        self.files += 1


def batches_in_progress(path: str) -> list[str]:
    """Batches that have a progress folder (rounds that run, or that were lost)."""
    fs, folder = filesystem(f"{path.rstrip('/')}/_progress")
    return sorted(f.base_name for f in
                  fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
                  if f.type == pafs.FileType.Directory)


def progress_rows(spark: SparkSession, path: str, batch: str, schema: T.StructType,
                  key: Sequence[str]) -> DataFrame:
    """What the tasks of a batch have finished, one row per key (that of the last
    attempt, should two attempts have asked for it)."""
    kind = T.StructType([*schema.fields, T.StructField("attempt_no", T.IntegerType())])
    rows = (spark.read.schema(kind).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").parquet(f"{path.rstrip('/')}/_progress/{batch}"))
    rest = [f.name for f in schema.fields if f.name not in key]
    last = F.max_by(F.struct(*rest), F.struct("attempt_no", F.xxhash64(F.to_json(F.struct(*rest)))))
    out = rows.groupBy(*key).agg(last.alias("_last"))
    return out.select(*[F.col("_last")[f.name].alias(f.name) if f.name in rest else F.col(f.name)
                        for f in schema.fields])


def forget(path: str, batch: str) -> None:
    """Remove the progress of a batch that is in the log."""
    fs, folder = filesystem(f"{path.rstrip('/')}/_progress/{batch}")
    if fs.get_file_info(folder).type == pafs.FileType.Directory:
        fs.delete_dir(folder)


def recovered(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str],
              append: Callable[[DataFrame, str], None], done: set[str]) -> list[str]:
    """Finish the lost rounds of a log: what their tasks had finished becomes a
    batch of the log (``append(rows, batch)``). ``done``: batches in the log
    already, whose progress only was not removed yet. Not to be called while
    another driver writes to the same log. Returns the batches appended."""
    out = []
    for batch in batches_in_progress(path):
        if batch not in done:
            append(progress_rows(spark, path, batch, schema, key), batch)
            out.append(batch)
        forget(path, batch)
    return out
