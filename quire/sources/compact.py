"""Compaction of an answer log.

A log grows by a batch folder and a commit file per round, and by a row per try.
:func:`compact` merges everything committed so far by key into one base table,
bucketed by the key, which takes the place of the batches it covers. So reading
a log costs what its ids cost, however many rounds it has seen, and a join of
ids with the base needs no shuffle of the base.

``<log>/_base/<generation>``  the rows of a base, one file per bucket
``<log>/_bases``              a row per base: the last one counts
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.replies import is_error
from quire.operators import ledger as led
from quire.operators import resume as rs
from quire.sources import io


def settled(log: DataFrame, key: str = "qid", value_col: str = "prediction",
            run_col: str = "run_id", order: str = "seq",
            error_test: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of a log that decide what is read from it, at most four per key:
    the first and the last row of the key's first round, and the last rows of its
    first round without an error and of its last round. ``rs.overlay_runs``,
    ``rs.unanswered`` and the number of the next round come out as from all rows;
    counts and times per round do not."""
    test = error_test or is_error
    row = F.struct(*log.columns)
    rounds = log.groupBy(key, run_col).agg(F.min_by(row, order).alias("_a"),
                                           F.max_by(row, order).alias("_z"))
    at = F.col(run_col)
    good = F.when(~F.coalesce(test(F.col("_z")[value_col]), F.lit(False)), at)
    kept = rounds.groupBy(key).agg(
        F.min_by("_a", at).alias("_1"), F.min_by("_z", at).alias("_2"),
        F.min_by("_z", good).alias("_3"), F.max_by("_z", at).alias("_4"))
    each = F.array_distinct(F.filter(F.array("_1", "_2", "_3", "_4"), lambda r: r.isNotNull()))
    return kept.select(F.explode(each).alias("_r")).select(
        *[F.col("_r")[c].alias(c) for c in log.columns])


def compact(spark: SparkSession, path: str, schema: str, key: str = "qid",
            buckets: int | None = None, merge: Callable[[DataFrame], DataFrame] = settled) -> None:
    """Put one base table in the place of all batches committed so far.

    The base becomes the log's by one row in ``_bases``: a driver that is lost
    before leaves files nobody reads, and the log as it was. Batches that the
    base before this one covered are removed first, as no reader needs them since
    (a query over the log that began before that base was made has to end before).
    ``merge`` says which rows of the log are kept. One driver writes to a log at a
    time. ``buckets``: by default one per shuffle partition.
    """
    path = path.rstrip("/")
    sweep(spark, path)
    commits = io.open_batches(spark, path)
    if commits is None:
        return
    covers = sorted(r[0] for r in commits.collect())  # the rounds since the last base
    if not covers:
        return
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = io.current_base(spark, path)
    generation = uuid.uuid4().hex
    rows = io.committed_rows(spark, path, schema)
    # Dealt once by the key: the merge and the buckets need no other shuffle.
    (merge(rows.repartition(n, key)).write.bucketBy(n, key).sortBy(key)
     .option("path", f"{path}/_base/{generation}").saveAsTable(_table(generation)))
    swap(spark, path, (last["no"] + 1 if last else 0, generation, n, key, covers))


def swap(spark: SparkSession, path: str, base: tuple) -> None:
    """Make a written base the log's."""
    spark.createDataFrame([base], io.BASES_SCHEMA).coalesce(1) \
        .write.mode("append").parquet(f"{path}/_bases")


def sweep(spark: SparkSession, path: str) -> None:
    """Remove what the current base has replaced: the batches it covers with their
    commits, and older bases. Batches whose progress is not forgotten yet stay."""
    base = io.current_base(spark, path)
    if base is None:
        return
    fs, folder = led.filesystem(path)
    gone = set(base["covers"]) - set(led.batches_in_progress(path))
    for info in fs.get_file_info(pafs.FileSelector(f"{folder}/_commits", allow_not_found=True)):
        if info.base_name.endswith(".parquet"):
            with fs.open_input_file(info.path) as f:
                batches = set(pq.read_table(f).column("batch").to_pylist())
            if batches <= gone:
                fs.delete_file(info.path)
    for info in fs.get_file_info(pafs.FileSelector(f"{folder}/_rows", allow_not_found=True)):
        if info.base_name.removeprefix("batch=") in gone:
            fs.delete_dir(info.path)
    for info in fs.get_file_info(pafs.FileSelector(f"{folder}/_base", allow_not_found=True)):
        if info.base_name != base["generation"]:
            fs.delete_dir(info.path)


def _table(generation: str) -> str:
    return f"log_base_{generation}"


def base_table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The base of a log as a table bucketed by its key; None without a base."""
    path = path.rstrip("/")
    base = io.current_base(spark, path)
    if base is None:
        return None
    name = _table(base["generation"])
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (`{base['key']}`) "
                  f"SORTED BY (`{base['key']}`) INTO {base['buckets']} BUCKETS "
                  f"LOCATION '{path}/_base/{base['generation']}'")
    return spark.table(name)


def unanswered(spark: SparkSession, questions: DataFrame, path: str, schema: str,
               key: str = "qid") -> DataFrame:
    """``rs.unanswered`` against a log: its base, where it has one, is joined bucket
    by bucket, only the ids asked about and the batches since are shuffled."""
    base = base_table(spark, path, schema)
    todo = questions if base is None else rs.unanswered(questions, base, key=key)
    return rs.unanswered(todo, io.load_log(spark, path, schema, base=False), key=key)
