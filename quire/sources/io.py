"""Sources and sinks: question CSV, JSON-array tables, the answer log,
submission CSV, enriched JSON, templates and the media listing.

Schemas are always given (never inferred): ``qid`` such as ``0008-0`` must
stay text.
"""

from __future__ import annotations

import uuid
from contextlib import nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import py_strip
from quire.operators.ordering import global_index, with_source_pos
from quire.schemas import QUESTIONS_CSV
from quire.session import scratch_path

_INDEX_COLUMNS = ("_c0", "Unnamed: 0", "")


def read_questions_csv(spark: SparkSession, path: str, schema: T.StructType = QUESTIONS_CSV,
                       with_pos: bool = True) -> DataFrame:
    """Question table from CSV: quoted fields with doubled quotes and real
    newlines are kept as written (a literal backslash-n stays two characters).
    The unnamed index column is dropped. ``pos`` follows the order of rows in a
    file, and of several files by their names; a multi-line CSV is read
    unsplit, so convert it once to Parquet at scale.
    """
    df = (spark.read.schema(schema).option("header", True).option("multiLine", True)
          .option("escape", '"').option("mode", "FAILFAST")
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))
    df = df.drop(*[c for c in _INDEX_COLUMNS if c in df.columns])
    if not with_pos:
        return df
    if len(df.inputFiles()) < 2:
        return with_source_pos(df)
    # Spark packs files into tasks by size: order by name, then by place.
    placed = df.withColumn("_file", F.input_file_name()).withColumn(
        "_place", F.monotonically_increasing_id())
    return global_index(placed, ["_file", "_place"], col="pos").drop("_file", "_place")


def csv_schema(schema: T.StructType) -> T.StructType:
    """The reading schema of a CSV written by :func:`write_questions_csv`."""
    return T.StructType([T.StructField("_c0", T.StringType())] + list(schema.fields))


def write_questions_csv(df: DataFrame, path: str) -> None:
    """A question table as CSV with a leading index column (like the source
    files): quotes doubled, text with newlines quoted, whitespace kept."""
    out = df.select(F.lit("").alias("_c0"), *df.columns)
    (out.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("quoteAll", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType,
                    required: tuple[str, ...] = ("qid",)) -> DataFrame:
    """A table stored as JSON array files, read item by item
    (:mod:`quire.sources.json_array`). Items that are not objects, or whose values
    do not fit the schema, are skipped (``json_array.rejects`` lists them); a file
    that is not an array fails the job that reads it, and a schema without the
    required columns is an error.

    A JSON array file cannot be split, so each file is read by one task; at
    scale convert such inputs once to JSON lines or Parquet.
    """
    from quire.sources.json_array import json_items, parsed_items

    missing = [c for c in required if c not in schema.fieldNames()]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    items = parsed_items(json_items(spark, path), schema).where("reject IS NULL")
    return items.select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def _read_if_there(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


#: A compacted log's bases (:mod:`quire.sources.compact`): the last ``no`` counts,
#: and stands for the batches it covers.
BASES_SCHEMA = "no LONG, generation STRING, buckets INT, key STRING, covers ARRAY<STRING>"


def current_base(spark: SparkSession, path: str):
    """The row of the base a log has, or None."""
    bases = _read_if_there(spark, f"{path}/_bases", BASES_SCHEMA)
    return None if bases is None else bases.orderBy(F.desc("no")).first()


def open_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed batches of a log that its base does not cover (column
    ``batch``); None where nothing was committed."""
    commits = _read_if_there(spark, f"{path}/_commits", "batch STRING")
    if commits is None:
        return None
    base = current_base(spark, path)
    # Names of the rounds between two compactions: a short list.
    return (commits if base is None else commits.where(~F.col("batch").isin(base["covers"]))).distinct()


def committed_rows(spark: SparkSession, path: str, schema, base: bool = True) -> DataFrame:
    """The rows of the base (unless ``base`` is false) and of the batches since."""
    empty = spark.createDataFrame([], schema)
    out = empty
    last = current_base(spark, path) if base else None
    if last is not None:
        out = spark.read.schema(empty.schema).parquet(f"{path}/_base/{last['generation']}")
    commits = open_batches(spark, path)
    rows = None if commits is None else _read_if_there(
        spark, f"{path}/_rows", T.StructType([*empty.schema.fields,
                                              T.StructField("batch", T.StringType())]))
    if rows is None:
        return out
    done = rows.join(commits, on="batch", how="left_semi").select(*empty.columns)
    return done if last is None else out.unionByName(done)


def load_log(spark: SparkSession, path: str, schema, base: bool = True) -> DataFrame:
    """The answer log: the rows of all committed batches (of the base and the
    batches since, where the log was compacted; only of the latter with ``base``
    false), and of Parquet files that lie in the folder itself. A missing path is an empty log. A corrupt log fails loudly
    (re-answering everything silently would be worse)."""
    path = path.rstrip("/")
    flat = _read_if_there(spark, path, schema)
    if flat is None:
        return spark.createDataFrame([], schema)
    if _read_if_there(spark, f"{path}/_commits", "batch STRING") is None:
        return flat
    return flat.unionByName(committed_rows(spark, path, schema, base).select(*flat.columns))


def append_log(rows: DataFrame, path: str, batch: str | None = None, lock=None) -> None:
    """Append one batch to the log, wholly or not at all: its rows go to a folder
    of their own, and one more row in ``_commits`` (a single file) makes them
    part of the log. What a lost driver leaves behind is never read (the rows of
    a ``batch`` named again replace it). The rows are computed once, by the
    write itself. Threads that append to one log share a ``lock``: commits are
    added one after the other, as writers to one folder share temporary files."""
    spark, batch = rows.sparkSession, batch or uuid.uuid4().hex
    rows.write.mode("overwrite").parquet(f"{path}/_rows/batch={batch}")
    with lock or nullcontext():
        spark.createDataFrame([(batch,)], "batch STRING").coalesce(1) \
            .write.mode("append").parquet(f"{path}/_commits")


def committed(spark: SparkSession, path: str, batches: list[str]) -> set[str]:
    """Those of ``batches`` that are part of the log."""
    commits = _read_if_there(spark, f"{path}/_commits", "batch STRING") if batches else None
    if commits is None:
        return set()
    base = current_base(spark, path)
    found = {r[0] for r in commits.where(F.col("batch").isin(batches)).distinct().collect()}
    return found | (set(base["covers"]) & set(batches) if base else set())


def submission(predictions: DataFrame, key: str = "qid", value_col: str = "prediction",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """``qid, pred``: both stripped; a missing prediction is the empty string.
    ``keep`` carries extra columns (e.g. ``pos`` for the write order)."""
    return predictions.select(py_strip(F.col(key).cast("string")).alias("qid"),
                              F.coalesce(py_strip(value_col), F.lit("")).alias("pred"), *keep)


def write_submission(sub: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """CSV with header ``qid,pred``; empty strings are written as ``""``.
    With ``order`` the rows are range-sorted (input order) before writing."""
    out = sub.orderBy(*order) if order else sub
    (out.select("qid", "pred").write.mode("overwrite").option("header", True)
     .option("escape", '"').option("emptyValue", '""').csv(path))


def write_json_rows(df: DataFrame, path: str) -> None:
    """JSON lines with explicit nulls (Spark drops null fields by default)."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_template(spark: SparkSession, path: str) -> str:
    """A prompt template: read once on the driver (it becomes a literal)."""
    rows = spark.read.text(path, wholetext=True).collect()
    if len(rows) != 1:
        raise ValueError(f"{path}: expected one template file")
    return rows[0][0]


def media_files(spark: SparkSession, directory: str, pattern: str = "*.mp4",
                levels: int | None = None) -> DataFrame:
    """Listing of local media files as ``(media_id, media_path, length)``;
    only file metadata is read, never the content.

    The driver lists ``directory`` and holds all its files, each of them a piece
    of the scan. With ``levels`` tasks list it, and all folders below
    (:func:`quire.sources.media_tree.media_tree`, which deals the folders of the
    first ``levels`` levels); the listing is written once, for whatever reads it.
    """
    if levels is not None:
        from quire.sources.media_tree import media_tree

        path = scratch_path(spark, "media-files")
        files = media_tree(spark, directory, pattern, levels)
        files.write.parquet(path)
        return spark.read.schema(files.schema).parquet(path)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
             .select("path", "length"))
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return files.select(name.alias("media_id"), F.col("path").alias("media_path"), "length")


def attach_media(questions: DataFrame, media: DataFrame, video_col: str = "video_id") -> DataFrame:
    """Left join of questions with the media listing: ``media_path``, ``has_media``."""
    m = media.select(F.col("media_id").alias(video_col), "media_path")
    return (questions.join(m, on=video_col, how="left")
            .withColumn("has_media", F.col("media_path").isNotNull()))
