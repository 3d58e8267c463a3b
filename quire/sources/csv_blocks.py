"""Multi-line CSV files read in parallel.

A newline ends a record only outside quotes, and whether a place is outside
quotes depends on every quote before it. But that is a parity: a first pass
counts quotes and newlines per block of a file (the newlines for both cases), a
running sum over the blocks says how each block begins and which record it
begins at, and a second pass cuts the blocks at their true record ends. A record
belongs to the block it starts in. Spark parses the records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.ledger import filesystem

BLOCK = 32 << 20
_QUOTE, _NEWLINE = 34, 10
_PARSE = {"escape": '"', "mode": "FAILFAST", "multiLine": "true",
          "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _inside(data: np.ndarray, inside: bool) -> np.ndarray:
    """For each byte whether it lies inside quotes, given that of the first."""
    return np.logical_xor.accumulate(data == _QUOTE) ^ inside if len(data) else data == _QUOTE


def block_counts(data: bytes) -> tuple[int, int, int]:
    """Quotes, and record ends if the block begins outside and inside quotes."""
    a = np.frombuffer(data, np.uint8)
    ends = a == _NEWLINE
    inside = _inside(a, False)
    return (int(np.count_nonzero(a == _QUOTE)), int(np.count_nonzero(ends & ~inside)),
            int(np.count_nonzero(ends & inside)))


def block_records(f, start: int, size: int, inside: bool, piece: int = 1 << 20
                  ) -> Iterator[tuple[int, bytes]]:
    """The records that start in a block: which of its record ends comes before
    each (0: the record at the block's first byte), and its bytes without the end.
    ``f`` is a file that can seek, ``inside`` whether the block begins in quotes."""
    f.seek(max(0, start - 1))
    before = f.read(1) if start else b"\n"
    data = f.read(size)
    a = np.frombuffer(data, np.uint8)
    within = _inside(a, inside)
    cuts = (np.flatnonzero((a == _NEWLINE) & ~within) + 1).tolist()
    begins = [(0, 0)] if not inside and before == b"\n" else []
    begins += [(k + 1, c) for k, c in enumerate(cuts) if c < len(data)]
    for i, (k, at) in enumerate(begins):
        if i + 1 < len(begins):
            yield k, data[at:begins[i + 1][1] - 1]
        elif cuts and cuts[-1] > at:
            yield k, data[at:cuts[-1] - 1]
        else:  # the last record ends in a later block
            parts, open_quote = [data[at:]], bool(within[-1])
            while more := f.read(piece):
                b = np.frombuffer(more, np.uint8)
                inner = _inside(b, open_quote)
                ends = np.flatnonzero((b == _NEWLINE) & ~inner)
                if len(ends):
                    parts.append(more[:int(ends[0])])
                    break
                parts.append(more)
                open_quote = bool(inner[-1])
            yield k, b"".join(parts)


def file_blocks(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """``file, start, inside, first`` of every block: where it starts, whether in
    quotes, and the number of record ends before it in all files (in the order of
    their names). A file whose quotes do not pair up fails the job."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(
        F.col("path").alias("file"), "length")
    starts = files.select("file", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("length") - 1, F.lit(block).cast("long"))).alias("start"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, start in zip(pdf["file"].tolist(), pdf["start"].tolist(), strict=True):
                fs, place = filesystem(name)
                with fs.open_input_file(place) as f:
                    f.seek(start)
                    yield pd.DataFrame([(name, start, *block_counts(f.read(block)))],
                                       columns=["file", "start", "quotes", "outer", "inner"])

    counts = _dealt(starts).mapInPandas(
        scan, "file STRING, start LONG, quotes LONG, outer LONG, inner LONG")
    # A few numbers per block: the sums run over short lists, a file's blocks each.
    in_file = Window.partitionBy("file").orderBy("start")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    blocks = counts.withColumn("inside", odd).withColumn(
        "ends", F.when(odd, F.col("inner")).otherwise(F.col("outer")))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
    # One more record per file: its last may have no end. One row per file here.
    totals = blocks.groupBy("file").agg((F.sum("ends") + 1).alias("n"), F.sum("quotes").alias("q"))
    names = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", F.coalesce(F.sum("n").over(names), F.lit(0)).alias("offset"), F.when(
        F.col("q") % 2 == 1, F.raise_error(F.concat(F.col("file"), F.lit(": quotes do not pair up"))))
        .cast("string").alias("fault"))
    return blocks.join(offsets, on="file").where("fault IS NULL").select(
        "file", "start", "inside", (F.col("offset") + F.col("before")).alias("first"),
        F.col("offset").alias("header"))


def _dealt(blocks: DataFrame) -> DataFrame:
    """Blocks spread over tasks: as many as the session's shuffle partitions."""
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(n, F.xxhash64("file", "start"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, block: int = BLOCK,
             pos: str = "pos") -> DataFrame:
    """The rows of CSV files with a header each, quoted fields with doubled quotes
    and newlines in them, read by several tasks a file; ``pos`` grows with the
    place of a row in its file and with the names of files (not consecutively
    where lines are empty). Records end with a newline, a carriage return before
    it is dropped. Values are parsed as by :func:`quire.sources.io.read_questions_csv`.
    A quote inside a field that is not quoted is not CSV: read such files unsplit.
    Files are UTF-8; empty lines and empty files have no rows. A task holds a block
    and one record at a time.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for b in pdf.itertuples(index=False):
                fs, place = filesystem(b.file)
                held, size = [], 0
                with fs.open_input_file(place) as f:
                    for k, record in block_records(f, b.start, block, bool(b.inside)):
                        text = record.removesuffix(b"\r")
                        if text and b.first + k != b.header:
                            held.append((b.first + k, text.decode("utf-8")))
                            size += len(text)
                        if size > 1 << 22:
                            yield pd.DataFrame(held, columns=["pos", "record"])
                            held, size = [], 0
                if held:
                    yield pd.DataFrame(held, columns=["pos", "record"])

    records = _dealt(file_blocks(spark, path, block)).mapInPandas(cut, "pos LONG, record STRING")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("record", ddl, _PARSE)
    return records.select(F.col("pos").alias("_at"), row.alias("_row")).select(
        *[F.col("_row")[f.name].alias(f.name) for f in schema.fields], F.col("_at").alias(pos))
