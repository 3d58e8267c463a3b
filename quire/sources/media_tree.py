"""Listing and writing of media folders by tasks; the driver looks at the root
alone."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from fnmatch import fnmatchcase

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.ledger import filesystem

#: Paths that leave a task together.
CHUNK = 10_000
ENTRIES = "path string, folder boolean, length long"
#: Folders that written files are spread over.
FOLDERS = 256


def media_tree(spark: SparkSession, root: str, pattern: str = "*.mp4", split_levels: int = 2,
               partitions: int | None = None) -> DataFrame:
    """The files below ``root`` whose name matches ``pattern``, as ``(media_id,
    media_path, length)``; ``media_id`` is the name up to its last dot. Contents
    are never read.

    The first ``split_levels`` levels are listed one after the other, with the
    folders dealt to tasks by a hash of their path between them, so a folder
    that holds most of the tree is spread by its subfolders; below, a task walks
    the folders it was given. Names that start with ``_`` or ``.`` are skipped,
    a folder that vanishes meanwhile is empty, and a missing root is an error.
    A task holds the names of one folder at a time.
    """
    root = root.rstrip("/") or "/"
    fs, top = filesystem(root)
    prefix = root.removesuffix(top)
    if fs.get_file_info(top).type != pafs.FileType.Directory:
        raise FileNotFoundError(f"{root}: no such folder")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def lister(deep: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            files, _ = filesystem(root)
            found = []
            for pdf in batches:
                yield pdf[~pdf["folder"]]
                todo = pdf.loc[pdf["folder"], "path"].tolist()
                while todo:
                    selector = pafs.FileSelector(todo.pop(), allow_not_found=True)
                    for info in files.get_file_info(selector):
                        folder = info.type == pafs.FileType.Directory
                        if info.base_name[:1] in ("_", "."):
                            continue
                        if folder and deep:
                            todo.append(info.path)
                        elif folder or fnmatchcase(info.base_name, pattern):
                            found.append((info.path, folder, 0 if folder else info.size))
                        if len(found) >= CHUNK:
                            yield pd.DataFrame(found, columns=["path", "folder", "length"])
                            found = []
            if found:
                yield pd.DataFrame(found, columns=["path", "folder", "length"])

        return run

    entries = spark.createDataFrame([(top, True, 0)], ENTRIES)
    for _ in range(split_levels):
        entries = entries.mapInPandas(lister(False), ENTRIES).repartition(n, F.xxhash64("path"))
    entries = entries.mapInPandas(lister(True), ENTRIES)
    return entries.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("media_id"),
                          F.concat(F.lit(prefix), "path").alias("media_path"), "length")


def write_media_tree(ids: DataFrame, root: str, partitions: int | None = None) -> None:
    """A Parquet file ``<id>.parquet`` with the id as its only value for every
    distinct non-null id of the one string column ``ids``, below ``root`` in
    folders by a hash of the id.

    Tasks write their own files, so no commit by the driver goes through them
    one by one. A file is there whole or not at all, and a task that runs again
    writes the same ones.
    """
    [col] = ids.columns
    n = partitions or int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fs, top = filesystem(root)
    fs.create_dir(top, recursive=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, _ = filesystem(root)
        made = set()
        for pdf in batches:
            for name, folder in zip(pdf[col], pdf["_folder"], strict=True):
                if folder not in made:
                    files.create_dir(f"{top}/{folder}", recursive=True)
                    made.add(folder)
                aside = f"{top}/{folder}/_{name}-{uuid.uuid4().hex[:8]}.writing"
                with files.open_output_stream(aside) as out:
                    pq.write_table(pa.table({"v": [name]}), out)
                files.move(aside, f"{top}/{folder}/{name}.parquet")
            yield pd.DataFrame({"n": [len(pdf)]})

    folder = F.lower(F.lpad(F.hex(F.pmod(F.xxhash64(col), F.lit(FOLDERS))), 2, "0"))
    own = ids.where(F.col(col).isNotNull()).distinct().repartition(n, col)
    own.withColumn("_folder", folder).mapInPandas(run, "n long").agg(F.sum("n")).collect()
