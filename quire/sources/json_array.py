"""JSON-array files read item by item.

An array cannot be split without reading it from its start, so a file is the
unit of work; but no task holds more of one than the item it is at. A task walks
its file piece by piece and hands on each item's text with its place; Spark
parses the texts by the schema.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.ledger import filesystem

ITEM_SCHEMA = "file STRING, pos LONG, item STRING, is_object BOOLEAN"
PIECE = 1 << 20
#: The longest item, in characters, that a task will hold; a longer one is an
#: error and not dropped (Arrow and Spark hold a text of at most 2 GB).
MAX_ITEM = 1 << 28
_NUMBER_GOES_ON = (".", "e", "E", "e+", "e-", "E+", "E-")
_BLANK = " \t\r\n"


def array_items(read, piece: int = PIECE, longest: int = MAX_ITEM) -> Iterator[tuple[str, bool]]:
    """The items of a JSON array in UTF-8, each as its text and whether it is an
    object. ``read(n)`` gives the next bytes, at most ``n`` of them. ValueError
    where the bytes are no array: what was found before has been given by then."""
    decode = codecs.getincrementaldecoder("utf-8-sig")().decode
    scan = json.JSONDecoder().raw_decode
    text, at, ended = "", 0, False

    def more(size: int) -> bool:
        """Drop what was read and append a piece; False at the end of the file."""
        nonlocal text, at, ended
        if ended:
            return False
        data = read(size)
        ended = not data
        text, at = text[at:] + decode(data, ended), 0
        return True

    def mark() -> str:
        """The next character that is not blank ('' at the end)."""
        nonlocal at
        while True:
            while at < len(text) and text[at] in _BLANK:
                at += 1
            if at < len(text):
                return text[at]
            if not more(piece):
                return ""

    if mark() != "[":
        raise ValueError("not a JSON array")
    at += 1
    if mark() == "]":
        at += 1
    else:
        while True:
            opening, size = mark(), piece
            while True:
                try:
                    end = scan(text, at)[1]
                    # A number at the end of a piece may go on in the next, and so
                    # may its fraction or exponent that has begun.
                    if ended or end < len(text) and text[end:end + 3] not in _NUMBER_GOES_ON:
                        break
                except (json.JSONDecodeError, RecursionError) as exc:
                    if ended or isinstance(exc, RecursionError):
                        raise ValueError(f"not a JSON array: {exc}") from None
                if len(text) - at > longest:
                    raise ValueError(f"an item of over {longest} characters")
                more(size)
                size = max(piece, len(text))  # doubles: a long item is scanned a few times only
            yield text[at:end], opening == "{"
            at = end
            sign = mark()
            at += 1
            if sign == "]":
                break
            if sign != ",":
                raise ValueError("not a JSON array: no comma between items")
    if mark():
        raise ValueError("not a JSON array: text after its end")


def json_items(spark: SparkSession, path: str, piece: int = PIECE, longest: int = MAX_ITEM,
               batch_chars: int = 1 << 22) -> DataFrame:
    """Every item of the JSON-array files under ``path``: ``file, pos`` (from 0),
    ``item`` (its text), ``is_object``. One task per file at most; empty arrays
    have no rows; a file that is no array fails the job with its name."""
    files = spark.read.format("binaryFile").load(path).select("path")
    # One file a partition where there are enough: the list is short, the files long.
    files = files.repartition(max(1, min(len(files.inputFiles()), 10_000)), "path")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name in (n for pdf in batches for n in pdf["path"].tolist()):
            fs, place = filesystem(name)
            held, chars = [], 0
            with fs.open_input_stream(place) as f:
                items = enumerate(array_items(f.read, piece, longest))
                while True:
                    try:
                        pos, (item, is_object) = next(items)
                    except StopIteration:
                        break
                    except ValueError as exc:
                        raise ValueError(f"{name}: {exc}") from None
                    held.append((name, pos, item, is_object))
                    chars += len(item)
                    if chars >= batch_chars or len(held) >= 10_000:
                        yield _frame(held)
                        held, chars = [], 0
            if held:
                yield _frame(held)

    return files.mapInPandas(walk, ITEM_SCHEMA)


def _frame(held: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(held, columns=["file", "pos", "item", "is_object"])


def parsed_items(items: DataFrame, schema: T.StructType) -> DataFrame:
    """:func:`json_items` with the parsed record ``r`` and ``reject``: why an item
    is no row (``not an object``, ``wrong type``: a value does not fit the schema),
    NULL for those that are."""
    corrupt = "_corrupt_record"
    s = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
    r = F.from_json("item", s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    out = items.withColumn("r", F.when(F.col("is_object"), r))
    return out.withColumn("reject", F.when(~F.col("is_object"), F.lit("not an object")).when(
        F.col("r").isNull() | F.col(f"r.{corrupt}").isNotNull(), F.lit("wrong type")))


def rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The items that :func:`quire.sources.io.read_json_array` skips, with file,
    place, text and reason."""
    return parsed_items(json_items(spark, path), schema).where("reject IS NOT NULL").select(
        "file", "pos", "item", "reject")
