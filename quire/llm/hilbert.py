"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to a grid (equal-frequency cells),
each row gets its cell's index on a Hilbert curve through the grid, rows are
ordered by that index, and the order is cut into runs. Rows that are close in
every dimension land in the same run, so a reader that filters on any of the
dimensions skips most files by their min/max statistics.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, NumericType

from quire.operators.ordering import global_index

from .common import table

#: Cells per dimension: 2**BITS.
BITS = 4


def as_number(df: DataFrame, name: str) -> Column:
    """A dimension as a number that keeps its order: numbers as they are, other
    types by the first six bytes of their text. NULL is below everything."""
    if isinstance(df.schema[name].dataType, NumericType):
        value = F.col(name).cast(DoubleType())
    else:
        head = F.rpad(F.substring(F.encode(F.col(name).cast("string"), "UTF-8"), 1, 6),
                      6, F.lit(b"\x00"))
        value = F.conv(F.hex(head), 16, 10).cast(DoubleType())
    return F.when(value.isNotNull() & ~F.isnan(value), value).otherwise(F.lit(-1e300))


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each point of a grid of 2**bits cells per
    dimension (undo the rotations level by level, then Gray-decode)."""
    x = [c.astype(np.int64).copy() for c in cells]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x = [c ^ t for c in x]
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def with_hilbert(df: DataFrame, dims: list[str], bits: int = BITS, col: str = "hilbert"
                 ) -> DataFrame:
    """Add the curve index over ``dims``. The cell bounds are 2**bits - 1
    quantiles per dimension over all rows (one aggregate; a few numbers reach
    the driver)."""
    if bits * len(dims) > 62:
        raise ValueError("bits * dimensions must stay below 63")
    numbers = [as_number(df, d) for d in dims]
    grades = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.select(*[F.percentile_approx(v, grades, 10_000).alias(f"q{i}")
                       for i, v in enumerate(numbers)]).first()
    bounds = [np.unique(np.array(c if c is not None else [], dtype=float)) for c in cuts]

    @F.pandas_udf("long")
    def index(*values: pd.Series) -> pd.Series:
        cells = [np.searchsorted(b, v.to_numpy(dtype=float), side="right")
                 for b, v in zip(bounds, values, strict=True)]
        return pd.Series(hilbert_index(cells, bits))

    return df.withColumn(col, index(*numbers))


def shard_rows(df: DataFrame, dims: list[str], shards: int = 16, bits: int = BITS,
               tie: list[str] | None = None) -> DataFrame:
    """Add ``hilbert``, ``shard`` (0 .. shards-1; row counts at most one apart)
    and ``slot`` (gapless from 0 in each shard): runs of the curve order, ties
    in the order of ``tie``. Rows equal in all of these are interchangeable. An
    empty table gives an empty table."""
    ordered = global_index(with_hilbert(df, dims, bits), ["hilbert", *(tie or [])], col="_at")
    n = df.count()
    shard = F.expr(f"_at * {shards} div {max(n, 1)}")
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return (ordered.withColumn("shard", shard).withColumn("slot", F.col("_at") - first)
            .withColumn("shard", F.col("shard").cast("int")).drop("_at"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order; a shard may be many files."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op3_hilbert(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, law ``rows``, by a curve through text size,
    language, source and id. NULL text: size 1, crc32 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = shard_rows(docs, ["size", "lang", "source", "doc_id"], 16,
                     tie=["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "hilbert")
