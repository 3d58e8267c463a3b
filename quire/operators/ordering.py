"""Distributed ordinals.

The source keeps order in lists and dicts; Spark has none, so order travels
as columns. A plain ``row_number()`` over an unpartitioned window runs in one
task, and over ``partitionBy(group)`` it puts a hot group in one task. The two
helpers below number rows in a range-partitioned, per-partition way instead:

1. ``repartitionByRange(n, order)`` + ``sortWithinPartitions`` (a hot group is
   split over several partitions by its order column);
2. ``monotonically_increasing_id`` gives (partition id << 33) + local offset;
3. a per-partition (or per partition-and-group) count table, whose size is
   bounded by the partition count (plus the group count), yields offsets;
4. offsets join back (AQE broadcasts the table when its measured size allows).

The range-sorted rows with their ids are written once with a reliable
``checkpoint()`` (in the shared ``spark.checkpoint.dir``): the count table and
the rows then read the same files, so partition bounds cannot differ between
the two branches, and an executor loss re-reads the checkpoint instead of
re-sampling the range bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOCAL_BITS = 33


def _n_parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _cols(cols) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in cols]


def _ranged(df: DataFrame, n: int, order_cols: list[Column]) -> DataFrame:
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)
    return ranged.withColumn("_pid", F.shiftrightunsigned(F.col("_mid"), _LOCAL_BITS))


def global_index(df: DataFrame, order: Sequence, col: str = "idx",
                 partitions: int | None = None) -> DataFrame:
    """Add a dense 0-based row number in ``order`` without a single-task window."""
    n = _n_parts(df, partitions)
    order_cols = _cols(order)
    ranged = _ranged(df, n, order_cols)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # At most `n` rows: one per range partition, so this window and the
    # broadcast below are bounded by the partition count, not by the data.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS)
    return (ranged.join(F.broadcast(offsets), on="_pid", how="inner")
            .withColumn(col, F.col("_off") + local)
            .drop("_mid", "_pid", "_off"))


def group_index(df: DataFrame, group: Sequence[str], order: Sequence, col: str = "idx_in_group",
                partitions: int | None = None) -> DataFrame:
    """Add a dense 0-based row number within each group, in ``order``.

    Equivalent to ``row_number() over (partition by group order by order) - 1``
    but a hot group is spread over several range partitions.
    """
    n = _n_parts(df, partitions)
    group = list(group)
    order_cols = _cols([*group, *order])
    ranged = _ranged(df, n, order_cols)
    # One row per (partition, group): a group spanning k partitions has k rows.
    stats = ranged.groupBy("_pid", *group).agg(F.min("_mid").alias("_first"),
                                               F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*group).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    # Fresh names on the stats side: it derives from `ranged`, and a self-join
    # on shared attribute ids would be ambiguous.
    renamed = {g: f"_g{i}" for i, g in enumerate(group)}
    stats = stats.select(F.col("_pid").alias("_spid"),
                         *[F.col(g).alias(renamed[g]) for g in group], "_first",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # Null-safe keys: a NULL group is a group too.
    cond = [F.col("_pid") == F.col("_spid")] + \
        [F.col(g).eqNullSafe(F.col(renamed[g])) for g in group]
    joined = ranged.join(stats, on=cond, how="inner")
    return joined.select(*df.columns,
                         (F.col("_off") + F.col("_mid") - F.col("_first")).alias(col))


def with_source_pos(df: DataFrame, col: str = "pos") -> DataFrame:
    """Ordinal from source order for a table read from one unsplit file (a
    multi-line CSV is never split): increasing in file order, not consecutive.
    Convert such inputs once to Parquet with this column and run from that.
    """
    return df.withColumn(col, F.monotonically_increasing_id())


def checkpoint_marks(log: DataFrame, order: Sequence, every: int, col: str = "is_checkpoint"
                     ) -> DataFrame:
    """Running count of log entries in ``order`` and whether a save falls on the
    entry (every ``every``-th one, the source's checkpoint cadence). The
    running count is a distributed ordinal, not a one-task window."""
    out = global_index(log, order, col="_idx")
    return (out.withColumn("running_count", F.col("_idx") + 1)
            .withColumn(col, (F.col("running_count") % F.lit(every)) == 0)
            .drop("_idx"))
