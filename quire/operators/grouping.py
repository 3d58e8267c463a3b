"""Grouping questions by media (video) and batching groups.

Groups are never gathered into one row: a group's questions stay rows, and
per-group facts are partial aggregates. Ordered batch numbers use the
distributed ordinals of :mod:`quire.operators.ordering`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions._cols import as_col
from quire.functions.text import py_strip
from quire.operators.ordering import global_index, group_index


def group_key(url, normalize: bool = True) -> Column:
    """Grouping key of a media URL: stripped by default (a trailing space must
    not split one video in two); the raw value when ``normalize=False``."""
    return py_strip(url) if normalize else as_col(url)


def group_summary(df: DataFrame, key: str, pos: str = "pos", qid: str = "qid") -> DataFrame:
    """One row per group: question count, first / last position, first id."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.min(pos).alias("first_pos"),
        F.max(pos).alias("last_pos"),
        F.min_by(qid, pos).alias("first_qid"),
    )


def first_of_group(df: DataFrame, key: str, pos: str, cols: Sequence[str],
                   count_col: str | None = None) -> DataFrame:
    """Values of the first row (smallest ``pos``) of each group, optionally
    with the group's row count (same aggregate, no second shuffle)."""
    aggs = [F.min_by(F.struct(*cols), pos).alias("_first")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(key).agg(*aggs).select(
        key, *[F.col("_first")[c].alias(c) for c in cols], *([count_col] if count_col else []))


def order_groups(df: DataFrame, key: str, pos: str = "pos", qid: str = "qid",
                 col: str = "group_order") -> DataFrame:
    """Groups in first-appearance order: summary rows plus a dense ordinal."""
    return global_index(group_summary(df, key, pos, qid), ["first_pos", key], col=col)


def batches(df: DataFrame, key: str, batch_size: int, pos: str = "pos", qid: str = "qid",
            ordered: bool = True, n_batches: int | None = None) -> DataFrame:
    """Batches of ``batch_size`` groups (``ceil(groups / k)`` batches).

    ``ordered=True`` numbers groups by first appearance; otherwise a hash of
    the key spreads groups over ``n_batches`` without any ordering step.
    """
    if ordered:
        g = order_groups(df, key, pos, qid)
        g = g.withColumn("batch_idx", F.floor(F.col("group_order") / F.lit(batch_size)))
        # Groups per batch: one row per batch, joined back on the batch number.
        sizes = g.groupBy("batch_idx").agg(F.count(F.lit(1)).alias("n_in_batch"))
        return g.join(sizes, on="batch_idx", how="inner")
    if not n_batches:
        raise ValueError("unordered batches need n_batches")
    g = group_summary(df, key, pos, qid)
    return g.withColumn("batch_idx", F.pmod(F.xxhash64(key), F.lit(n_batches)))


def index_in_group(df: DataFrame, key: str, pos: str = "pos",
                   col: str = "idx_in_group") -> DataFrame:
    """Position of each question within its group (0-based, by ``pos``)."""
    return group_index(df, [key], [pos], col=col)


def repeat_passes(df: DataFrame, n: int, col: str = "pass_idx") -> DataFrame:
    """Each question ``n`` times, ``pass_idx`` 0..n-1."""
    return df.withColumn(col, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def spread_for_inference(df: DataFrame, key: str, partitions: int, salt_on: str = "qid"
                         ) -> DataFrame:
    """Deal questions to ``partitions`` tasks for the model call.

    One hash shuffle on the group and the id, so tasks are even whatever the
    groups' sizes (one may hold a third of all rows, or be the rows without a
    group); within a task a group's rows stand together. Nothing is sized or
    sampled first: the input is read once.
    """
    return (df.repartition(partitions, F.xxhash64(F.col(key)), F.xxhash64(salt_on))
            .sortWithinPartitions(key))
