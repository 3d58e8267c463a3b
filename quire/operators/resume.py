"""Resume and retry over answer logs.

A log is an append-only table keyed by ``qid`` with an order column
(``seq``, optionally ``pass_idx``). Nothing here collects to the driver:
every operator is a join or a partial aggregate, so a hot key (one id holding
a third of the log) is folded map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.replies import is_error

# Lists of ids given on the driver up to this size become an IN list (which can
# be pushed to the scan); longer ones become a table and are semi-joined.
MAX_INLINE_IDS = 1000


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def unanswered(questions: DataFrame, log: DataFrame, key="qid") -> DataFrame:
    """Rows of ``questions`` whose key does not occur in ``log`` (left anti).

    Only the key columns of the log are read, so the scan is pruned; the
    join strategy (broadcast when the log is small at run time, sort-merge
    otherwise) is left to AQE.
    """
    keys = _keys(key)
    return questions.join(log.select(*keys), on=keys, how="left_anti")


def only_ids(df: DataFrame, ids, key="qid") -> DataFrame:
    """Keep the rows whose key is in ``ids``.

    ``None`` means no filter; an empty collection means no rows. ``ids`` may be
    a DataFrame (left semi join) or a driver-side collection of any length.
    """
    keys = _keys(key)
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(*keys), on=keys, how="left_semi")
    ids = list(ids)
    if len(keys) != 1:
        raise ValueError("a driver-side id list needs a single key column")
    if len(ids) > MAX_INLINE_IDS:
        kind = df.schema[keys[0]]
        table = df.sparkSession.createDataFrame([(i,) for i in set(ids)], T.StructType([kind]))
        return df.join(table, on=keys, how="left_semi")
    if not ids:
        return df.limit(0)
    return df.filter(F.col(keys[0]).isin(ids))


def latest(log: DataFrame, key="qid", order: Sequence[str] = ("seq",),
           values: Sequence[str] | None = None, first_col: str = "first_seq",
           count_col: str | None = None) -> DataFrame:
    """Last-wins dedupe: one row per key with the values of its greatest
    ``order`` and the first value of ``order[-1]`` (log order of first
    appearance). ``max_by``/``min`` are partial aggregates.
    """
    keys = _keys(key)
    order = list(order)
    if values is None:
        values = [c for c in log.columns if c not in keys and c not in order]
    ord_col = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    val_col = F.struct(*[F.col(c) for c in values])
    aggs = [F.max_by(val_col, ord_col).alias("_v"), F.min(order[-1]).alias(first_col)]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = log.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[F.col("_v")[c].alias(c) for c in values],
                      first_col, *([count_col] if count_col else []))


def error_ids(log: DataFrame, value_col: str = "prediction", key="qid",
              mode: str = "taxonomy") -> DataFrame:
    """Distinct keys whose (latest) value is an error."""
    keys = _keys(key)
    return log.filter(is_error(value_col, mode)).select(*keys).distinct()


def overlay(original: DataFrame, retry: DataFrame, key="qid", value_col: str = "prediction",
            error_test: Callable[[Column], Column] | None = None, add_new: bool = False,
            order_col: str = "first_seq") -> DataFrame:
    """Retry overlay of two deduped logs (one row per key on each side).

    The retry value replaces the original only when the original is an error
    and the retry value is not. Keys only in ``retry`` are dropped, or added
    when ``add_new=True``. ``order_col`` keeps the original log order (retry
    order for added keys). Output: keys, value, ``source``, order column.
    """
    keys = _keys(key)
    test = error_test or (lambda c: is_error(c))
    o = original.select(*keys, F.col(value_col).alias("_o"), F.col(order_col).alias("_oo"))
    r = retry.select(*keys, F.col(value_col).alias("_r"), F.col(order_col).alias("_ro"),
                     F.lit(True).alias("_in_r"))
    joined = o.withColumn("_in_o", F.lit(True)).join(r, on=keys,
                                                     how="full_outer" if add_new else "left")
    in_o = F.coalesce(F.col("_in_o"), F.lit(False))
    in_r = F.coalesce(F.col("_in_r"), F.lit(False))
    replace = in_o & in_r & test(F.col("_o")) & ~test(F.col("_r"))
    source = (F.when(~in_o, F.lit("retry_only"))
              .when(replace, F.lit("retry"))
              .otherwise(F.lit("original")))
    value = F.when(~in_o | replace, F.col("_r")).otherwise(F.col("_o"))
    return joined.select(*keys, value.alias(value_col), source.alias("source"),
                         F.coalesce(F.col("_oo"), F.col("_ro")).alias(order_col))


def overlay_runs(log: DataFrame, key="qid", value_col: str = "prediction",
                 run_col: str = "run_id", original: int | None = 0, order: str = "seq",
                 error_test: Callable[[Column], Column] | None = None, add_new: bool = False,
                 order_col: str = "first_seq", won_col: str | None = None) -> DataFrame:
    """:func:`overlay` of any number of rounds stored in one log.

    A round's value is that of its greatest ``order``; rounds apply one after
    the other by ``run_col``, so an error gives way to the first later round
    that is none. The original is the round ``original`` (an id without it is
    dropped, or added when ``add_new``), or with ``None`` the first round an id
    occurs in. ``won_col`` names an output column for the round that won.
    ``order`` need only grow within a round.
    """
    keys = _keys(key)
    test = error_test or (lambda c: is_error(c))
    rounds = log.groupBy(*keys, run_col).agg(
        F.max_by(F.struct(F.col(value_col).alias("v")), F.col(order)).alias("_v"),
        F.min(order).alias("_s"))
    value = F.col("_v")["v"]
    good = F.when(~test(value), F.col(run_col))
    at = F.col(run_col)
    agg = rounds.groupBy(*keys).agg(
        F.min_by("_v", at).alias("_first"), F.min_by("_s", at).alias("_fs"), F.min(at).alias("_fr"),
        F.min_by("_v", good).alias("_good"), F.min(good).alias("_gr"))
    in_o = F.lit(True) if original is None else F.col("_fr") == F.lit(original)
    replace = test(F.col("_first")["v"]) & F.col("_gr").isNotNull()
    source = (F.when(~in_o, F.lit("retry_only"))
              .when(replace, F.lit("retry")).otherwise(F.lit("original")))
    out = agg if add_new or original is None else agg.filter(in_o)
    picked = F.when(replace, F.col("_good")).otherwise(F.col("_first"))["v"]
    won = [] if won_col is None else [
        F.when(replace, F.col("_gr")).otherwise(F.col("_fr")).alias(won_col)]
    return out.select(*keys, picked.alias(value_col), source.alias("source"),
                      F.col("_fs").alias(order_col), *won)


def complete(expected: DataFrame, results: DataFrame, key="qid", value_col: str = "prediction",
             placeholder: Column | None = None) -> DataFrame:
    """Every expected key gets one row; a missing result becomes ``placeholder``.

    ``results`` must hold one row per key (use :func:`latest` first).
    """
    keys = _keys(key)
    res = results.select(*keys, F.col(value_col).alias("_val"), F.lit(True).alias("_hit"))
    fill = placeholder if placeholder is not None else F.lit(None)
    joined = expected.join(res, on=keys, how="left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return (joined.withColumn(value_col, F.when(hit, F.col("_val")).otherwise(fill))
            .withColumn("is_filled", ~hit).drop("_val", "_hit"))


def to_input_order(questions: DataFrame, predictions: DataFrame, key="qid",
                   value_col: str = "prediction", pos: Sequence[str] = ("pos",),
                   sort: bool = True) -> DataFrame:
    """Lay predictions on the question table: one row per question row (question
    duplicates are kept), NULL when missing, unknown ids dropped, ordered by
    ``pos`` (a range-partitioned sort, so no single task holds the table).
    ``predictions`` must be deduped by key already.
    """
    keys = _keys(key)
    out = questions.join(predictions.select(*keys, value_col), on=keys, how="left")
    return out.orderBy(*pos) if sort else out


def append_log(log: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Bag union of a log and a new batch (columns matched by name)."""
    return batch if log is None else log.unionByName(batch, allowMissingColumns=True)


__all__: Iterable[str] = [
    "unanswered", "only_ids", "latest", "error_ids", "overlay", "overlay_runs", "complete",
    "to_input_order", "append_log",
]
