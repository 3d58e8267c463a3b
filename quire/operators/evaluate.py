"""Reports: progress, overlay counts, rewrite summary, run metrics, accuracy,
run comparison. All are aggregates (map-side partial) or key joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.replies import is_error
from quire.functions.text import minutes_seconds


def progress(questions: DataFrame, log: DataFrame, key: str = "qid",
             by: str | None = None) -> DataFrame:
    """Answered / total / ratio, per ``by`` group and overall (``by`` NULL)."""
    done = log.select(key).distinct().withColumn("_done", F.lit(True))
    q = questions.join(done, on=key, how="left")
    answered = F.count_if(F.coalesce(F.col("_done"), F.lit(False)))
    aggs = [F.count(F.lit(1)).alias("total"), answered.alias("answered")]
    grouped = q.rollup(by).agg(*aggs) if by else q.groupBy().agg(*aggs)
    return grouped.withColumn("ratio", F.round(F.col("answered") / F.col("total"), 6))


def overlay_counts(original: DataFrame, retry: DataFrame, key: str = "qid",
                   value_col: str = "prediction",
                   error_test: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row: ids in each log, original errors, updated by the retry, still
    failing after it, ids only in the retry log. Inputs deduped by key."""
    test = error_test or (lambda c: is_error(c))
    o = original.select(key, F.col(value_col).alias("_o"), F.lit(True).alias("_in_o"))
    r = retry.select(key, F.col(value_col).alias("_r"), F.lit(True).alias("_in_r"))
    j = o.join(r, on=key, how="full_outer")
    in_o = F.coalesce("_in_o", F.lit(False))
    in_r = F.coalesce("_in_r", F.lit(False))
    o_err = in_o & test(F.col("_o"))
    updated = o_err & in_r & ~test(F.col("_r"))
    return j.agg(
        F.count_if(in_o).alias("n_original"),
        F.count_if(in_r).alias("n_retry"),
        F.count_if(o_err).alias("n_original_errors"),
        F.count_if(updated).alias("n_updated"),
        F.count_if(o_err & ~updated).alias("n_still_failing"),
        F.count_if(~in_o & in_r).alias("n_retry_only"),
    )


def rewrite_summary(df: DataFrame, status_col: str = "rewrite_status") -> DataFrame:
    """Counts of changed / unchanged / empty rewrites; unchanged and empty
    count as failed (a correct "no change needed" is indistinguishable)."""
    s = F.col(status_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(s == "changed").alias("n_changed"),
        F.count_if(s == "unchanged").alias("n_unchanged"),
        F.count_if(s == "empty").alias("n_empty"),
        F.count_if(s != "changed").alias("n_failed"),
    )


def run_metrics(runlog: DataFrame, step: str = "step", seconds: str = "seconds") -> DataFrame:
    """Per step: calls, total / mean / max seconds, total as minutes and seconds."""
    agg = runlog.groupBy(step).agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.round(F.sum(seconds), 6).alias("total_s"),
        F.round(F.avg(seconds), 6).alias("avg_s"),
        F.round(F.max(seconds), 6).alias("max_s"),
    )
    mins, secs = minutes_seconds(F.col("total_s"))
    return agg.withColumn("total_min", mins.cast("long")).withColumn("total_sec", secs.cast("long"))


def accuracy(pred: DataFrame, truth: DataFrame, key: str = "qid", pred_col: str = "pred",
             truth_col: str = "truth", by: Sequence[str] = ()) -> DataFrame:
    """Share of answered questions whose prediction equals the truth.

    With ``by``, one row per value of each column plus the total
    (grouping sets); ``dimension`` names the column of the row.
    """
    t = truth.select(key, F.col(truth_col).alias("_truth"))
    j = pred.join(t, on=key, how="inner")
    correct = F.coalesce(F.col(pred_col) == F.col("_truth"), F.lit(False))
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(correct).alias("n_correct")]
    if not by:
        out = j.agg(*aggs)
    else:
        by = list(by)
        # One grouping set per column plus the grand total: one Expand and
        # one partial aggregate, not one job per column.
        sets = [[F.col(c)] for c in by] + [[]]
        g = j.groupingSets(sets, *by).agg(
            *aggs, *[F.grouping(c).alias(f"_g_{c}") for c in by])
        dim, val = F.lit("total"), F.lit(None).cast("string")
        for c in reversed(by):
            dim = F.when(F.col(f"_g_{c}") == 0, F.lit(c)).otherwise(dim)
            val = F.when(F.col(f"_g_{c}") == 0, F.col(c).cast("string")).otherwise(val)
        out = g.select(dim.alias("dimension"), val.alias("value"), "n", "n_correct")
    return out.withColumn("accuracy", F.round(F.col("n_correct") / F.col("n"), 6))


def compare_runs(run_a: DataFrame, run_b: DataFrame, key: str = "qid",
                 value_col: str = "prediction",
                 error_test: Callable[[Column], Column] | None = None) -> DataFrame:
    """Two runs side by side (deduped by key): one row per outcome with its count.

    Outcomes: ``agree``, ``changed``, ``a_error``, ``b_error``, ``both_error``,
    ``only_a``, ``only_b``.
    """
    test = error_test or (lambda c: is_error(c))
    a = run_a.select(key, F.col(value_col).alias("_a"), F.lit(True).alias("_in_a"))
    b = run_b.select(key, F.col(value_col).alias("_b"), F.lit(True).alias("_in_b"))
    j = a.join(b, on=key, how="full_outer")
    in_a = F.coalesce("_in_a", F.lit(False))
    in_b = F.coalesce("_in_b", F.lit(False))
    ea, eb = test(F.col("_a")), test(F.col("_b"))
    outcome = (F.when(~in_b, F.lit("only_a")).when(~in_a, F.lit("only_b"))
               .when(ea & eb, F.lit("both_error")).when(ea, F.lit("a_error"))
               .when(eb, F.lit("b_error"))
               .when(F.col("_a").eqNullSafe(F.col("_b")), F.lit("agree"))
               .otherwise(F.lit("changed")))
    return j.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
