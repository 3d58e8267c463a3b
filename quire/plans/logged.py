"""Runs over logs of their own: rewrites that resume, and the retry of an old run."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.replies import context_failed
from quire.functions.text import (bullet_list, clean_rewrite, context_chunks, py_strip,
                                  rewrite_or_fallback, rewrite_status)
from quire.operators import infer as inf
from quire.operators import resume as rs
from quire.operators.enrich import enrich, validate_rows
from quire.operators.responders import ContextResponder, GoesDown, RewriteResponder
from quire.plans import runs
from quire.plans import shapes as sh
from quire.session import scratch_path
from quire.sources import io

REWRITE_LOG_SCHEMA = ("run_id INT, seq LONG, qid STRING, "
                      "prediction STRUCT<rewrite: STRING, error: STRING>")


def rewrite_rows(out: DataFrame, run_id: int) -> DataFrame:
    """Output of ``infer`` as rows of the rewrite log: the cleaned rewrite, or what
    failed the call."""
    return out.select(
        F.lit(run_id).alias("run_id"), F.monotonically_increasing_id().alias("seq"), "qid",
        F.struct(clean_rewrite("reply").alias("rewrite"), "error").alias("prediction"))


def current_rewrites(spark: SparkSession, log_path: str) -> DataFrame:
    """The rewrite of each id after all rounds of the log."""
    log = io.load_log(spark, log_path, REWRITE_LOG_SCHEMA)
    return rs.overlay_runs(log, key="qid", value_col="prediction", original=None,
                           error_test=lambda p: p["error"].isNotNull())


def checked_items(items: DataFrame) -> DataFrame:
    """``items`` (qid, conv_id, question, context, ..) with the stripped question
    ``q``, the context's ``chunks``, the ``skip_reason`` of those that are not
    asked, and the ``prompt``."""
    from quire.functions.prompts import REWRITE_TEMPLATE, render

    checked = validate_rows(items.withColumn("q", py_strip("question")), question="q",
                            context="context").withColumn("chunks", context_chunks("context"))
    return checked.withColumn(
        "prompt", render(REWRITE_TEMPLATE, context=bullet_list("chunks"), question=F.col("q")))


def rewrite_round(spark: SparkSession, items: DataFrame, log_path: str, responder_factory,
                  failed_only: bool = False, retry: tuple = inf.BACKOFF_REWRITE,
                  save: tuple[int, float] = (50, 60.0)) -> None:
    """Ask for the rewrites of those ``items`` that can be asked and that the log
    lacks, or whose call failed in all rounds so far (``failed_only``)."""
    asked = checked_items(items).where("skip_reason IS NULL").select("qid", "conv_id", "prompt")
    ids = None
    if failed_only:
        ids = current_rewrites(spark, log_path).where("prediction.error IS NOT NULL").select("qid")
    runs.logged_round(spark, asked, log_path, REWRITE_LOG_SCHEMA, responder_factory, rewrite_rows,
                      ids, retry=retry, save=save)


def rewritten(spark: SparkSession, items: DataFrame, log_path: str,
              carry: tuple[str, ...] = ("youtube_url", "video_id")) -> DataFrame:
    """Every one of ``items`` with what the log has for it: qid, ``carry`` columns,
    question, skip_reason, context (its chunks), corrected_question,
    rewrite_status, error. An item that was skipped, failed or not asked yet
    (status ``skipped``, ``error``, ``pending``) keeps its question."""
    p = F.col("prediction")
    out = checked_items(items).join(current_rewrites(spark, log_path).select("qid", "prediction"),
                                    on="qid", how="left")
    status = (F.when(F.col("skip_reason").isNotNull(), F.lit("skipped"))
              .when(p.isNull(), F.lit("pending"))
              .when(p["error"].isNotNull(), F.lit("error"))
              .otherwise(rewrite_status(p["rewrite"], "q")))
    return out.select(
        "qid", *carry, F.col("q").alias("question"), "skip_reason", F.col("chunks").alias("context"),
        rewrite_or_fallback(p["rewrite"], "q").alias("corrected_question"),
        status.alias("rewrite_status"), p["error"].alias("error"))


def rewrite_resume(spark: SparkSession, sf_dir: str, log_path: str | None = None,
                   retry: tuple = runs.NO_RETRY) -> DataFrame:
    """Rewrites of all questions by a run that is lost on its way, begun again,
    and then once more for the calls that failed. The first model goes down at
    some prompts; the second refuses some for good; the third answers."""
    from quire.operators.responders import FailingResponder, prompt_digest

    log_path = log_path or scratch_path(spark, "rewrite-log")
    items = sh.questions(spark, sf_dir).join(sh.answers(spark, sf_dir), on="qid", how="left").select(
        "qid", "conv_id", "question", F.col("answer").alias("context"),
        F.concat(F.lit("https://v/"), F.col("conv_id").cast("string")).alias("youtube_url"),
        F.col("conv_id").cast("string").alias("video_id"))
    model = RewriteResponder(runs.REWRITE_START, runs.REWRITE_END)
    try:
        rewrite_round(spark, items, log_path,
                      GoesDown(model, lambda p: prompt_digest(p)[5] == "7"), retry=retry,
                      save=(1, 0.0))
    except PySparkException as exc:
        if GoesDown.MESSAGE not in str(exc):
            raise
    rewrite_round(spark, items, log_path, FailingResponder(model), retry=retry)
    rewrite_round(spark, items, log_path, model, failed_only=True, retry=retry)
    return rewritten(spark, items, log_path)


def retry_old_run(spark: SparkSession, old_log: DataFrame, questions: DataFrame,
                  responder_factory, log_path: str, retry: tuple = inf.BACKOFF_CONTEXT,
                  order: str = "seq") -> DataFrame:
    """Ask again for the contexts that failed in an old run, given by its log
    alone: ``old_log`` (qid, prediction, ``order``), where the last row of an id
    counts. Only questions that the old log has as failed are asked, into a log of
    this retry (``log_path``; a retry that was lost resumes there). A new context
    replaces a failed one unless it failed too. Every question comes back with
    the context it has now and whether it was asked again; those that the old
    run had not reached have none.
    """
    from quire.functions.prompts import CONTEXT_TEMPLATE, render

    old = rs.latest(old_log, key="qid", order=(order,), values=("prediction",))
    failed = old.where(context_failed(F.col("prediction")["context"])).select("qid")
    q = questions.select("qid", "conv_id",
                         render(CONTEXT_TEMPLATE, question=py_strip("question")).alias("prompt"))
    runs.logged_round(spark, rs.only_ids(q, failed), log_path, runs.CONTEXT_LOG_SCHEMA,
                      responder_factory, runs.context_rows(retry[2]), retry=retry)
    new = runs.current_contexts(spark, log_path).select("qid", "prediction", "first_seq")
    merged = rs.overlay(old, new, error_test=lambda p: context_failed(p["context"]))
    # The old log's ids of other questions are left out by the left enrichment.
    out = enrich(questions.select("qid", "conv_id", "turn"), merged.select("qid", "prediction"),
                 key="qid", how="left", question=None, prompt=None)
    asked = new.select("qid", F.lit(True).alias("asked"))
    return out.join(asked, on="qid", how="left").select(
        "qid", "conv_id", "turn", "context", "is_contextual", "explanation",
        F.coalesce("asked", F.lit(False)).alias("asked_again"))


def old_context_run(spark: SparkSession, sf_dir: str) -> str:
    """An old run's log, as JSON rows in a folder: contexts from a model that is
    overloaded at some prompts, each failed id first with a parse error (a log
    keeps all its rows, the last one counts)."""
    from quire.functions.replies import parse_error_struct
    from quire.operators.responders import FailingResponder

    log, path = scratch_path(spark, "old-log"), scratch_path(spark, "old-json")
    failing = FailingResponder(ContextResponder(), message="529 overloaded")
    runs.context_run(spark, sf_dir, log, failing, failing, retry=runs.NO_RETRY)
    rows = io.load_log(spark, log, runs.CONTEXT_LOG_SCHEMA).where("run_id = 0").select(
        "qid", "prediction", F.col("seq"))
    again = rows.where(context_failed(F.col("prediction")["context"])).select(
        "qid", parse_error_struct().alias("prediction"), (F.col("seq") - (1 << 50)).alias("seq"))
    io.write_json_rows(rows.unionByName(again), path)
    return path


def retried_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contexts of all questions after the retry of an old run whose log was
    read from JSON rows."""
    old = spark.read.schema(
        "qid STRING, seq LONG, prediction STRUCT<context: STRING, is_contextual: BOOLEAN, "
        "explanation: STRING, corrected_question: STRING>").json(old_context_run(spark, sf_dir))
    return retry_old_run(spark, old, sh.questions(spark, sf_dir), ContextResponder(),
                         scratch_path(spark, "old-run-retry"), retry=runs.NO_RETRY)
