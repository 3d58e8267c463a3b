"""Whole runs composed from the operators.

``answer_run`` is the batch answering run: resume (anti join with the log),
model call, log append, failed ids, retry of only those, overlay, submission
in input order. Each model round is written to the log before it is used,
so a re-executed task cannot change what later steps see, and a second run
over the same log infers only what is still missing.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.replies import NO_CANDIDATES_THOUGHTS, NO_RESPONSE_BEST, reply_status
from quire.functions.text import py_strip
from quire.operators import infer as inf
from quire.operators import ledger as led
from quire.operators import resume as rs
from quire.operators import vote as vo
from quire.operators.responders import GoesDown
from quire.plans import shapes as sh
from quire.session import scratch_path
from quire.sources import io
from quire.sources.compact import compact, unanswered

#: ``run_id`` counts the rounds of a log; ``seq`` orders the rows of one round.
LOG_SCHEMA = ("run_id INT, seq LONG, qid STRING, prediction STRING, attempts INT, "
              "elapsed_s DOUBLE")

#: No retry inside a task (a failed call becomes an error row at once).
NO_RETRY = (0.0, 0.0, 0)


def retrying(retry: tuple) -> dict:
    """``infer`` arguments of a retry setting (first delay, jitter, retries)."""
    initial, jitter, retries = retry
    return {"initial_backoff": initial, "jitter": jitter, "max_retries": retries}


def next_round(log: DataFrame) -> int:
    """The number of the round about to be written: one above the log's."""
    last = log.agg(F.max("run_id")).first()[0]
    return 0 if last is None else last + 1


def logged_round(spark: SparkSession, questions: DataFrame, log_path: str, schema: str,
                 responder_factory, to_rows, ids: DataFrame | None = None,
                 group_col: str | None = "conv_id", retry: tuple = inf.BACKOFF_REWRITE,
                 keep: tuple[str, ...] = ("qid",), save: tuple[int, float] = (1000, 60.0)) -> None:
    """One model round over the ``questions`` not yet in the log (or only
    ``ids``), appended to the log under the next round number.

    While the round runs its tasks save what they finish (every ``save`` rows or
    seconds); what a lost round had saved becomes part of the log first, so only
    the rest is asked again. ``to_rows(output of infer, round)`` gives the log's
    rows.
    """
    raw = T.StructType([*(questions.schema[k] for k in keep), *inf.OUTPUT_FIELDS])
    recover_rounds(spark, log_path, schema, raw, to_rows)
    log = io.load_log(spark, log_path, schema)
    run_id = next_round(log)
    todo = rs.only_ids(questions, ids, key="qid") if ids is not None else \
        unanswered(spark, questions, log_path, schema)
    ledger = led.new_ledger(log_path, *save)
    out = inf.infer(todo, "prompt", responder_factory, keep=keep, group_col=group_col,
                    ledger=ledger, key=["qid"], **retrying(retry))
    io.append_log(to_rows(out, run_id), log_path, ledger.batch)
    led.forget(log_path, ledger.batch)


def recover_rounds(spark: SparkSession, log_path: str, schema: str, raw: T.StructType, to_rows
                   ) -> list[str]:
    """Make what the tasks of lost rounds have saved a round of the log each."""
    def append(rows: DataFrame, batch: str) -> None:
        run_id = next_round(io.load_log(spark, log_path, schema))
        io.append_log(to_rows(rows, run_id), log_path, batch)

    done = io.committed(spark, log_path, led.batches_in_progress(log_path))
    return led.recovered(spark, log_path, raw, ["qid"], append, done)


def answer_rows(no_response: str = NO_RESPONSE_BEST):
    """Output of ``infer`` as rows of the answer log."""
    def rows(out: DataFrame, run_id: int) -> DataFrame:
        return out.select(
            F.lit(run_id).alias("run_id"), F.monotonically_increasing_id().alias("seq"), "qid",
            reply_status("reply", "error", no_response).alias("prediction"), "attempts", "elapsed_s")

    return rows


def answer_round(spark: SparkSession, questions: DataFrame, log_path: str, responder_factory,
                 ids: DataFrame | None = None, group_col: str | None = "conv_id",
                 retry: tuple = inf.BACKOFF_REWRITE, no_response: str = NO_RESPONSE_BEST,
                 save: tuple[int, float] = (1000, 60.0)) -> None:
    """A :func:`logged_round` of the answer log."""
    logged_round(spark, questions, log_path, LOG_SCHEMA, responder_factory,
                 answer_rows(no_response), ids, group_col, retry, save=save)


def interrupted_run(spark: SparkSession, sf_dir: str, log_path: str | None = None,
                    down_when=None) -> DataFrame:
    """An answer run that is lost on its way and begun again. The first model
    goes down at some prompts, which fails its tasks and with them the job; what
    the tasks had finished is recovered into the log, and the second model is
    asked for the rest only. Every question with its answer and how many rows of
    the log are its."""
    log_path = log_path or scratch_path(spark, "interrupted-log")
    q = sh.questions(spark, sf_dir).select("qid", "conv_id", py_strip("question").alias("prompt"))
    first = GoesDown(inf.PrefixResponder("A: ", 20), down_when or (lambda p: len(p) % 8 == 0))
    try:
        answer_round(spark, q, log_path, first, retry=NO_RETRY, save=(1, 0.0))
    except PySparkException as exc:
        if GoesDown.MESSAGE not in str(exc):
            raise
    answer_round(spark, q, log_path, inf.PrefixResponder("A: ", 20), retry=NO_RETRY)
    log = io.load_log(spark, log_path, LOG_SCHEMA)
    return current_answers(spark, log_path).select("qid", "prediction").join(
        log.groupBy("qid").agg(F.count(F.lit(1)).alias("n_logged")), on="qid", how="inner")


def answer_rounds(spark: SparkSession, questions: DataFrame, log_path: str, first, retries,
                  retry: tuple = inf.BACKOFF_REWRITE) -> DataFrame:
    """Answer ``questions`` (qid, conv_id, prompt): a round over what the log
    lacks, then one round per responder in ``retries`` over the ids whose
    current answer is an error. Returns the current answers."""
    answer_round(spark, questions, log_path, first, retry=retry)
    for responder in retries:
        failed = rs.error_ids(current_answers(spark, log_path), "prediction", key="qid")
        answer_round(spark, questions, log_path, responder, ids=failed, retry=retry)
    return current_answers(spark, log_path)


def answer_run(spark: SparkSession, sf_dir: str, log_path: str | None = None,
               first_factory=None, retry_factory=None, retry: tuple = NO_RETRY) -> DataFrame:
    """Batch answering of the user turns with one retry round.

    Default responders are deterministic: the first one fails (HTTP 503) on
    every prompt whose length is a multiple of four, the retry never fails,
    so the final table answers every question.
    """
    log_path = log_path or scratch_path(spark, "answer-log")
    q = sh.questions(spark, sf_dir).select("qid", "conv_id", "turn",
                                           py_strip("question").alias("prompt"))
    first = first_factory or inf.PrefixResponder("A: ", 20, fail_when=lambda p: len(p) % 4 == 0)
    final = answer_rounds(spark, q, log_path, first,
                          [retry_factory or inf.PrefixResponder("A: ", 20)], retry)
    sub = rs.to_input_order(q.select("qid", "conv_id", "turn"), final, key="qid",
                            value_col="prediction", pos=["conv_id", "turn"])
    return io.submission(sub, keep=("conv_id", "turn"))


def current_answers(spark: SparkSession, log_path: str) -> DataFrame:
    """The answer of each id after all rounds of the log, and the round it is of
    (``round_no``)."""
    log = io.load_log(spark, log_path, LOG_SCHEMA)
    return rs.overlay_runs(log, key="qid", value_col="prediction", original=None,
                           won_col="round_no")


def three_rounds(spark: SparkSession, sf_dir: str, log_path: str | None = None) -> DataFrame:
    """Three rounds whose rows lie differently in each: the first retry mends
    some failures, the second the others. Every id with its answer and the
    round that gave it."""
    log_path = log_path or scratch_path(spark, "rounds-log")
    q = sh.questions(spark, sf_dir).select("qid", "conv_id", py_strip("question").alias("prompt"))
    first = inf.PrefixResponder("A: ", 20, fail_when=lambda p: len(p) % 2 == 0)
    second = inf.PrefixResponder("B: ", 20, fail_when=lambda p: len(p) % 4 == 0)
    answer_round(spark, q, log_path, first, retry=NO_RETRY)
    for factory, order in ((second, F.col("qid").desc()), (inf.PrefixResponder("C: ", 20), "conv_id")):
        failed = rs.error_ids(current_answers(spark, log_path), "prediction", key="qid")
        answer_round(spark, q.repartitionByRange(3, order), log_path, factory, ids=failed,
                     retry=NO_RETRY)
    return current_answers(spark, log_path).select("qid", "prediction", "round_no")


def compacted_rounds(spark: SparkSession, sf_dir: str, log_path: str | None = None) -> DataFrame:
    """Three rounds over one log that is compacted after each of them, so every
    round reads a base and no batch before it. Every id with its answer, the round
    that gave it, and how many rows of the log are left of it."""
    log_path = log_path or scratch_path(spark, "compacted-log")
    q = sh.questions(spark, sf_dir).select("qid", "conv_id", py_strip("question").alias("prompt"))
    first = inf.PrefixResponder("A: ", 20, fail_when=lambda p: len(p) % 2 == 0)
    second = inf.PrefixResponder("B: ", 20, fail_when=lambda p: len(p) % 4 == 0)
    answer_round(spark, q, log_path, first, retry=NO_RETRY)
    for factory in (second, inf.PrefixResponder("C: ", 20)):
        compact(spark, log_path, LOG_SCHEMA)
        failed = rs.error_ids(current_answers(spark, log_path), "prediction", key="qid")
        answer_round(spark, q, log_path, factory, ids=failed, retry=NO_RETRY)
    compact(spark, log_path, LOG_SCHEMA)
    answer_round(spark, q, log_path, first, retry=NO_RETRY)  # finds nothing left to ask
    kept = io.load_log(spark, log_path, LOG_SCHEMA).groupBy("qid").agg(
        F.count(F.lit(1)).alias("n_kept"))
    return current_answers(spark, log_path).select("qid", "prediction", "round_no") \
        .join(kept, on="qid", how="inner")


def run_log(spark: SparkSession, log_path: str) -> DataFrame:
    """Calls, attempts and elapsed time per round of an answer log."""
    return io.load_log(spark, log_path, LOG_SCHEMA).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_calls"), F.sum("attempts").alias("n_attempts"),
        F.sum("elapsed_s").alias("total_s"), F.max("elapsed_s").alias("max_s"))


# --- Two-step answer: candidates as rows, then a table vote -------------------

def two_step_answer(spark: SparkSession, sf_dir: str, n: int = 4,
                    responder_factory=None) -> DataFrame:
    """Step 1 asks for ``n`` candidate answers per question; the candidate
    lines become rows and the final answer is the vote among them (option E,
    "none of the above", only when nothing else was proposed). See
    :func:`two_step_model` for the variant where the model aggregates."""
    from quire.functions.prompts import CANDIDATES_TEMPLATE, render
    from quire.operators import vote as vo
    from quire.operators.responders import CandidateResponder

    q = sh.questions(spark, sf_dir).select(
        "qid", "conv_id",
        render(CANDIDATES_TEMPLATE, question=py_strip("question"), n=n).alias("prompt"))
    step1 = inf.durable(inf.infer(q, "prompt", responder_factory or CandidateResponder(n),
                                  keep=["qid"], group_col="conv_id"))
    cands = vo.open_labels(vo.candidate_rows(step1.filter(F.col("error").isNull()), key="qid",
                                             reply_col="reply"))
    v = vo.vote(cands, key="qid", none_label="E", expected=q.select("qid"))
    return v.select("qid", "winner", "votes", "n_candidates", "status")


def two_step_model(spark: SparkSession, sf_dir: str, n: int = 4, candidates_factory=None,
                   aggregate_factory=None, retry: tuple = inf.BACKOFF_REWRITE) -> DataFrame:
    """Two model steps: ``n`` candidates, then an aggregation prompt holding the
    question, the candidate text (or the fixed text when there was none), ``n``
    and the rules; the second reply is the answer. Where step 1 failed its
    error is the answer and step 2 is not asked. Each step's replies are
    written before anything shuffles them."""
    from quire.functions.prompts import AGGREGATE_TEMPLATE, CANDIDATES_TEMPLATE, render
    from quire.operators.responders import CandidateResponder, PickCandidateResponder

    q = sh.questions(spark, sf_dir).select("qid", "conv_id", py_strip("question").alias("q"))
    step1_in = q.select("qid", "conv_id", "q",
                        render(CANDIDATES_TEMPLATE, question=F.col("q"), n=n).alias("prompt"))
    step1 = inf.durable(inf.infer(step1_in, "prompt", candidates_factory or CandidateResponder(n),
                                  keep=["qid", "conv_id", "q"], group_col="conv_id",
                                  **retrying(retry)))
    step1 = step1.withColumn("thoughts", F.when(F.col("error").isNull(), F.coalesce(
        F.nullif(py_strip("reply"), F.lit("")), F.lit(NO_CANDIDATES_THOUGHTS))))
    step2_in = step1.where("error IS NULL").select("qid", "conv_id", "thoughts", render(
        AGGREGATE_TEMPLATE, question=F.col("q"), candidates=F.col("thoughts"), n=n).alias("prompt"))
    step2 = inf.durable(inf.infer(step2_in, "prompt", aggregate_factory or PickCandidateResponder(),
                                  keep=["qid", "thoughts"], group_col="conv_id", **retrying(retry)))
    failed = step1.where("error IS NOT NULL")
    pair = step2.unionByName(failed.select(*step2.columns)).select(
        "qid", F.struct(reply_status("reply", "error").alias("answer"),
                        F.col("thoughts")).alias("result"))
    return pair.select("qid", F.col("result.answer").alias("answer"),
                       F.col("result.thoughts").alias("thoughts"))


# --- Context run: extract, parse, retry the failures, lay on the questions ----

CONTEXT_LOG_SCHEMA = ("run_id INT, seq LONG, qid STRING, prediction STRUCT<context: STRING, "
                      "is_contextual: BOOLEAN, explanation: STRING, corrected_question: STRING>")


def context_rows(retries: int):
    """Output of ``infer`` as rows of the context log."""
    from quire.functions.replies import context_prediction

    def rows(out: DataFrame, run_id: int) -> DataFrame:
        return out.select(F.lit(run_id).alias("run_id"),
                          F.monotonically_increasing_id().alias("seq"), "qid",
                          context_prediction("reply", "error", retries).alias("prediction"))

    return rows


def _context_round(spark: SparkSession, questions: DataFrame, factory, log_path: str, retry: tuple,
                   ids: DataFrame | None = None) -> None:
    logged_round(spark, questions, log_path, CONTEXT_LOG_SCHEMA, factory, context_rows(retry[2]),
                 ids, retry=retry)


def current_contexts(spark: SparkSession, log_path: str) -> DataFrame:
    """The context record of each id after all rounds of the log."""
    from quire.functions.replies import context_failed

    log = io.load_log(spark, log_path, CONTEXT_LOG_SCHEMA)
    return rs.overlay_runs(log, key="qid", value_col="prediction", original=None,
                           error_test=lambda c: context_failed(c["context"]), won_col="round_no")


def context_rounds(spark: SparkSession, questions: DataFrame, log_path: str,
                   first_factory=None, retry_factory=None, retry: tuple = inf.BACKOFF_CONTEXT
                   ) -> DataFrame:
    """Context extraction with one retry round over ``questions`` (``qid``,
    ``conv_id``, ``question``); returns the current (overlaid) contexts."""
    from quire.functions.prompts import CONTEXT_TEMPLATE, render
    from quire.functions.replies import context_failed
    from quire.operators.responders import ContextResponder

    q = questions.select("qid", "conv_id",
                         render(CONTEXT_TEMPLATE, question=py_strip("question")).alias("prompt"))
    _context_round(spark, q, first_factory or ContextResponder(fail_mod=7), log_path, retry)
    state = current_contexts(spark, log_path)
    failed = state.filter(context_failed(F.col("prediction")["context"])).select("qid")
    _context_round(spark, q, retry_factory or ContextResponder(), log_path, retry, failed)
    return current_contexts(spark, log_path)


def context_run(spark: SparkSession, sf_dir: str, log_path: str | None = None,
                first_factory=None, retry_factory=None, retry: tuple = inf.BACKOFF_CONTEXT
                ) -> DataFrame:
    """Context extraction for every user turn with one retry round, then the
    contexts flattened onto the question rows; a question without a record gets
    that of a lost task."""
    from quire.functions.replies import task_error_struct
    from quire.operators.enrich import enrich

    log_path = log_path or scratch_path(spark, "context-log")
    questions = sh.questions(spark, sf_dir)
    final = context_rounds(spark, questions, log_path, first_factory, retry_factory, retry)
    full = rs.complete(questions.select("qid"), final.select("qid", "prediction"), key="qid",
                       placeholder=task_error_struct())
    out = enrich(questions.select("qid", "conv_id", "turn"), full.select("qid", "prediction"),
                 key="qid", how="left", question=None, prompt=None)
    return out.select("qid", "conv_id", "turn", "context", "is_contextual", "explanation",
                      "corrected_question")


def snapshot_run(spark: SparkSession, sf_dir: str, log_path: str | None = None) -> DataFrame:
    """Snapshot of the answered questions: last-wins contexts, retry overlay
    that also adds retry-only ids, inner join with the questions, combined
    question text, prediction flattened, NaN as NULL."""
    from quire.operators.enrich import enrich

    log_path = log_path or scratch_path(spark, "snapshot-log")
    questions = sh.questions(spark, sf_dir)
    context_rounds(spark, questions, log_path)
    final = current_contexts(spark, log_path)
    q = questions.join(sh.prompts(spark, sf_dir), on="conv_id", how="left")
    out = enrich(q.select("qid", "question", "question_prompt"), final.select("qid", "prediction"),
                 key="qid", how="inner")
    return out.select("qid", "question_with_prompt", "context", "is_contextual", "explanation")


def one_group_check(spark: SparkSession, sf_dir: str, conv_id: int, log_path: str | None = None
                    ) -> DataFrame:
    """Context run for one conversation (equality filter on the group key, pushed to
    the scan), then a preview of each context."""
    from quire.functions.text import preview

    log_path = log_path or scratch_path(spark, "one-group-log")
    questions = sh.questions(spark, sf_dir).filter(F.col("conv_id") == conv_id)
    final = context_rounds(spark, questions, log_path)
    ids = questions.select("qid")
    return rs.only_ids(final, ids, key="qid").select(
        "qid", preview(F.col("prediction")["context"]).alias("preview"))


# --- Fact check over (question, answer) pairs ---------------------------------

def fact_check_run(spark: SparkSession, sf_dir: str, responder_factory=None,
                   retry: tuple = inf.BACKOFF_REWRITE) -> DataFrame:
    from quire.functions.prompts import FACT_CHECK_TEMPLATE, render
    from quire.functions.replies import parse_verdict
    from quire.operators.responders import VerdictResponder

    pairs = sh.questions(spark, sf_dir).join(sh.answers(spark, sf_dir), on="qid", how="inner")
    p = pairs.select("qid", "conv_id", render(FACT_CHECK_TEMPLATE, question=py_strip("question"),
                                             answer=py_strip("answer")).alias("prompt"))
    # Consumed once by a projection: no shuffle re-reads the model output.
    out = inf.infer(p, "prompt", responder_factory or VerdictResponder(), keep=["qid"],
                    group_col="conv_id", **retrying(retry))
    v = out.select("qid", parse_verdict("reply", "error").alias("v"))
    return v.select("qid", "v.is_supported", "v.explanation")


# --- Rewrite run: validate, chunk, prompt, rewrite, clean, fall back ----------

REWRITE_START = "Original question:\n"
REWRITE_END = "\n\nRewrite the question"


def rewrite_items(spark: SparkSession, items: DataFrame, responder_factory=None,
                  retry: tuple = inf.BACKOFF_REWRITE) -> DataFrame:
    """Rewrite each question of ``items`` (qid, conv_id, question, context).

    Rows without a question, without context or whose context has no chunk
    are kept with their ``skip_reason`` (status ``skipped``); the others get
    the cleaned rewrite, or the question when the call failed (``error``) or the
    rewrite is empty or only differs in case. Output: qid, skip_reason,
    context (its chunks), final_question, rewrite_status, error."""
    from quire.functions.prompts import REWRITE_TEMPLATE, render
    from quire.functions.text import (bullet_list, clean_rewrite, context_chunks,
                                      rewrite_or_fallback, rewrite_status)
    from quire.operators.enrich import validate_rows
    from quire.operators.responders import RewriteResponder

    checked = validate_rows(items.withColumn("q", py_strip("question")), question="q",
                            context="context").withColumn("chunks", context_chunks("context"))
    valid = checked.filter(F.col("skip_reason").isNull()).select(
        "qid", "conv_id", "q", "chunks",
        render(REWRITE_TEMPLATE, context=bullet_list("chunks"), question=F.col("q")).alias("prompt"))
    out = inf.durable(inf.infer(
        valid, "prompt", responder_factory or RewriteResponder(REWRITE_START, REWRITE_END),
        keep=["qid", "q", "chunks"], group_col="conv_id", **retrying(retry)))
    cleaned = out.select("qid", "q", "chunks", "error", clean_rewrite("reply").alias("r"))
    done = cleaned.select(
        "qid", F.lit(None).cast("string").alias("skip_reason"), F.col("chunks").alias("context"),
        rewrite_or_fallback("r", "q").alias("final_question"),
        F.when(F.col("error").isNotNull(), F.lit("error")).otherwise(rewrite_status("r", "q"))
        .alias("rewrite_status"), "error")
    skipped = checked.filter(F.col("skip_reason").isNotNull()).select(
        "qid", "skip_reason", F.col("chunks").alias("context"), F.col("q").alias("final_question"),
        F.lit("skipped").alias("rewrite_status"), F.lit(None).cast("string").alias("error"))
    return done.unionByName(skipped)


def rewrite_run(spark: SparkSession, sf_dir: str, responder_factory=None,
                retry: tuple = inf.BACKOFF_REWRITE) -> DataFrame:
    """Rewrite each user turn with the following assistant turn as its context."""
    items = sh.questions(spark, sf_dir).join(sh.answers(spark, sf_dir), on="qid", how="left") \
        .select("qid", "conv_id", "question", F.col("answer").alias("context"))
    return rewrite_items(spark, items, responder_factory, retry)


# --- Compare single-shot and two-step answers --------------------------------

def compare_modes(spark: SparkSession, sf_dir: str, n: int = 4,
                  cache_path: str | None = None) -> DataFrame:
    """Single-shot answer (one candidate) against the two-step vote winner per
    question, both through the answer cache keyed ``(mode, url, question, n)``
    (here the conversation stands for the media url); one row per outcome."""
    from quire.functions.prompts import CANDIDATES_TEMPLATE, render
    from quire.functions.replies import option_label
    from quire.operators import cache as ca
    from quire.operators.evaluate import compare_runs
    from quire.operators.responders import CandidateResponder

    cache_path = cache_path or scratch_path(spark, "answer-cache")
    q = sh.questions(spark, sf_dir).select(
        "qid", F.col("conv_id").cast("string").alias("url"), py_strip("question").alias("question"))

    def single(keys: DataFrame) -> DataFrame:
        p = keys.select("*", F.col("url").alias("conv_id"),
                        render(CANDIDATES_TEMPLATE, question=F.col("question"), n=1).alias("prompt"))
        out = inf.infer(p, "prompt", CandidateResponder(1), keep=list(ca.CACHE_KEY),
                        group_col="conv_id", salt_on="question")
        return out.select(*ca.CACHE_KEY, option_label("reply").alias("answer"))

    def two_step(keys: DataFrame) -> DataFrame:
        p = keys.select("*", F.col("url").alias("conv_id"),
                        render(CANDIDATES_TEMPLATE, question=F.col("question"), n=n).alias("prompt"))
        step1 = inf.durable(inf.infer(p, "prompt", CandidateResponder(n),
                                      keep=list(ca.CACHE_KEY), group_col="conv_id",
                                      salt_on="question"))
        # The vote runs on a 160-bit hash of the key, not on the question's text.
        step1 = step1.withColumn("k", F.sha1(F.to_json(F.struct(*ca.CACHE_KEY))))
        cands = vo.candidate_rows(step1, key="k", reply_col="reply")
        v = vo.vote(cands, key="k", none_label="E")
        keys_k = step1.select(*ca.CACHE_KEY, "k")
        return keys_k.join(v, on="k", how="left").select(*ca.CACHE_KEY,
                                                           F.col("winner").alias("answer"))

    req1 = q.select("qid", F.lit("single").alias("mode"), "url", "question",
                    F.lit(1).alias("n"))
    req2 = q.select("qid", F.lit("two_step").alias("mode"), "url", "question",
                    F.lit(n).alias("n"))
    a = ca.answer_with_cache(req1, cache_path, single).select(
        "qid", F.col("answer").alias("prediction"))
    b = ca.answer_with_cache(req2, cache_path, two_step).select(
        "qid", F.col("answer").alias("prediction"))
    return compare_runs(a, b, key="qid", value_col="prediction")


# --- Three steps: context, rewrite, answer -----------------------------------

def three_step_run(spark: SparkSession, sf_dir: str, retry: tuple = NO_RETRY) -> DataFrame:
    """Contexts, then rewrites that read those contexts, then the answers to the
    rewritten questions (falling back to the question; a context is required)
    with the context in their prompt, through the answer log with a retry
    round, in input order."""
    from quire.functions.prompts import ANSWER_TEMPLATE, render
    from quire.operators.enrich import prepare_answer_input

    questions = sh.questions(spark, sf_dir)
    contexts = context_rounds(spark, questions, scratch_path(spark, "three-step-context"),
                              retry=retry)
    contexts = contexts.select("qid", F.col("prediction")["context"].alias("context"))
    rewrites = rewrite_items(spark, questions.join(contexts, on="qid", how="left"), retry=retry) \
        .select("qid", F.col("final_question").alias("corrected_question"))
    inputs = prepare_answer_input(questions.select("qid", "conv_id", "turn", "question"),
                                  rewrites, contexts, key="qid", strict=True)
    prompts = inputs.select("qid", "conv_id", "turn", render(
        ANSWER_TEMPLATE, context=F.col("context"),
        question=py_strip("corrected_question")).alias("prompt"))
    first = inf.PrefixResponder("A: ", 20, fail_when=lambda p: len(p) % 4 == 0)
    final = answer_rounds(spark, prompts, scratch_path(spark, "three-step-answers"), first,
                          [inf.PrefixResponder("A: ", 20)], retry)
    ordered = rs.to_input_order(questions.select("qid", "conv_id", "turn"), final, key="qid",
                                value_col="prediction", pos=["conv_id", "turn"])
    return io.submission(ordered)


# --- Repeated passes feeding the vote -----------------------------------------

def repeat_vote(spark: SparkSession, sf_dir: str, passes: int = 3) -> DataFrame:
    """Every question asked ``passes`` times (``pass_idx`` in the prompt); all
    passes are kept and vote, instead of keeping only the first pass."""
    from quire.functions.replies import option_label
    from quire.operators.grouping import repeat_passes
    from quire.operators.responders import LetterResponder

    q = sh.questions(spark, sf_dir).select("qid", "conv_id", py_strip("question").alias("q"))
    asked = repeat_passes(q, passes).select(
        "qid", "conv_id", "pass_idx",
        F.concat("q", F.lit("\n(pass "), F.col("pass_idx").cast("string"), F.lit(")")).alias("prompt"))
    out = inf.durable(inf.infer(asked, "prompt", LetterResponder(), keep=["qid", "pass_idx"],
                                group_col="conv_id", salt_on="prompt"))
    cands = out.select("qid", F.col("pass_idx").cast("long").alias("pos"),
                       option_label("reply").alias("label"))
    v = vo.vote(cands, key="qid", none_label="E")
    return v.select("qid", "winner", "votes", "n_candidates", "status")
