"""The operator inventory as queries over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
library operators; :mod:`quire.plans.oracle` holds the equivalent SQL. Every
query reads whole tables: no id subsets, prefixes or row caps. Where a table
is split (even / odd events as two runs) both halves are used.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import prompts as pr
from quire.functions import replies as rp
from quire.functions import text as tx
from quire.operators import cache as ca
from quire.operators import enrich as en
from quire.operators import evaluate as ev
from quire.operators import grouping as gr
from quire.operators import infer as inf
from quire.operators import resume as rs
from quire.operators import vote as vo
from quire.operators.ordering import group_index
from quire.operators.responders import (CandidateResponder, ContextResponder, FailingResponder,
                                        FlakyResponder, MediaResponder, RewriteResponder,
                                        VerdictResponder)
from quire.plans import runs
from quire.plans import shapes as sh

# Placeholder of a requested id that got no result.
MISSING_RESULT = "Error: missing result"
# The day the answer cache was built up to (cache = events before it).
CACHE_CUTOFF = _dt.datetime(2024, 1, 16)
# One conversation looked at on its own (equality filter on the group key).
ONE_GROUP = 7
# Groups per batch.
BATCH_SIZE = 7
# Passes per question.
N_PASSES = 3
# Candidate count slot of the rendered prompt.
N_CANDIDATES = 8


def q_unanswered(spark: SparkSession, d: str) -> DataFrame:
    return rs.unanswered(sh.questions(spark, d), sh.answers(spark, d), key="qid")


def _failed_users(spark, d):
    orig = rs.latest(sh.event_log(spark, d, "original"), key="qid", order=["seq"],
                     values=["prediction"])
    return rs.error_ids(orig, "prediction", key="qid")


def q_semi_retry(spark, d):
    ev_ = sh.table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    failed = _failed_users(spark, d).withColumnRenamed("qid", "user_id")
    return rs.only_ids(ev_, failed, key="user_id")


def status_text(event_id="event_id", event_type="event_type"):
    """Status strings in every spelling the runtime writes, built from events;
    ``view`` becomes an answer that merely starts with "Errors"."""
    et, eid = F.col(event_type), F.col(event_id)
    spelled = (F.when(eid % 5 == 0, F.lit("Error"))
               .when(eid % 5 == 1, F.lit("Error:RateLimit"))
               .when(eid % 5 == 2, F.lit("Error: No response from step 2"))
               .when(eid % 5 == 3, F.lit("Error during processing: timeout"))
               .otherwise(F.lit("Error (run A): failed")))
    return (F.when(et == "error", spelled)
            .when(et == "view", F.lit("Errors in the clip"))
            .otherwise(et))


def q_error_ids(spark, d):
    e = sh.table(spark, d, "events").select(
        F.col("user_id").alias("qid"), "event_id", status_text().alias("status"))
    errs = e.filter(rp.is_error("status"))
    return errs.groupBy("qid").agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.count_if(rp.is_error("status", mode="exact")).alias("n_exact"),
        F.min("event_id").alias("first_error_seq"))


def q_latest_prediction(spark, d):
    log = sh.table(spark, d, "events").select(
        F.col("user_id").alias("qid"), F.col("event_id").alias("seq"),
        F.col("event_type").alias("prediction"))
    return rs.latest(log, key="qid", order=["seq"], values=["prediction"],
                     count_col="n_entries")


def _runs(spark, d):
    o = rs.latest(sh.event_log(spark, d, "original"), order=["seq"], values=["prediction"])
    r = rs.latest(sh.event_log(spark, d, "retry"), order=["seq"], values=["prediction"])
    return o, r


def q_retry_overlay(spark, d):
    o, r = _runs(spark, d)
    return rs.overlay(o, r, key="qid", value_col="prediction")


def q_retry_overlay_outer(spark, d):
    # The original run lost the users whose first event is an error (their
    # rows never reached its log); the retry run has every user.
    events = sh.table(spark, d, "events")
    first = events.groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("first_type"))
    kept = first.filter(F.col("first_type") != "error").select(F.col("user_id").alias("qid"))

    def log(run):
        e = events.filter(F.col("event_id") % 2 == (0 if run == "original" else 1))
        value = F.when(F.col("event_type") == "error", F.lit("Error: failed")).otherwise(F.col("event_type"))
        return e.select(F.col("user_id").alias("qid"), F.col("event_id").alias("seq"),
                        value.alias("prediction"))

    orig = rs.only_ids(log("original"), kept, key="qid")
    o = rs.latest(orig, order=["seq"], values=["prediction"])
    r = rs.latest(log("retry"), order=["seq"], values=["prediction"])
    return rs.overlay(o, r, key="qid", value_col="prediction",
                      error_test=lambda c: rp.is_error(c, mode="prefix"), add_new=True)


def q_overlay_counts(spark, d):
    o, r = _runs(spark, d)
    return ev.overlay_counts(o, r, key="qid", value_col="prediction")


def q_complete_results(spark, d):
    q = sh.questions(spark, d).select("qid")
    a = sh.answers(spark, d).select("qid", "answer")
    return rs.complete(q, a, key="qid", value_col="answer", placeholder=F.lit(MISSING_RESULT))


def _docs_with_prior(spark, d):
    docs = sh.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    # A prior guess of quality that a label overrides when one exists.
    return docs.withColumn("quality", (F.col("n_chars") > 500).cast("int"))


def _label_predictions(spark, d):
    lab = sh.table(spark, d, "labels")
    return lab.select("doc_id", F.struct("quality", "toxic").alias("prediction"))


def q_enrich_left(spark, d):
    return en.enrich(_docs_with_prior(spark, d), _label_predictions(spark, d), key="doc_id",
                     how="left", question=None, prompt=None)


def q_snapshot_inner(spark, d):
    return en.enrich(_docs_with_prior(spark, d), _label_predictions(spark, d), key="doc_id",
                     how="inner", question=None, prompt=None)


def _question_contexts(spark, d):
    q = sh.questions(spark, d)
    return q.join(sh.prompts(spark, d), on="conv_id", how="inner").select(
        "qid", F.col("question_prompt").alias("context"))


def q_prepare_answer_input(spark, d):
    q = sh.questions(spark, d).select("qid", "question")
    rewrites = sh.answers(spark, d).select("qid", F.col("answer").alias("corrected_question"))
    out = en.prepare_answer_input(q, rewrites, _question_contexts(spark, d), key="qid",
                                  strict=False)
    return out.select("qid", "corrected_question", "context", "missing_context")


def q_reorder_to_input(spark, d):
    q = group_index(sh.questions(spark, d).select("qid", "conv_id", "turn"), ["conv_id"], ["turn"],
                    col="pos")
    a = sh.answers(spark, d).select("qid", F.col("answer").alias("pred"))
    out = rs.to_input_order(q, a, key="qid", value_col="pred", pos=["conv_id", "pos"])
    return out.select("qid", "conv_id", "pos", "pred")


def q_submission_rows(spark, d):
    """The submission written as CSV in input order and read back."""
    from quire.session import scratch_path
    from quire.sources import io

    q = sh.questions(spark, d).select("qid", "conv_id", "turn")
    j = q.join(sh.answers(spark, d), on="qid", how="left")
    sub = io.submission(j, value_col="answer", keep=("conv_id", "turn"))
    path = scratch_path(spark, "submission")
    io.write_submission(sub, path, order=("conv_id", "turn"))
    return spark.read.schema("qid STRING, pred STRING").option("header", True) \
        .option("multiLine", True).option("escape", '"').option("nullValue", "\x00") \
        .option("emptyValue", "").csv(path)


def _questions_with_prompt(spark, d):
    return sh.questions(spark, d).join(sh.prompts(spark, d), on="conv_id", how="left")


def q_combine_question_prompt(spark, d):
    j = _questions_with_prompt(spark, d)
    return j.select("qid", tx.combine_question("question", "question_prompt").alias("combined"))


def q_question_fallback(spark, d):
    j = _questions_with_prompt(spark, d)
    return j.select(
        tx.with_default("qid", tx.UNKNOWN_QID).alias("qid"),
        tx.question_fallback("question_prompt", "question").alias("question"),
        tx.video_id_fallback(F.lit(None).cast("string"), "qid", sep="-").alias("media_id"),
        F.when(F.col("question_prompt").isNotNull(), F.lit("prompt"))
        .otherwise(F.lit("question")).alias("prompt_source"))


def _chunks(spark, d):
    docs = sh.table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", tx.context_chunks("text").alias("chunks"))


def q_context_chunks(spark, d):
    return _chunks(spark, d).select("doc_id", F.posexplode("chunks").alias("pos", "chunk"))


def q_bullet_context(spark, d):
    c = _chunks(spark, d).select("doc_id", tx.bullet_list("chunks").alias("b"))
    return c.select("doc_id", F.length("b").alias("bullet_len"), F.md5("b").alias("bullet_md5"))


def q_render_prompt(spark, d):
    q = sh.questions(spark, d)
    p = pr.render(pr.CANDIDATES_TEMPLATE, question=tx.py_strip("question"), n=N_CANDIDATES)
    return q.select("qid", F.length(p).alias("prompt_len"), F.md5(p).alias("prompt_md5"))


def q_context_prompts(spark, d):
    """The prompts of the context steps for every answered question: asking for its
    context, checking a context (here the recorded answer), answering with it."""
    q = sh.questions(spark, d).join(sh.answers(spark, d), on="qid", how="inner")
    text, notes = tx.py_strip("question"), F.coalesce(F.col("answer"), F.lit(""))
    kinds = [("context", pr.render(pr.CONTEXT_TEMPLATE, question=text)),
             ("validation", pr.render(pr.VALIDATION_TEMPLATE, question=text, context=notes)),
             ("answer", pr.render(pr.ANSWER_TEMPLATE, question=text, context=notes))]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), p.alias("prompt"))
                               for k, p in kinds])).alias("p")
    return q.select("qid", each).select("qid", "p.kind", F.length("p.prompt").alias("prompt_len"),
                                        F.md5("p.prompt").alias("prompt_md5"))


def _rewrite_replies(spark, d):
    b = sh.table(spark, d, "benchmark").select("item_id", "text")
    k = F.col("item_id") % 4
    reply = (F.when(k == 0, F.concat(F.lit('REWRITTEN question: "'), "text", F.lit('"')))
             .when(k == 1, F.concat(F.lit("Rewritten Question:\n"), "text", F.lit("\n")))
             .when(k == 2, F.concat(F.lit('"'), "text", F.lit('"')))
             .otherwise(F.concat(F.lit("  "), "text")))
    return b.withColumn("reply", reply)


def q_clean_rewrite(spark, d):
    return _rewrite_replies(spark, d).select("item_id", tx.clean_rewrite("reply").alias("cleaned"))


def _rewrites(spark, d):
    b = sh.table(spark, d, "benchmark").select("item_id", F.col("text").alias("question"))
    k = F.col("item_id") % 4
    reply = (F.when(k == 0, F.lower("question"))
             .when(k == 1, F.lit(""))
             .when(k == 2, F.concat(F.lit("Rewritten question: "), "question", F.lit(" Why?")))
             .otherwise(F.col("question")))
    r = tx.clean_rewrite(reply)
    return b.select("item_id", "question", r.alias("rewrite"))


def q_rewrite_or_fallback(spark, d):
    r = _rewrites(spark, d)
    return r.select("item_id", tx.rewrite_or_fallback("rewrite", "question").alias("final_question"),
                    tx.rewrite_status("rewrite", "question").alias("rewrite_status"))


def q_rewrite_summary(spark, d):
    return ev.rewrite_summary(q_rewrite_or_fallback(spark, d), "rewrite_status")


def _context_replies(spark, d):
    e = sh.table(spark, d, "events").select("event_id", "user_id", "event_type")
    flag = F.when(F.col("event_type") == "purchase", F.lit("true")).otherwise(F.lit("false"))
    base = F.concat(F.lit('{"context": "'), "event_type", F.lit('", "is_contextual": '), flag,
                    F.lit(', "explanation": "user '), F.col("user_id").cast("string"), F.lit('"'))
    k = F.col("event_id") % 6
    reply = (F.when(k == 0, F.concat(base, F.lit(', "corrected_question": "q'),
                                     F.col("event_id").cast("string"), F.lit('"}')))
             .when(k == 1, F.concat(F.lit("```json\n"), base, F.lit("}\n```")))
             .when(k == 2, F.concat(F.lit("```\n"), F.regexp_replace(base, r'": (true|false)', '": "$1"'),
                                    F.lit("}```")))
             .when(k == 3, base)  # no closing brace: invalid JSON
             .when(k == 4, F.lit('{"context": null, "is_contextual": 1}'))
             .otherwise(F.lit("")))
    return e.select("event_id", reply.alias("reply"))


def q_parse_reply(spark, d):
    r = _context_replies(spark, d).select("event_id", rp.parse_reply("reply").alias("p"))
    return r.select("event_id", "p.context", "p.is_contextual", "p.explanation",
                    "p.corrected_question")


def q_parse_verdict(spark, d):
    e = sh.table(spark, d, "events").select("event_id", "event_type")
    flag = F.when(F.col("event_type").isin("click", "purchase"), F.lit("true")).otherwise(F.lit("false"))
    k = F.col("event_id") % 4
    reply = (F.when(k == 0, F.concat(F.lit('{"is_supported": '), flag,
                                     F.lit(', "explanation": "seen '), "event_type", F.lit('"}')))
             .when(k == 1, F.lit('{"is_supported": "true"}'))
             .when(k == 2, F.concat(F.lit('{"explanation": "only '), "event_type", F.lit('"}')))
             .otherwise(F.concat(F.lit(" not json "), "event_type")))
    v = e.select("event_id", rp.parse_verdict(reply).alias("v"))
    return v.select("event_id", "v.is_supported", "v.explanation")


def q_reply_status(spark, d):
    e = sh.table(spark, d, "events").select("event_id", "event_type", "props")
    et = F.col("event_type")
    reply = (F.when(et == "signup", F.lit("   "))
             .when(et == "error", F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit(" answer "), et, F.lit(" "))))
    err = F.when(et == "error", F.concat(F.lit("RuntimeError: "), F.repeat("props", 10)))
    return e.select("event_id", rp.reply_status(reply, err).alias("status"))


def failure_message(event_type="event_type"):
    et = F.col(event_type)
    return (F.when(et == "click", F.lit("HTTP 429 Too Many Requests"))
            .when(et == "error", F.lit("Server error: 503 Service Unavailable"))
            .when(et == "purchase", F.lit("403 Permission denied"))
            .when(et == "signup", F.lit("Connection error while reading"))
            .otherwise(F.lit("Unexpected token in reply")))


def q_retry_class(spark, d):
    e = sh.table(spark, d, "events").select("event_id", "event_type")
    return e.select("event_id", rp.retry_class(failure_message()).alias("retry_class"))


def q_validate_rows(spark, d):
    """Every document as a rewrite row (its source stands for the question),
    with some questions and contexts taken away."""
    docs = sh.table(spark, d, "documents").select("doc_id", "source", "text")
    k = F.col("doc_id") % 7
    rows = docs.select("doc_id", F.when(k != 3, F.col("source")).alias("question"),
                       F.when(k == 5, F.lit(" . .")).when(k != 4, F.col("text")).alias("context"))
    return en.validate_rows(rows).select("doc_id", "skip_reason")


def q_group_questions(spark, d):
    return gr.group_summary(sh.questions(spark, d), key="conv_id", pos="turn", qid="qid")


def q_video_batches(spark, d):
    b = gr.batches(sh.questions(spark, d), key="conv_id", batch_size=BATCH_SIZE, pos="turn",
                   qid="qid")
    return b.withColumn("batch_idx", F.col("batch_idx").cast("long"))


def q_filter_group(spark, d):
    c = sh.table(spark, d, "conversations")
    return c.filter(F.col("conv_id") == ONE_GROUP).select("conv_id", "turn", "role", "text")


def _candidate_replies(spark, d):
    docs = sh.table(spark, d, "documents").select("doc_id", "text")
    lines = F.split("text", "\n", -1)
    prefixed = F.transform(lines, lambda x, i: (
        F.when(i % 4 == 0, F.concat(F.lit("1. "), x))
        .when(i % 4 == 1, F.concat(F.lit("A) "), x))
        .when(i % 4 == 2, F.concat(F.lit("(B) "), x))
        .otherwise(x)))
    return docs.select("doc_id", F.array_join(prefixed, "\n").alias("reply"))


def q_candidate_rows(spark, d):
    return vo.candidate_rows(_candidate_replies(spark, d), key="doc_id", reply_col="reply")


def q_answer_format(spark, d):
    e = sh.table(spark, d, "events").select("event_id", "event_type", "value")
    letter = (F.when(F.col("event_type") == "click", F.lit("A"))
              .when(F.col("event_type") == "purchase", F.lit("B"))
              .when(F.col("event_type") == "signup", F.lit("C"))
              .when(F.col("event_type") == "view", F.lit("D"))
              .otherwise(F.lit("E")))
    k = F.col("event_id") % 3
    answer = (F.when(k == 0, letter).when(k == 1, F.concat(letter, F.lit(".")))
              .otherwise(F.concat(F.lit("The answer is "), letter)))
    f = e.select("event_id", rp.answer_format(answer, F.col("value") >= 25).alias("f"))
    return f.select("event_id", "f.checked", "f.valid", "f.normalized")


def q_media_lookup(spark, d):
    pages = sh.table(spark, d, "pages").select("page_id", "url")
    p = pages.withColumn("host", F.split_part("url", F.lit("/"), F.lit(3)))
    first = gr.first_of_group(p, key="host", pos="page_id", cols=["page_id", "url"],
                              count_col="n_pages") \
        .withColumnRenamed("page_id", "first_page_id").withColumnRenamed("url", "first_url")
    media = p.filter(F.col("url").endswith(".html")).select("host").distinct() \
        .withColumn("_m", F.lit(True))
    j = first.join(media, on="host", how="left")
    has = F.coalesce("_m", F.lit(False))
    return j.select("host", "first_page_id", "first_url", "n_pages", has.alias("has_media"),
                    F.when(has, F.concat(F.lit("media/"), "host", F.lit(".mp4"))).alias("media_path"))


def _event_candidates(spark, d):
    return sh.table(spark, d, "events").select(
        F.col("user_id").alias("qid"), F.col("event_id").alias("pos"),
        F.col("event_type").alias("label"))


def q_candidate_vote(spark, d):
    v = vo.vote(_event_candidates(spark, d), key="qid", none_label="error")
    return v.withColumn("share", F.round("share", 6))


def q_vote_status(spark, d):
    v = vo.vote(_event_candidates(spark, d), key="qid", none_label="error",
                tie_policy="none_of_above")
    return v.select("qid", "winner", "status", "all_same")


def _doc_predictions(spark, d):
    docs = sh.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.select("doc_id", "lang", "source", (F.col("n_chars") > 500).cast("int").alias("pred"))


def q_accuracy(spark, d):
    return ev.accuracy(_doc_predictions(spark, d), sh.table(spark, d, "labels"), key="doc_id",
                       pred_col="pred", truth_col="quality")


def q_accuracy_by_group(spark, d):
    return ev.accuracy(_doc_predictions(spark, d), sh.table(spark, d, "labels"), key="doc_id",
                       pred_col="pred", truth_col="quality", by=["lang", "source"])


def q_compare_runs(spark, d):
    o, r = _runs(spark, d)
    return ev.compare_runs(o, r, key="qid", value_col="prediction")


def q_progress(spark, d):
    return ev.progress(sh.questions(spark, d), sh.answers(spark, d), key="qid", by="conv_id")


def q_run_metrics(spark, d):
    e = sh.table(spark, d, "events").select(F.col("event_type").alias("step"),
                                            F.col("value").alias("seconds"))
    return ev.run_metrics(e, "step", "seconds")


def _cache_split(spark, d):
    e = sh.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "props")
    cutoff = F.lit(CACHE_CUTOFF).cast("timestamp_ntz")
    early = e.filter(F.col("ts") < cutoff).select(
        "event_type", "user_id", "event_id",
        F.when(F.col("event_type") == "error", F.lit("Error")).otherwise(F.col("props")).alias("answer"))
    cache = rs.latest(ca.cacheable(early, "answer"), key=["event_type", "user_id"],
                      order=["event_id"], values=["answer"]).select("event_type", "user_id", "answer")
    requests = e.filter(F.col("ts") >= cutoff).select("event_id", "event_type", "user_id")
    return ca.split_cached(requests, cache, ["event_type", "user_id"], value_col="answer")


def q_cache_hits(spark, d):
    hits, _ = _cache_split(spark, d)
    return hits.select("event_id", "event_type", "user_id", "answer")


def q_cache_misses(spark, d):
    _, misses = _cache_split(spark, d)
    return misses


# Answers between two saves of the log.
SAVE_EVERY = 50


def q_checkpoint_marks(spark, d):
    from quire.operators.ordering import checkpoint_marks

    log = sh.event_log(spark, d).select("qid", "seq")
    return checkpoint_marks(log, ["seq"], SAVE_EVERY).select("seq", "running_count",
                                                             "is_checkpoint")


def q_repeat_passes(spark, d):
    q = sh.questions(spark, d).select("qid")
    return gr.repeat_passes(q, N_PASSES).withColumn("pass_idx", F.col("pass_idx").cast("long"))


def q_append_log(spark, d):
    o = sh.event_log(spark, d, "original").withColumn("run", F.lit("original"))
    r = sh.event_log(spark, d, "retry").withColumn("run", F.lit("retry"))
    log = rs.append_log(o, r)
    return log.groupBy("qid").agg(
        F.count_if(F.col("run") == "original").alias("n_original"),
        F.count_if(F.col("run") == "retry").alias("n_retry"),
        F.count(F.lit(1)).alias("n_total"))


def q_backoff_schedule(spark, d):
    e = sh.table(spark, d, "events").select("event_id", "event_type")
    cls = rp.retry_class(failure_message())
    initial = F.when(F.col("event_id") % 2 == 0, F.lit(inf.BACKOFF_CONTEXT[0])) \
        .otherwise(F.lit(inf.BACKOFF_REWRITE[0]))
    retryable = e.filter(cls == "retryable").select("event_id", initial.alias("initial_s"))
    n = inf.BACKOFF_REWRITE[2]
    s = retryable.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return s.select("event_id", F.col("attempt").cast("long").alias("attempt"),
                    inf.backoff_delay(F.col("initial_s"), F.col("attempt")).alias("delay_s"))


def q_preview_text(spark, d):
    docs = sh.table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", tx.preview("text").alias("preview"))


def q_infer_replay(spark, d):
    q = sh.questions(spark, d).select("qid", "conv_id", tx.py_strip("question").alias("prompt"))
    out = inf.infer(q, "prompt", inf.PrefixResponder("A: ", 20), keep=["qid"],
                    group_col="conv_id", max_retries=0)
    return out.select("qid", "reply", "error", "attempts")


def q_answer_run(spark, d):
    return runs.answer_run(spark, d).select("qid", "conv_id", "turn", "pred")


def q_two_step_answer(spark, d):
    return runs.two_step_answer(spark, d)


def q_two_step_model(spark, d):
    return runs.two_step_model(spark, d)


def q_repeat_vote(spark, d):
    return runs.repeat_vote(spark, d, passes=N_PASSES)


def q_context_run(spark, d):
    return runs.context_run(spark, d)


def q_fact_check_run(spark, d):
    return runs.fact_check_run(spark, d)


def q_rewrite_run(spark, d):
    return runs.rewrite_run(spark, d).withColumn("context", F.array_join("context", "|"))


def q_snapshot_run(spark, d):
    return runs.snapshot_run(spark, d)


def q_one_group_check(spark, d):
    return runs.one_group_check(spark, d, ONE_GROUP)


def q_compare_modes(spark, d):
    return runs.compare_modes(spark, d)


def q_three_step_run(spark, d):
    return runs.three_step_run(spark, d)


def q_three_rounds(spark, d):
    return runs.three_rounds(spark, d)


def q_interrupted_run(spark, d):
    return runs.interrupted_run(spark, d)


def q_batch_failures(spark, d):
    """Contexts in six batches of conversations, one of which dies."""
    from quire.plans.batches import batched_context_run

    return batched_context_run(spark, d, retry=runs.NO_RETRY)


def q_rewrite_resume(spark, d):
    from quire.plans.logged import rewrite_resume

    return rewrite_resume(spark, d).withColumn("context", F.array_join("context", "|"))


def q_retry_old_run(spark, d):
    from quire.plans.logged import retried_contexts

    return retried_contexts(spark, d)


# Runs against a model that refuses some prompts for good.


def q_two_step_failures(spark, d):
    return runs.two_step_model(spark, d, candidates_factory=FailingResponder(CandidateResponder(4)))


def q_context_failures(spark, d):
    failing = FailingResponder(ContextResponder(), message="529 overloaded")
    return runs.context_run(spark, d, first_factory=failing, retry_factory=failing,
                            retry=(0.001, 0.0, 2)).drop("corrected_question")


def q_fact_check_failures(spark, d):
    return runs.fact_check_run(spark, d, FailingResponder(VerdictResponder()))


def q_rewrite_failures(spark, d):
    failing = FailingResponder(RewriteResponder(runs.REWRITE_START, runs.REWRITE_END))
    return runs.rewrite_run(spark, d, failing).withColumn("context", F.array_join("context", "|"))


def q_infer_attempts(spark, d):
    """A model that is overloaded at the first call of some prompts."""
    q = sh.questions(spark, d).select("qid", "conv_id", tx.py_strip("question").alias("prompt"))
    out = inf.infer(q, "prompt", FlakyResponder(inf.PrefixResponder("A: ", 20)), keep=["qid"],
                    group_col="conv_id", initial_backoff=0.001, jitter=0.0)
    return out.select("qid", "reply", "error", "attempts")


def q_error_structs(spark, d):
    """Each event as a context step that failed in one of the five ways."""
    e = sh.table(spark, d, "events").select("event_id", failure_message().alias("m"))
    k = F.col("event_id") % 5
    record = (F.when(k == 0, rp.call_error_struct("m", 3)).when(k == 1, rp.task_error_struct())
              .when(k == 2, rp.batch_error_struct("m")).when(k == 3, rp.row_error_struct("m"))
              .otherwise(rp.parse_error_struct()))
    e = e.select("event_id", record.alias("r"))
    return e.select("event_id", "r.context", "r.is_contextual", "r.explanation",
                    rp.context_failed("r.context").alias("failed"))


def q_open_vote(spark, d):
    """Lines of the documents as candidates of open questions."""
    docs = sh.table(spark, d, "documents").select("doc_id", F.col("text").alias("reply"))
    rows = vo.open_labels(vo.candidate_rows(docs, key="doc_id", reply_col="reply"))
    return vo.vote(rows, key="doc_id").select("doc_id", F.md5("winner").alias("winner_md5"), "votes",
                                              "n_candidates", "n_labels")


def q_media_answers(spark, d):
    """The model is given the address of each question's media, and the path of
    the local file where the listing has one (files written here, one per
    even conversation, and listed, both by tasks)."""
    from quire.session import scratch_path
    from quire.sources import io
    from quire.sources.media_tree import write_media_tree

    folder = scratch_path(spark, "media")
    q = sh.questions(spark, d).withColumn("video_id", F.col("conv_id").cast("string"))
    write_media_tree(q.where("conv_id % 2 = 0").select("video_id"), folder)
    media = io.media_files(spark, folder, "*.parquet", levels=1)
    media = media.groupBy("media_id").agg(F.min("media_path").alias("media_path"))
    asked = io.attach_media(q, media).select(
        "qid", "conv_id", F.concat(F.lit("https://v/"), "video_id").alias("url"),
        F.when(F.col("has_media"), F.concat(F.lit("file "), "video_id")).alias("media_path"),
        tx.py_strip("question").alias("prompt"))
    out = inf.infer(asked, "prompt", MediaResponder(), keep=["qid"], group_col="conv_id",
                    context_cols=["url", "media_path"], max_retries=0)
    return out.select("qid", "reply", "error")


def q_media_tree(spark, d):
    """Texts of all documents written as files below folders of language and
    source; the tree is listed by tasks, and file sizes are summed by folder."""
    from quire.session import scratch_path
    from quire.sources import io

    folder = scratch_path(spark, "media-tree")
    sh.table(spark, d, "documents").select("lang", "source", "text") \
        .write.partitionBy("lang", "source").text(folder)
    files = io.media_files(spark, folder, "*.txt", levels=2)
    part = r"/lang=([^/]+)/source=([^/]+)/[^/]+$"
    return (files.groupBy(F.regexp_extract("media_path", part, 1).alias("lang"),
                          F.regexp_extract("media_path", part, 2).alias("source"))
            .agg(F.sum("length").alias("total_bytes")))


def q_json_tables(spark, d):
    """User turns written as JSON rows with explicit nulls and read back."""
    from quire.session import scratch_path
    from quire.sources import io

    path = scratch_path(spark, "json")
    q = sh.questions(spark, d).join(sh.answers(spark, d), on="qid", how="left").select(
        "qid", "question", "answer")
    io.write_json_rows(q, path)
    return spark.read.schema(q.schema).json(path)


def q_json_array(spark, d):
    """Turns stored as JSON arrays of mixed items: the rows that are read, and the
    items that are none with what is wrong with them."""
    import json

    import pandas as pd

    from quire.session import scratch_path
    from quire.sources import io, json_array

    def arrays(batches):
        """A file per partition: user turns as records, assistant turns as bare
        texts, the others as records whose turn is a text."""
        first = "["
        for pdf in batches:
            lines = []
            for c in pdf.itertuples(index=False):
                row = {"qid": f"{c.conv_id}-{c.turn}", "question": c.text,
                       "turn": c.turn if c.role == "user" else f"turn {c.turn}"}
                lines.append(first + json.dumps(c.text if c.role == "assistant" else row))
                first = ","
            yield pd.DataFrame({"value": lines}, dtype="str")
        yield pd.DataFrame({"value": ["[]" if first == "[" else "]"]})

    path = scratch_path(spark, "json-array")
    turns = sh.table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    turns.repartition(4, "conv_id").mapInPandas(arrays, "value STRING").write.text(path)
    schema = T.StructType([T.StructField("qid", T.StringType()),
                           T.StructField("question", T.StringType()),
                           T.StructField("turn", T.LongType())])
    none = F.lit(None)
    good = io.read_json_array(spark, path, schema).select(
        "qid", "question", "turn", none.cast("string").alias("reject"))
    item = F.col("item")
    bare = F.get_json_object(F.concat(F.lit("["), item, F.lit("]")), "$[0]")
    bad = json_array.rejects(spark, path, schema).select(
        F.get_json_object(item, "$.qid").alias("qid"),
        F.when(F.col("reject") == "wrong type", F.get_json_object(item, "$.question"))
        .otherwise(bare).alias("question"), none.cast("long").alias("turn"), "reject")
    return good.unionByName(bad)


def q_multiple_choice(spark, d):
    """Which candidate replies list options, and their answers' format."""
    r = _candidate_replies(spark, d)
    return r.select("doc_id", rp.is_multiple_choice("reply").alias("is_mc"))


def q_csv_roundtrip(spark, d):
    """The user turns written as a question CSV (quoted text with real
    newlines and quotes) and read back with the question-CSV reader."""
    from quire.session import scratch_path
    from quire.sources import io

    path = scratch_path(spark, "questions-csv")
    q = sh.questions(spark, d).select("qid", "conv_id", "turn", "question")
    io.write_questions_csv(q, path)
    back = io.read_questions_csv(spark, path, schema=io.csv_schema(q.schema), with_pos=False)
    return back.select("qid", "question")


def q_csv_blocks(spark, d):
    """The user turns written in order as question CSV and read in blocks of
    64 KiB, cut at the true ends of records; each with its place in the files."""
    from quire.operators.ordering import global_index
    from quire.session import scratch_path
    from quire.sources import csv_blocks, io

    path = scratch_path(spark, "blocks-csv")
    q = sh.questions(spark, d).select("qid", "conv_id", "turn", "question")
    io.write_questions_csv(q.orderBy("conv_id", "turn"), path)
    back = csv_blocks.read_csv(spark, path, io.csv_schema(q.schema), block=1 << 16)
    return global_index(back.select("qid", "question", "pos"), ["pos"], col="place").drop("pos")


def q_replay_recorded(spark, d):
    """Offline inference: the assistant turns are the recorded replies of the
    user turns; questions without a recording get an error row."""
    q = sh.questions(spark, d).select("qid")
    rec = sh.answers(spark, d).select("qid", F.col("answer").alias("reply"))
    return inf.replay(q, rec, key=["qid"]).select("qid", "reply", "error", "attempts")


def q_stream_resume(spark, d):
    from quire.streaming.resume import demo_resume

    return demo_resume(spark, d)


def q_run_log(spark, d):
    """Calls and attempts of each round of the three-round run."""
    from quire.session import scratch_path

    path = scratch_path(spark, "rounds-log")
    runs.three_rounds(spark, d, path)
    return runs.run_log(spark, path).select("run_id", "n_calls", "n_attempts")


def q_clamped_candidates(spark, d):
    """Candidate counts outside the bounds, and unset ones."""
    e = sh.table(spark, d, "events").select("event_id", "event_type", "user_id")
    n = F.when(F.col("event_type") != "view", F.col("user_id") - 20)
    return e.select("event_id", tx.clamp_candidates(n).alias("n"))


def q_group_keys(spark, d):
    """Media addresses, some with blanks around them, as grouping keys."""
    p = sh.table(spark, d, "pages").select(
        "page_id", F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("\t"), "url", F.lit(" ")))
        .otherwise(F.col("url")).alias("url"))
    return p.select("page_id", gr.group_key("url").alias("group_key"))


def q_index_in_group(spark, d):
    return gr.index_in_group(sh.questions(spark, d).select("qid", "conv_id", "turn"), "conv_id",
                             pos="turn").select("qid", "idx_in_group")


def q_nan_values(spark, d):
    e = sh.table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .otherwise(F.col("value")).alias("value"))
    return en.nan_to_null(e)


QUERIES = {
    "unanswered": q_unanswered,
    "semi_retry": q_semi_retry,
    "error_ids": q_error_ids,
    "latest_prediction": q_latest_prediction,
    "retry_overlay": q_retry_overlay,
    "retry_overlay_outer": q_retry_overlay_outer,
    "overlay_counts": q_overlay_counts,
    "complete_results": q_complete_results,
    "enrich_left": q_enrich_left,
    "snapshot_inner": q_snapshot_inner,
    "prepare_answer_input": q_prepare_answer_input,
    "reorder_to_input": q_reorder_to_input,
    "submission_rows": q_submission_rows,
    "combine_question_prompt": q_combine_question_prompt,
    "question_fallback": q_question_fallback,
    "context_chunks": q_context_chunks,
    "bullet_context": q_bullet_context,
    "render_prompt": q_render_prompt,
    "context_prompts": q_context_prompts,
    "clean_rewrite": q_clean_rewrite,
    "rewrite_or_fallback": q_rewrite_or_fallback,
    "rewrite_summary": q_rewrite_summary,
    "parse_reply": q_parse_reply,
    "parse_verdict": q_parse_verdict,
    "reply_status": q_reply_status,
    "retry_class": q_retry_class,
    "validate_rows": q_validate_rows,
    "group_questions": q_group_questions,
    "video_batches": q_video_batches,
    "filter_group": q_filter_group,
    "candidate_rows": q_candidate_rows,
    "answer_format": q_answer_format,
    "media_lookup": q_media_lookup,
    "candidate_vote": q_candidate_vote,
    "vote_status": q_vote_status,
    "accuracy": q_accuracy,
    "accuracy_by_group": q_accuracy_by_group,
    "compare_runs": q_compare_runs,
    "progress": q_progress,
    "run_metrics": q_run_metrics,
    "cache_hits": q_cache_hits,
    "cache_misses": q_cache_misses,
    "repeat_passes": q_repeat_passes,
    "checkpoint_marks": q_checkpoint_marks,
    "append_log": q_append_log,
    "backoff_schedule": q_backoff_schedule,
    "preview_text": q_preview_text,
    "infer_replay": q_infer_replay,
    "answer_run": q_answer_run,
    "stream_resume": q_stream_resume,
    "compacted_log": lambda spark, d: runs.compacted_rounds(spark, d),
    "two_step_answer": q_two_step_answer,
    "two_step_model": q_two_step_model,
    "repeat_vote": q_repeat_vote,
    "context_run": q_context_run,
    "fact_check_run": q_fact_check_run,
    "rewrite_run": q_rewrite_run,
    "snapshot_run": q_snapshot_run,
    "one_group_check": q_one_group_check,
    "compare_modes": q_compare_modes,
    "three_step_run": q_three_step_run,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_blocks": q_csv_blocks,
    "replay_recorded": q_replay_recorded,
    "three_rounds": q_three_rounds,
    "interrupted_run": q_interrupted_run,
    "batch_failures": q_batch_failures,
    "rewrite_resume": q_rewrite_resume,
    "retry_old_run": q_retry_old_run,
    "two_step_failures": q_two_step_failures,
    "context_failures": q_context_failures,
    "fact_check_failures": q_fact_check_failures,
    "rewrite_failures": q_rewrite_failures,
    "infer_attempts": q_infer_attempts,
    "error_structs": q_error_structs,
    "open_vote": q_open_vote,
    "media_answers": q_media_answers,
    "media_tree": q_media_tree,
    "json_tables": q_json_tables,
    "json_array_items": q_json_array,
    "multiple_choice": q_multiple_choice,
    "run_log": q_run_log,
    "clamped_candidates": q_clamped_candidates,
    "group_keys": q_group_keys,
    "index_in_group": q_index_in_group,
    "nan_values": q_nan_values,
}
