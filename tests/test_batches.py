"""Batches that fail alone, rewrites that resume, and the retry of an old run."""

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from quire.operators import infer as inf
from quire.operators import ledger as led
from quire.operators.responders import ContextResponder, GoesDown, RewriteResponder
from quire.plans import batches as ba
from quire.plans import logged, runs
from quire.plans import shapes as sh
from quire.session import scratch_path
from quire.sources import io
from support import SF_SMALL

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def frame(spark, n=24, groups=6):
    return spark.createDataFrame([(f"q{i:02}", i % groups, i, f"prompt {i}") for i in range(n)],
                                 "qid string, conv_id long, turn long, prompt string")


def test_groups_stay_whole_and_in_order(spark):
    q = ba.in_batches(frame(spark), 4)
    dealt = {(r["conv_id"], r["batch_idx"]) for r in q.collect()}
    assert dealt == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (5, 2)} and q.count() == 24
    assert ba.in_batches(frame(spark).limit(0), 4).count() == 0


def test_a_batch_that_dies_leaves_error_rows_and_its_finished_part(spark):
    path = scratch_path(spark, "batch-log")
    q = ba.in_batches(frame(spark), 3)

    def factory(batch):
        answers = inf.PrefixResponder("A: ", 20)
        return {0: answers, 1: GoesDown(answers, lambda p: p == "prompt 20"), 2: ba.NoClient()}[batch]

    failed = ba.batched_round(spark, q, path, runs.LOG_SCHEMA, factory, runs.answer_rows(),
                              ba.answer_error_rows, parallel=3, retry=runs.NO_RETRY, save=(1, 0.0))
    assert sorted(failed) == [1, 2] and failed[2] == f"RuntimeError: {ba.NoClient.MESSAGE}"
    assert GoesDown.MESSAGE in failed[1]
    log = io.load_log(spark, path, runs.LOG_SCHEMA)
    got = {r["qid"]: r["prediction"] for r in log.collect()}
    assert log.count() == len(got) == 24 and led.batches_in_progress(path) == []
    by_batch = {r["qid"]: r["batch_idx"] for r in q.collect()}
    for qid, text in got.items():
        if by_batch[qid] == 0:
            assert text.startswith("A: ")
        if by_batch[qid] == 2:
            assert text == f"Error during processing: RuntimeError: {ba.NoClient.MESSAGE}"
    assert got["q20"].startswith("Error during processing")
    # The failed ids are asked again like any others, in a later round.
    ids = log.where(F.col("prediction").startswith("Error")).select("qid")
    runs.answer_round(spark, q, path, inf.PrefixResponder("B: ", 20), ids=ids)
    now = runs.current_answers(spark, path).collect()
    assert len(now) == 24 and not any(r["prediction"].startswith("Error") for r in now)


def test_batches_resume_from_the_log(spark):
    path = scratch_path(spark, "batch-resume")
    q = ba.in_batches(frame(spark), 3)
    runs.answer_round(spark, q.where("batch_idx < 2"), path, inf.PrefixResponder("A: ", 20))
    assert ba.batched_round(spark, q, path, runs.LOG_SCHEMA, lambda b: inf.PrefixResponder("B: ", 20),
                            runs.answer_rows(), ba.answer_error_rows) == {}
    log = io.load_log(spark, path, runs.LOG_SCHEMA)
    assert log.count() == 24 and log.where("prediction LIKE 'B: %'").count() == 8
    # Nothing left: no batch, no row.
    assert ba.batched_round(spark, q, path, runs.LOG_SCHEMA, lambda b: ba.NoClient(), runs.answer_rows(),
                            ba.answer_error_rows) == {}
    assert io.load_log(spark, path, runs.LOG_SCHEMA).count() == 24


def test_root_cause():
    text = ("Job aborted\nTraceback (most recent call last):\n  File \"a\", line 1, in f\n    g()\n"
            "ValueError: first\n\nDuring handling:\n\nTraceback (most recent call last):\n"
            "  File \"b\", line 2, in g\nRuntimeError: second: with colon\n\tat org.x\n")
    assert ba.root_cause(Exception(text)) == "RuntimeError: second: with colon"
    assert ba.root_cause(ValueError("plain\nmore")) == "ValueError: plain"


def items(spark):
    rows = [("a", 1, "Why?", "It rains. He runs."), ("b", 1, None, "x."), ("c", 2, "When?", None),
            ("d", 2, "Where?", " . "), ("e", 3, "Who?", "A man."), ("f", 3, "What now?", "A dog.")]
    return spark.createDataFrame([(*r, f"u{r[1]}", f"v{r[1]}") for r in rows],
                                 "qid string, conv_id long, question string, context string, "
                                 "youtube_url string, video_id string")


class Fails:
    def __init__(self, question):
        self.question = question

    def __call__(self):
        inner, question = RewriteResponder(runs.REWRITE_START, runs.REWRITE_END)(), self.question

        def answer(prompt):
            if question in prompt:
                raise RuntimeError("403 permission denied")
            return inner(prompt)

        return answer


def test_rewrites_by_a_log(spark):
    path, df = scratch_path(spark, "rewrites"), items(spark)
    before = {r["qid"]: r for r in logged.rewritten(spark, df, path).collect()}
    assert before["a"]["rewrite_status"] == "pending" and before["a"]["corrected_question"] == "Why?"
    logged.rewrite_round(spark, df, path, Fails("Who?"), retry=runs.NO_RETRY)
    one = {r["qid"]: r for r in logged.rewritten(spark, df, path).collect()}
    assert one["e"]["rewrite_status"] == "error" and one["e"]["corrected_question"] == "Who?"
    assert "403" in one["e"]["error"] and one["e"]["youtube_url"] == "u3" and one["e"]["video_id"] == "v3"
    assert {q: one[q]["skip_reason"] for q in "bcd"} == {
        "b": "missing_question", "c": "null_context", "d": "no_chunks"}
    assert all(one[q]["rewrite_status"] == "skipped" for q in "bcd") and one["a"]["context"] == ["It rains", "He runs"]
    # Resumed: all that can be asked are in the log, failed ones too; they take a round of their own.
    logged.rewrite_round(spark, df, path, Fails("?"), retry=runs.NO_RETRY)
    assert io.load_log(spark, path, logged.REWRITE_LOG_SCHEMA).count() == 3
    logged.rewrite_round(spark, df, path, Fails("nothing"), failed_only=True, retry=runs.NO_RETRY)
    log = io.load_log(spark, path, logged.REWRITE_LOG_SCHEMA)
    assert log.count() == 4 and log.where("run_id = 1").first()["qid"] == "e"
    two = {r["qid"]: r for r in logged.rewritten(spark, df, path).collect()}
    assert two["e"]["error"] is None and two["e"]["rewrite_status"] in ("changed", "unchanged", "empty")


def test_retry_of_an_old_run(spark):
    questions = sh.questions(spark, SF_SMALL).limit(6).select("qid", "conv_id", "turn", "question").cache()
    ids = [r["qid"] for r in questions.orderBy("qid").collect()]
    ok, bad = ("fine", True, "x", None), ("Error: Processing failed after retries", False, "y", None)
    rows = [(ids[0], 1, ok), (ids[1], 1, ok), (ids[1], 2, bad), (ids[2], 5, bad), (ids[3], 1, bad),
            (ids[3], 2, ok), ("unknown", 1, bad)]
    old = spark.createDataFrame(rows, "qid string, seq long, prediction struct<context string, "
                                      "is_contextual boolean, explanation string, corrected_question string>")

    class Half:
        def __call__(self):
            inner, seen = ContextResponder()(), []

            def answer(prompt):
                return inner(prompt)

            return answer

    path = scratch_path(spark, "old-retry")
    out = {r["qid"]: r for r in logged.retry_old_run(spark, old, questions, Half(), path, runs.NO_RETRY).collect()}
    assert sorted(out) == ids
    assert [out[i]["asked_again"] for i in ids[:4]] == [False, True, True, False]
    assert out[ids[0]]["context"] == out[ids[3]]["context"] == "fine"
    assert out[ids[1]]["context"].startswith("seen ") and out[ids[2]]["context"].startswith("seen ")
    assert out[ids[4]]["context"] is None and not out[ids[4]]["asked_again"]
    # A second call over the same retry log asks nothing and gives the same rows.
    again = logged.retry_old_run(spark, old, questions, ba.NoClient(), path, runs.NO_RETRY)
    assert sorted(again.collect()) == sorted(out.values())
    # No failure in the old log: nothing is asked.
    none = logged.retry_old_run(spark, old.where("qid = 'none'"), questions, ba.NoClient(),
                                scratch_path(spark, "old-retry"), runs.NO_RETRY)
    assert none.where("context IS NOT NULL").count() == 0 and none.count() == 6
