"""Progress inside a round: lost drivers, retried tasks, delayed retries, caps."""

import json
import os
import subprocess
import sys
import tempfile
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quire.operators import infer as inf
from quire.operators import ledger as led
from quire.operators.calls import Calls, ModelDown, retry_schedule
from quire.operators.responders import GoesDown
from quire.plans import runs
from quire.plans import shapes as sh
from quire.session import scratch_path
from quire.sources import io
from support import ROOT, SF_SMALL

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Noting:
    """Writes each prompt it is asked to a folder, then answers."""

    def __init__(self, folder, inner=None):
        self.folder, self.inner = folder, inner or inf.PrefixResponder("A: ", 20)

    def __call__(self):
        import uuid

        respond, folder = self.inner(), self.folder

        def answer(prompt):
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(prompt)
            return respond(prompt)

        return answer


def noted(folder):
    return sorted(open(os.path.join(folder, n)).read() for n in os.listdir(folder))


def frame(spark, n, parts=2):
    return spark.createDataFrame([(f"q{i}", i % 3, f"prompt {i}") for i in range(n)],
                                 "qid string, conv_id long, prompt string").repartition(parts)


def test_a_lost_round_is_finished_without_asking_twice(spark):
    path, first, second = scratch_path(spark, "lost-log"), tempfile.mkdtemp(), tempfile.mkdtemp()
    q = frame(spark, 60)
    down = GoesDown(Noting(first), lambda p: p in ("prompt 41", "prompt 17"))
    with pytest.raises(Exception, match=GoesDown.MESSAGE):
        runs.answer_round(spark, q, path, down, save=(1, 0.0))
    assert io.load_log(spark, path, runs.LOG_SCHEMA).count() == 0  # not part of the log yet
    assert len(led.batches_in_progress(path)) == 1
    runs.answer_round(spark, q, path, Noting(second))
    asked = noted(first) + noted(second)
    log = io.load_log(spark, path, runs.LOG_SCHEMA)
    assert log.count() == log.select("qid").distinct().count() == 60
    assert noted(first) and len(asked) == len(set(asked)) == 60  # no answer paid for twice
    assert {r[0] for r in log.select("run_id").distinct().collect()} == {0, 1}
    assert led.batches_in_progress(path) == []
    runs.answer_round(spark, q, path, Noting(second))
    assert len(noted(second)) + len(noted(first)) == 60


def test_progress_of_a_batch_in_the_log_is_not_used_again(spark):
    path = scratch_path(spark, "done-log")
    q = frame(spark, 6)
    with pytest.raises(Exception, match=GoesDown.MESSAGE):
        runs.answer_round(spark, q, path, GoesDown(inf.PrefixResponder(), lambda p: p == "prompt 5"), save=(1, 0.0))
    batch, = led.batches_in_progress(path)
    raw = runs.T.StructType([q.schema["qid"], *inf.OUTPUT_FIELDS])
    rows = led.progress_rows(spark, path, batch, raw, ["qid"])
    io.append_log(runs.answer_rows()(rows, 0), path, batch)  # the driver dies before it forgets
    n = io.load_log(spark, path, runs.LOG_SCHEMA).count()
    assert runs.recover_rounds(spark, path, runs.LOG_SCHEMA, raw, runs.answer_rows()) == []
    assert io.load_log(spark, path, runs.LOG_SCHEMA).count() == n
    assert led.batches_in_progress(path) == []


def test_a_killed_driver_keeps_what_its_tasks_had_saved(spark):
    path, asked = scratch_path(spark, "killed-log"), tempfile.mkdtemp()
    script = os.path.join(ROOT, "tests", "scripts", "lost_driver_run.py")
    proc = subprocess.run([sys.executable, script, SF_SMALL, path, asked], capture_output=True,
                          text=True, timeout=300)
    assert proc.returncode != 0  # it was killed
    again = tempfile.mkdtemp()
    q = sh.questions(spark, SF_SMALL).select("qid", "conv_id", F.col("qid").alias("prompt"))
    runs.answer_round(spark, q, path, Noting(again))
    log = io.load_log(spark, path, runs.LOG_SCHEMA)
    total = q.count()
    assert log.count() == log.select("qid").distinct().count() == total
    saved = log.where("run_id = 0").count()
    # What was saved is not asked again; what had been asked and was not saved is.
    assert 0 < saved <= len(noted(asked)) and len(noted(again)) == total - saved


def test_a_task_that_runs_again_does_not_ask_again():
    script = os.path.join(ROOT, "tests", "scripts", "task_retry_run.py")
    proc = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=300)
    assert proc.returncode == 0, proc.stderr[-2000:]
    got = json.loads([x for x in proc.stdout.splitlines() if x.startswith("{")][-1])
    assert got["killed"] > 0 and got["rows"] == got["distinct"] == 30
    assert got["asked"] == 30 + got["killed"]  # only the call that died was made twice


class Slow:
    """Tells when each call ended; the first prompt fails once, with a delay."""

    def __call__(self):
        seen = set()

        def answer(prompt):
            if prompt == "prompt 0" and prompt not in seen:
                seen.add(prompt)
                raise RuntimeError("429 rate limit")
            return str(time.time())

        return answer


def test_a_delayed_retry_holds_no_other_row(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        out = inf.infer(frame(spark, 40), "prompt", Slow(), partitions=1, max_in_flight=2,
                        initial_backoff=1.0, jitter=0.0).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ended = {r["qid"]: float(r["reply"]) for r in out}
    assert len(ended) == 40 and {r["qid"]: r["attempts"] for r in out if r["attempts"] > 1} == {"q0": 2}
    late = ended.pop("q0")
    assert late - max(ended.values()) > 0.5  # all of the other seven Arrow batches went by meanwhile
    assert next(r["elapsed_s"] for r in out if r["qid"] == "q0") >= 1.0


def test_queue_order_and_attempts():
    tries = []

    def respond(name):
        tries.append(name)
        if name == "b" and tries.count("b") < 3:
            raise RuntimeError("503")
        if name == "d":
            raise RuntimeError("404 not found")
        return name

    calls = Calls(respond, 1, retry_schedule(inf.classify_failure, 3, 0.02, 0.0, False))
    for i, name in enumerate("abcd"):
        calls.put(i, (name,))
    out = []
    while len(out) < 4:
        out += calls.take(4, 1, 5.0)
    calls.close()
    assert tries[:4] == list("abcd") and tries[4:] == ["b", "b"]
    assert {a.ref: (a.reply, a.attempts) for a in out} == {0: ("a", 1), 1: ("b", 3), 2: ("c", 1), 3: (None, 1)}
    assert out[-1].ref == 1 and "404" in next(a.error for a in out if a.ref == 3)


def test_model_down_fails_the_task_and_not_the_row():
    def respond(name):
        raise ModelDown("no quota")

    calls = Calls(respond, 2, lambda message, failures: None)
    calls.put(0, ("a",))
    with pytest.raises(ModelDown):
        calls.take(1, 1, 5.0)
    calls.close()


def test_max_tasks_bounds_the_calls_of_all_tasks(spark):
    df = inf.infer(frame(spark, 50), "prompt", inf.PrefixResponder(), max_tasks=2)
    assert df.rdd.getNumPartitions() == 2 and df.count() == 50
    few = inf.infer(frame(spark, 50), "prompt", inf.PrefixResponder(), partitions=1, max_tasks=4)
    assert few.rdd.getNumPartitions() == 1


def test_interrupted_run_recovers_some_and_asks_the_rest(spark):
    path = scratch_path(spark, "interrupted")
    out = runs.interrupted_run(spark, SF_SMALL, path)
    assert out.where("n_logged <> 1").count() == 0
    log = io.load_log(spark, path, runs.LOG_SCHEMA)
    assert log.count() == sh.questions(spark, SF_SMALL).count() and log.where("run_id > 0").count() > 0
