"""A model round as several jobs, which fail one by one.

The questions are dealt to batches of whole groups, and each batch is a Spark job
of its own: in a job group (so that one can be cancelled) and in a scheduler pool
(so that batches share the cluster fairly where the session schedules FAIR). A
batch whose job dies keeps what its tasks had saved, gets an error row for every
other question of it, and the other batches go on.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import infer as inf
from quire.operators import ledger as led
from quire.operators import resume as rs
from quire.plans.runs import next_round, recover_rounds, retrying
from quire.session import scratch_path
from quire.sources import io

#: Tasks that write a batch's questions.
WRITERS = 8
_LAST_FRAME = re.compile(r"Traceback \(most recent call last\):\n(?:[ \t].*\n)+(\S.*)")


def root_cause(exc: BaseException) -> str:
    """The line that a failed task's Python traceback ends with (``Type: text``);
    the first line of the error itself where there is none."""
    found = _LAST_FRAME.findall(str(exc))
    text = found[-1] if found else f"{type(exc).__name__}: {exc}"
    return text.strip().splitlines()[0]


def batched_round(spark: SparkSession, questions: DataFrame, log_path: str, schema: str,
                  factory_of: Callable[[int], object], to_rows, error_rows,
                  group_col: str = "conv_id", batch_col: str = "batch_idx", parallel: int = 4,
                  retry: tuple = inf.BACKOFF_CONTEXT, save: tuple[int, float] = (1000, 60.0),
                  pool: str = "batches") -> dict[int, str]:
    """One round over the ``questions`` (qid, group, prompt, ``batch_col``) that
    the log lacks; the batches that failed, with what failed them.

    ``factory_of(batch)`` gives the responder factory; ``to_rows(output of infer,
    round)`` and ``error_rows(questions, message, round)`` give the log's rows. At
    most ``parallel`` batches run at once. Batches are jobs, so there are few of
    them (hundreds); their numbers pass through the driver, their rows do not.
    """
    raw = T.StructType([questions.schema["qid"], *inf.OUTPUT_FIELDS])
    recover_rounds(spark, log_path, schema, raw, to_rows)
    log = io.load_log(spark, log_path, schema)
    run_id = next_round(log)
    # Written once by batch, so that a batch's job reads its own rows only.
    path = scratch_path(spark, "batches")
    todo = rs.unanswered(questions.select("qid", group_col, "prompt", batch_col), log)
    (todo.repartition(F.col(batch_col), F.pmod(F.xxhash64("qid"), F.lit(WRITERS)))
     .write.partitionBy(batch_col).parquet(path))
    kept = T.StructType([f for f in todo.schema.fields if f.name != batch_col]
                        + [T.StructField(batch_col, T.LongType())])
    rows = spark.read.schema(kept).parquet(path)
    numbers = sorted(r[0] for r in rows.select(batch_col).distinct().collect())
    round_name, lock = uuid.uuid4().hex, threading.Lock()
    failed: dict[int, str] = {}

    def run(number: int) -> None:
        sc, name = spark.sparkContext, f"{round_name}-{number}"
        sc.setJobGroup(name, f"batch {number} of round {run_id}", interruptOnCancel=True)
        sc.setLocalProperty("spark.scheduler.pool", pool)
        own = rows.where(F.col(batch_col) == number).drop(batch_col)
        ledger = led.new_ledger(log_path, *save, batch=name)
        try:
            out = inf.infer(own, "prompt", factory_of(number), keep=["qid"], group_col=group_col,
                            ledger=ledger, **retrying(retry))
            io.append_log(to_rows(out, run_id), log_path, name, lock)
        except PySparkException as exc:
            failed[number] = message = root_cause(exc)
            lost, done = own, None
            if name in led.batches_in_progress(log_path):
                done = led.progress_rows(spark, log_path, name, raw, ["qid"])
                lost = rs.unanswered(own, done)
            errors = error_rows(lost, message, run_id)
            io.append_log(errors if done is None else
                          to_rows(done, run_id).unionByName(errors), log_path, name, lock)
        led.forget(log_path, name)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as threads:
        # Local properties are a thread's own; list() raises what a thread raised.
        list(threads.map(lambda n: inheritable_thread_target(spark)(run)(n), numbers))
    return failed


def context_error_rows(questions: DataFrame, message: str, run_id: int) -> DataFrame:
    """Rows of the context log for the questions of a batch that failed."""
    from quire.functions.replies import batch_error_struct

    return questions.select(
        F.lit(run_id).alias("run_id"), F.monotonically_increasing_id().alias("seq"), "qid",
        batch_error_struct(F.lit(message)).alias("prediction"))


def answer_error_rows(questions: DataFrame, message: str, run_id: int) -> DataFrame:
    """Rows of the answer log for the questions of a batch that failed."""
    from quire.functions.replies import reply_status

    return questions.select(
        F.lit(run_id).alias("run_id"), F.monotonically_increasing_id().alias("seq"), "qid",
        reply_status(F.lit(None).cast("string"), F.lit(message)).alias("prediction"),
        F.lit(0).alias("attempts"), F.lit(0.0).alias("elapsed_s"))


class NoClient:
    """A model whose client cannot be built: the tasks of its batch fail."""

    MESSAGE = "the model client cannot start"

    def __call__(self):
        raise RuntimeError(self.MESSAGE)


def in_batches(questions: DataFrame, n: int, group_col: str = "conv_id", pos: str = "turn"
               ) -> DataFrame:
    """``questions`` with ``batch_idx``: whole groups in their order of first
    appearance, as many to each of (at most) ``n`` batches."""
    from quire.operators import grouping as gr

    groups = questions.select(group_col).distinct().count()
    size = max(1, -(-groups // n))
    dealt = gr.batches(questions, key=group_col, batch_size=size, pos=pos, qid="qid")
    return questions.join(dealt.select(group_col, F.col("batch_idx").cast("long").alias("batch_idx")),
                          on=group_col, how="inner")


def batched_context_run(spark: SparkSession, sf_dir: str, log_path: str | None = None, n: int = 6,
                        broken: tuple[int, ...] = (2,), retry: tuple = inf.BACKOFF_CONTEXT
                        ) -> DataFrame:
    """Contexts of all questions in ``n`` batches of conversations; the model's
    client cannot start in the batches ``broken``."""
    from quire.functions.prompts import CONTEXT_TEMPLATE, render
    from quire.functions.text import py_strip
    from quire.operators.enrich import enrich
    from quire.operators.responders import ContextResponder
    from quire.plans import shapes as sh
    from quire.plans.runs import CONTEXT_LOG_SCHEMA, context_rows, current_contexts

    log_path = log_path or scratch_path(spark, "batched-context-log")
    questions = sh.questions(spark, sf_dir)
    q = in_batches(questions, n).select(
        "qid", "conv_id", "batch_idx",
        render(CONTEXT_TEMPLATE, question=py_strip("question")).alias("prompt"))
    batched_round(spark, q, log_path, CONTEXT_LOG_SCHEMA,
                  lambda b: NoClient() if b in broken else ContextResponder(),
                  context_rows(retry[2]), context_error_rows, retry=retry)
    out = enrich(questions.select("qid", "conv_id", "turn"),
                 current_contexts(spark, log_path).select("qid", "prediction"),
                 key="qid", how="left", question=None, prompt=None)
    return out.select("qid", "conv_id", "turn", "context", "is_contextual", "explanation")
