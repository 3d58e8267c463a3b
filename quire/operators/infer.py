"""Batch inference over a table.

The model is an injected *responder factory*: a picklable callable that
returns a responder (``prompt -> reply text``) once per task. Rows travel to
Python as Arrow batches (``mapInPandas``); inside a task at most
``max_in_flight`` calls run at once, a token bucket keeps the task's share of
``rate_per_sec``, and retryable failures are put back in the task's queue with
exponential backoff (:mod:`quire.operators.calls`). A failure becomes a row
(``error`` set), never a failed job.

Spark may run a task twice (speculation, executor loss): callers write the
output to the log before using it, and dedupe the log last-wins. With a ledger
a task that runs again does not ask again for what it had finished.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.replies import FATAL_RE, RETRYABLE_RE
from quire.operators.calls import Answer, Calls, retry_schedule
from quire.operators.grouping import spread_for_inference
from quire.operators.ledger import Ledger

_FATAL = re.compile(FATAL_RE)
_RETRYABLE = re.compile(RETRYABLE_RE)

#: ``prompt -> reply``, or ``(prompt, row) -> reply`` where ``infer`` is given
#: ``context_cols`` (such as the media address and path): ``row`` maps them.
Responder = Callable[..., str]
ResponderFactory = Callable[[], Responder]

# Backoff schedules (initial seconds, jitter bound, retries).
BACKOFF_REWRITE = (2.0, 0.5, 3)
BACKOFF_CONTEXT = (5.0, 1.0, 3)

OUTPUT_FIELDS = [
    T.StructField("reply", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("elapsed_s", T.DoubleType()),
]


def classify_failure(message: str) -> str:
    """Python twin of :func:`quire.functions.replies.retry_class` for use
    inside the task (the decision must be taken between attempts)."""
    m = (message or "").lower()
    if _FATAL.search(m):
        return "fatal"
    if _RETRYABLE.search(m):
        return "retryable"
    return "other"


def backoff_delay(initial, attempt):
    """Delay before retry ``attempt`` (0-based), without jitter; numbers or
    columns."""
    return initial * 2.0 ** attempt if not hasattr(initial, "alias") else \
        initial * F.pow(F.lit(2.0), attempt)


def backoff_delays(initial: float, retries: int) -> list[float]:
    return [backoff_delay(initial, k) for k in range(retries)]


def infer(df: DataFrame, prompt_col: str, responder_factory: ResponderFactory,
          keep: Sequence[str] = ("qid",), partitions: int | None = None,
          group_col: str | None = None, salt_on: str = "qid",
          rows_per_task: int | None = 1000, context_cols: Sequence[str] = (),
          max_in_flight: int = 5, rate_per_sec: float | None = None, max_retries: int = 3,
          initial_backoff: float = BACKOFF_REWRITE[0], jitter: float = BACKOFF_REWRITE[1],
          retry_other: bool = False, max_tasks: int | None = None,
          ledger: Ledger | None = None, key: Sequence[str] | None = None) -> DataFrame:
    """Answer ``prompt_col`` for every row; output ``keep`` columns plus
    ``reply, error, attempts, elapsed_s``.

    Only ``keep``, the prompt and ``context_cols`` are shipped to Python (column
    pruning stops at ``mapInPandas``). Rows are dealt by one hash shuffle to as
    many tasks as ``rows_per_task`` asks for (model time per row dwarfs the
    count), or to ``partitions``; with ``group_col`` a group's rows of a task
    stand together. ``rate_per_sec`` is shared by the tasks that can run at once.

    ``max_tasks`` bounds the calls of the whole cluster: the rows go to that many
    tasks at most, so no more than ``max_tasks * max_in_flight`` calls run at any
    time, however many slots there are. Rows leave a task as they are finished,
    not in their order. ``ledger`` keeps finished rows in the shared folder, by
    ``key`` (columns of ``keep``, by default the first), while the job runs.
    """
    keep = list(keep)
    spark = df.sparkSession
    cols = list(dict.fromkeys([*keep, prompt_col, *context_cols,
                               *([group_col] if group_col else [])]))
    src = df.select(*cols)
    n = partitions or task_count(src, rows_per_task)
    n = min(n, max_tasks) if max_tasks else n
    if group_col:
        src = spread_for_inference(src, group_col, n, salt_on)
    else:
        src = src.repartition(n, F.xxhash64(*[F.col(k) for k in keep]))
    in_schema = src.schema
    out_schema = T.StructType([in_schema[k] for k in keep] + OUTPUT_FIELDS)
    slots = max(1, min(n, spark.sparkContext.defaultParallelism))
    per_task_rate = (rate_per_sec / slots) if rate_per_sec else None

    key = list(key or keep[:1])
    retry_in = retry_schedule(classify_failure, max_retries, initial_backoff, jitter, retry_other)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Nothing is built before the first row: no rows, no client.
        rows = (pdf for pdf in batches if not pdf.empty)
        first = next(rows, None)
        if first is None:
            return
        book = ledger.task(out_schema, key) if ledger else None
        task = _Task(keep, key, book, ledger.rows if ledger else FLUSH_ROWS,
                     ledger.seconds if ledger else FLUSH_SECONDS)
        calls = Calls(responder_factory(), max_in_flight, retry_in, per_task_rate)
        room = 4 * max(1, max_in_flight)
        try:
            more = True
            while more or calls.open or calls.answers:
                while more and calls.open < room:
                    pdf = first if first is not None else next(rows, None)
                    first, more = None, pdf is not None
                    if more:
                        prompts = pdf[prompt_col].tolist()
                        context = pdf[list(context_cols)].to_dict("records") if context_cols else None
                        for ref, i in task.open(pdf):
                            calls.put(ref, (prompts[i], context[i]) if context else (prompts[i],))
                        if task.known is not None:
                            yield task.known
                yield from task.close(calls.take(task.rows, room if more else 1, task.seconds))
            task.save(True)
        except BaseException:
            calls.close()
            for _ in task.close(calls.answers):
                pass
            task.save(True)
            raise
        finally:
            calls.close()

    return src.mapInPandas(run, out_schema)


#: Finished rows that leave a task together, and how long they wait for others.
FLUSH_ROWS, FLUSH_SECONDS = 1000, 5.0


class _Task:
    """The rows of one task: input frames whose rows are being answered, output
    frames of those that are, and what of it the ledger has yet to get."""

    def __init__(self, keep: list[str], key: list[str], book, rows: int, seconds: float):
        self.keep, self.key, self.book, self.rows, self.seconds = keep, key, book, rows, seconds
        self.frames: dict[int, list] = {}
        self.opened, self.unsaved, self.saved_at = 0, [], time.monotonic()
        #: Rows of the frame opened last that an earlier attempt had finished.
        self.known: pd.DataFrame | None = None

    def open(self, pdf: pd.DataFrame) -> list[tuple[tuple[int, int], int]]:
        """References of the frame's rows to be asked, with their places in it."""
        ask, done = list(range(len(pdf))), []
        if self.book and self.book.finished:
            keys = list(zip(*(pdf[k].tolist() for k in self.key), strict=True))
            done = [i for i in ask if keys[i] in self.book.finished]
            ask = [i for i in ask if keys[i] not in self.book.finished]
        self.known = None
        if done:
            found = [self.book.finished[keys[i]] for i in done]
            self.known = self._frame(pdf, done, [Answer(None, *(
                f[c.name] for c in OUTPUT_FIELDS)) for f in found])
        self.opened += 1
        if ask:
            self.frames[self.opened] = [pdf, len(ask)]
        return [((self.opened, i), i) for i in ask]

    def _frame(self, pdf: pd.DataFrame, places: list[int], answers: list[Answer]) -> pd.DataFrame:
        out = pdf[self.keep].iloc[places].reset_index(drop=True)
        for name, values in zip((c.name for c in OUTPUT_FIELDS),
                                zip(*(a[1:] for a in answers), strict=True), strict=True):
            out[name] = list(values)
        return out

    def close(self, answers: list[Answer]) -> Iterator[pd.DataFrame]:
        """The answered rows as output frames."""
        by_frame: dict[int, list[Answer]] = {}
        for a in answers:
            by_frame.setdefault(a.ref[0], []).append(a)
        for number, own in by_frame.items():
            held = self.frames[number]
            out = self._frame(held[0], [a.ref[1] for a in own], own)
            held[1] -= len(own)
            if not held[1]:
                del self.frames[number]
            if self.book:
                self.unsaved.append(out)
            yield out
        self.save(False)

    def save(self, now: bool) -> None:
        """Hand finished rows to the ledger, once there are enough of them."""
        waited = time.monotonic() - self.saved_at
        if self.unsaved and (now or waited >= self.seconds
                             or sum(map(len, self.unsaved)) >= self.rows):
            self.book.write(pd.concat(self.unsaved, ignore_index=True))
            self.unsaved, self.saved_at = [], time.monotonic()


def task_count(df: DataFrame, rows_per_task: int | None) -> int:
    """Tasks for a model step: one per ``rows_per_task`` rows, but enough to use
    the session's shuffle partitions while there are rows for them."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not rows_per_task:
        return least
    rows = df.count()
    return max(1, -(-rows // rows_per_task), min(least, rows))


def durable(df: DataFrame) -> DataFrame:
    """Materialize model output once (reliable checkpoint in the shared
    ``spark.checkpoint.dir``) before anything shuffles or reuses it: a lost
    executor then re-reads the files instead of calling the model again and
    possibly getting a different answer for rows other tasks already used."""
    return df.checkpoint(eager=True)


def replay(df: DataFrame, recorded: DataFrame, key: Sequence[str] = ("qid",),
           reply_col: str = "reply",
           missing_error: str = "Error: No recorded reply") -> DataFrame:
    """Offline inference: recorded replies as a table, joined on the key.

    A row without a recording gets ``error`` set. Same output columns as
    :func:`infer` (``attempts`` 1, ``elapsed_s`` 0).
    """
    key = list(key)
    rec = recorded.select(*key, F.col(reply_col).alias("_rep"), F.lit(True).alias("_hit"))
    j = df.select(*key).join(rec, on=key, how="left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return j.select(*key, F.col("_rep").alias("reply"),
                    F.when(hit, F.lit(None).cast("string")).otherwise(F.lit(missing_error))
                    .alias("error"),
                    F.lit(1).alias("attempts"), F.lit(0.0).alias("elapsed_s"))


class PrefixResponder:
    """A deterministic text responder (tests, benches, offline runs): ``prefix``
    + the first ``n_chars`` of the stripped prompt + ``' #'`` + the first 8 hex
    digits of the MD5 of the whole stripped prompt (so the reply depends on
    the entire text, not only its head)."""

    def __init__(self, prefix: str = "A: ", n_chars: int = 20, fail_when=None,
                 message: str = "503 service unavailable"):
        self.prefix = prefix
        self.n_chars = n_chars
        self.fail_when = fail_when
        self.message = message

    def __call__(self) -> Responder:
        import hashlib

        prefix, n, fail_when, message = self.prefix, self.n_chars, self.fail_when, self.message

        def respond(prompt: str) -> str:
            if fail_when is not None and fail_when(prompt):
                raise RuntimeError(message)
            text = (prompt or "").strip()
            digest = hashlib.md5(text.encode("utf-8")).hexdigest()[:8]
            return f"{prefix}{text[:n]} #{digest}"

        return respond
