"""Resumable, incremental answering of arriving question files.

A file-source stream keeps what it knows of every id (answered or failed, and
how often it was asked) as state, spread over buckets of ids. A question that
arrives is looked up in the state of its bucket, asked if it has no answer yet,
and the outcome goes into the state and, as one commit per micro-batch, into the
answer log. The log itself is never read back. ``availableNow`` processes what
has arrived and stops; the checkpoint folder remembers files and state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quire.functions.text import py_strip
from quire.operators import infer as inf
from quire.operators import ledger as led
from quire.operators.calls import Calls, retry_schedule
from quire.plans import shapes as sh
from quire.session import scratch_path
from quire.sources import io

ARRIVAL_SCHEMA = T.StructType([
    T.StructField("qid", T.StringType()), T.StructField("conv_id", T.LongType()),
    T.StructField("prompt", T.StringType()),
])
STREAM_LOG_SCHEMA = "qid STRING, reply STRING, error STRING, asked LONG, batch_id LONG"
_ANSWERED = T.StructType([
    T.StructField("qid", T.StringType()), T.StructField("reply", T.StringType()),
    T.StructField("error", T.StringType()), T.StructField("asked", T.LongType()),
])
_KEY = T.StructType([T.StructField("qid", T.StringType())])
_OUTCOME = T.StructType([T.StructField("answered", T.BooleanType()),
                         T.StructField("asked", T.LongType())])
# Settings of the stream: state on disk, outside the JVM heap; no micro-batches
# without arrivals (what is too old is dropped when it is looked up).
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def id_bucket(buckets: int, col: str = "qid"):
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def stream_answers(log: DataFrame) -> DataFrame:
    """One answer per id of a stream log: the first that is no failure, else the
    last failure; ``asked`` is how often the id was asked."""
    good = F.when(F.col("error").isNull(), F.col("batch_id"))
    pair = F.struct("reply", "error")
    agg = log.groupBy("qid").agg(F.min_by(pair, good).alias("g"),
                                 F.max_by(pair, F.col("batch_id")).alias("l"),
                                 F.max("asked").alias("asked"))
    return agg.select("qid", F.coalesce("g.reply", "l.reply").alias("reply"),
                      F.when(F.col("g").isNull(), F.col("l.error")).alias("error"), "asked")


class Answering(StatefulProcessor):
    """The questions of one bucket of ids: those the state has no answer for are
    asked, a few at a time, and what came of it is kept.

    Finished rows are saved as they come, in a folder of the micro-batch: a batch
    that Spark runs again finds them there and does not ask for them again."""

    def __init__(self, responder_factory, log_path: str, in_flight: int, retry_in,
                 keep_seconds: float | None, save_rows: int):
        self.factory, self.log_path, self.in_flight = responder_factory, log_path, in_flight
        self.retry_in, self.save_rows = retry_in, save_rows
        self.keep_ms = int(keep_seconds * 1000) if keep_seconds else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", _KEY, _OUTCOME, self.keep_ms)
        self.respond = self.book = None

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for qid, error, asked in zip(initialState["qid"].tolist(), initialState["error"].tolist(),
                                     initialState["asked"].tolist(), strict=True):
            self.known.updateValue((qid,), (error is None, int(asked)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        if self.respond is None:
            self.respond = self.factory()
            batch = TaskContext.get().getLocalProperty("streaming.sql.batchId")
            self.book = progress(self.log_path, batch).task(_ANSWERED, ["qid"])
        calls = Calls(self.respond, self.in_flight, self.retry_in)
        room, seen, unsaved = 4 * self.in_flight, {}, []
        try:
            for pdf in rows:
                found = []
                for qid, prompt in zip(pdf["qid"].tolist(), pdf["prompt"].tolist(), strict=True):
                    if qid in seen:
                        continue
                    old = self.known.getValue((qid,))
                    seen[qid] = 1 + (int(old[1]) if old else 0)
                    if old and old[0]:
                        continue
                    saved = self.book.finished.get((qid,))
                    if saved is not None:
                        found.append((qid, saved["reply"], saved["error"], seen[qid]))
                    else:
                        calls.put(qid, (prompt,))
                    while calls.open >= room:
                        unsaved += self._finish(calls.take(1, room, inf.FLUSH_SECONDS), seen)
                        unsaved, out = self._save(unsaved, self.save_rows)
                        if out is not None:
                            yield out
                if found:
                    yield self._remember(found)
            while calls.open or calls.answers:
                unsaved += self._finish(calls.take(self.save_rows, 1, inf.FLUSH_SECONDS), seen)
                unsaved, out = self._save(unsaved, self.save_rows)
                if out is not None:
                    yield out
            out = self._save(unsaved, 1)[1]
            if out is not None:
                yield out
        except BaseException:
            calls.close()
            self._save(unsaved + self._finish(calls.answers, seen), 1)
            raise
        finally:
            calls.close()

    @staticmethod
    def _finish(answers, seen: dict) -> list[tuple]:
        return [(a.ref, a.reply, a.error, seen[a.ref]) for a in answers]

    def _save(self, done: list[tuple], least: int):
        """Save finished rows once there are ``least``: what is left, and their output."""
        if len(done) < least:
            return done, None
        self.book.write(_frame(done))
        return [], self._remember(done)

    def _remember(self, done: list[tuple]) -> pd.DataFrame:
        for qid, _, error, asked in done:
            self.known.updateValue((qid,), (error is None, asked))
        return _frame(done)

    def close(self) -> None:
        self.respond = self.book = None


def _frame(done: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(done, columns=_ANSWERED.names)


def progress(log_path: str, batch) -> led.Ledger:
    """The ledger of a micro-batch."""
    return led.new_ledger(f"{log_path}/_stream", batch=f"batch-{batch}")


def resume_stream(spark: SparkSession, source_path: str, log_path: str, checkpoint: str,
                  responder_factory, schema: T.StructType = ARRIVAL_SCHEMA,
                  files_per_batch: int | None = None, buckets: int | None = None,
                  max_in_flight: int = 5, retry: tuple = inf.BACKOFF_REWRITE,
                  keep_seconds: float | None = None, save_rows: int = 100,
                  known: DataFrame | None = None):
    """Start an ``availableNow`` query answering new questions; returns the
    started query (call ``awaitTermination()``).

    A question is asked when it arrives and its id has no answer in the state:
    ids that arrive again are dropped, those whose answer failed are asked again.
    What is known of an id is forgotten ``keep_seconds`` after its last answer
    (None: never). ``known`` (qid, error, asked; one row per id, such as
    :func:`stream_answers` of an older log) is taken as state by the first
    micro-batch of a new checkpoint. A NULL id is a key like any other.

    State is spread by a hash of the id over ``buckets`` (fixed for a checkpoint;
    by default four per shuffle partition), so no group of questions is hot; a
    task asks for ``max_in_flight`` questions of one bucket at a time and holds
    the ids, not the prompts, of the bucket's arrivals in one micro-batch.
    """
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    initial, jitter, retries = retry
    processor = Answering(responder_factory, log_path.rstrip("/"), max(1, max_in_flight),
                          retry_schedule(inf.classify_failure, retries, initial, jitter, False),
                          keep_seconds, max(1, save_rows))

    def commit(batch: DataFrame, batch_id: int) -> None:
        # A batch that runs again replaces its rows in the log. That this one
        # began means that the state of the one before is there for good.
        led.forget(*_folder(log_path, batch_id - 1))
        io.append_log(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), log_path,
                      f"stream-{batch_id}")

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    bucket = id_bucket(n).alias("bucket")
    arrivals = reader.parquet(source_path).select("qid", "prompt", bucket)
    start = None
    if known is not None:
        start = known.select("qid", "error", F.col("asked").cast("long").alias("asked"), bucket) \
            .groupBy("bucket")
    answers = arrivals.groupBy("bucket").transformWithStateInPandas(
        processor, _ANSWERED, "Append", "ProcessingTime" if keep_seconds else "None",
        initialState=start)
    writer = (answers.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    try:  # a stream keeps the settings it began with; the session gets its own back
        for name, value in _SETTINGS.items():
            spark.conf.set(name, value)
        return writer.start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _folder(log_path: str, batch_id: int) -> tuple[str, str]:
    ledger = progress(log_path.rstrip("/"), batch_id)
    return ledger.path, ledger.batch


def demo_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user turns arrive as several files, and the opening ones of each
    conversation twice more; the stream answers each question once. The first
    arrivals meet a model that refuses some prompts for good, and of those the
    ones sent again get their answer. ``asked``: how often each was asked."""
    base = scratch_path(spark, "stream")
    source, log_path, ckpt = f"{base}/arrivals", f"{base}/log", f"{base}/checkpoint"
    q = sh.questions(spark, sf_dir).select("qid", "conv_id", "turn",
                                           py_strip("question").alias("prompt"))
    opening = q.filter(F.col("turn") == 0).drop("turn")

    def arrive(rows: DataFrame, files: int, model) -> None:
        rows.repartitionByRange(files, "conv_id").write.mode("append").parquet(source)
        resume_stream(spark, source, log_path, ckpt, model, files_per_batch=3).awaitTermination()

    arrive(q.drop("turn"), 4, inf.PrefixResponder("A: ", 20, fail_when=lambda p: len(p) % 4 == 0,
                                                  message="403 permission denied"))
    arrive(opening, 2, inf.PrefixResponder("A: ", 20))
    # What has its answer by now is not asked a third time.
    arrive(opening, 2, inf.PrefixResponder("C: ", 20))
    return stream_answers(io.load_log(spark, log_path, STREAM_LOG_SCHEMA))
