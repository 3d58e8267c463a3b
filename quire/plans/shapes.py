"""The driver tables in the shapes the operators expect.

- questions: ``conversations`` user turns, ``qid = conv_id-turn``, group = conversation;
- answers: the assistant turn right after a user turn, keyed by that user turn's qid;
- prompts: the system turn of a conversation;
- logs: ``events`` as answer logs (``qid = user_id``, ``seq = event_id``); the
  ``error`` event type is stored as the error value ``Error``; even / odd
  ``event_id`` are the original / retry runs (two halves of one table).

Every frame reads only the columns it needs, so the Parquet scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def make_qid(conv_id, turn):
    return F.concat_ws("-", F.col(conv_id).cast("string") if isinstance(conv_id, str) else conv_id.cast("string"),
                       F.col(turn).cast("string") if isinstance(turn, str) else turn.cast("string"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return (c.filter(F.col("role") == "user")
            .select(make_qid("conv_id", "turn").alias("qid"), "conv_id", "turn",
                    F.col("text").alias("question")))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer per question: the assistant turn right after it. Turns are
    unique per conversation, so no dedupe (and no shuffle of the text) is
    needed."""
    c = table(spark, sf_dir, "conversations")
    return (c.filter(F.col("role") == "assistant")
            .select(make_qid(F.col("conv_id"), F.col("turn") - 1).alias("qid"),
                    F.col("text").alias("answer"), F.col("turn").alias("answer_turn")))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return (c.filter(F.col("role") == "system").groupBy("conv_id")
            .agg(F.min_by("text", "turn").alias("question_prompt")))


def error_value(event_type="event_type"):
    """The stored answer of an event: the error type becomes the error value."""
    et = F.col(event_type)
    return F.when(et == "error", F.lit("Error")).otherwise(et)


def event_log(spark: SparkSession, sf_dir: str, run: str | None = None) -> DataFrame:
    """``events`` as an answer log ``(qid, seq, prediction)``; ``run`` picks
    the original (even ids) or retry (odd ids) half."""
    e = table(spark, sf_dir, "events")
    if run == "original":
        e = e.filter(F.col("event_id") % 2 == 0)
    elif run == "retry":
        e = e.filter(F.col("event_id") % 2 == 1)
    elif run is not None:
        raise ValueError(run)
    return e.select(F.col("user_id").alias("qid"), F.col("event_id").alias("seq"),
                    error_value().alias("prediction"))
