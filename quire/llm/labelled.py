"""What the two learned scorers share: the fold rule and the bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on (all of them below that number).
SAMPLE_ROWS = 8_000


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id's text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str,
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text and label (0/1 double) of at most ``rows`` labelled documents
    outside the held-out fold, the first ones by a hash of their id. The sample
    of ids is small enough to be broadcast, so texts are not shuffled. Ids
    labelled more than once count once (the largest label); documents that
    repeat an id count once."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                           & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(F.col(label)).cast("double").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]))
