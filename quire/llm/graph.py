"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Edges a task contracts to a forest before the rounds begin.
EDGES_PER_TASK = 300_000


def forests(edges: DataFrame) -> DataFrame:
    """The edges of each task as stars around the smallest id they connect: as
    many rows as vertices at most, whatever the number of edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(v: int) -> int:
            while (p := parent.setdefault(v, v)) != v:
                parent[v] = v = parent.setdefault(p, p)
            return v

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        stars = [(root(v), v) for v in list(parent)]
        stars = [(r, v) for r, v in stars if r != v]
        if stars:
            a, b = zip(*stars, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])

    parts = max(1, -(-edges.count() // EDGES_PER_TASK))
    return edges.coalesce(parts).mapInArrow(run, "a long, b long")


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): for each end of ``edges`` (a, b) the smallest id it is
    connected to. Every round takes the smallest label around each vertex and
    then the label of that label, so paths shorten by powers of two; a round is
    written to the shared folder before the next reads it."""
    edges = written(forests(edges.select("a", "b").where("a <> b")), "forests")
    both = written(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component"))
                     .withColumnRenamed("a", "id"), "components")
    while True:
        around = both.join(labels, both["b"] == labels["id"]).select(
            F.col("a").alias("id"), "component", F.lit(None).cast("long").alias("own"))
        near = around.unionByName(labels.withColumn("own", F.col("component"))).groupBy("id").agg(
            F.min("component").alias("near"), F.min("own").alias("own"))
        far = near.select(F.col("id").alias("_id"), F.col("near").alias("far"))
        new = written(near.join(far, near["near"] == far["_id"], "left").select(
            "id", F.coalesce("far", "near").alias("component"),
            (F.coalesce("far", "near") < F.col("own")).alias("changed")), "components")
        labels = new.select("id", "component")
        if not new.where("changed").limit(1).count():
            return labels
