"""Candidate answers as rows, and the vote among them.

The two-step answer asks for N candidates and then for one answer. The
candidate text is split into rows here and the choice is a table vote:
most votes wins, "none of the above" only when nothing else was proposed,
ties go to the earliest candidate (or to "none of the above" by policy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.replies import NONE_OF_ABOVE, option_label
from quire.functions.text import nonblank, py_strip


def candidate_rows(replies: DataFrame, key: str = "qid", reply_col: str = "reply") -> DataFrame:
    """One row per non-blank line of each reply: ``(key, pos, text, label)``.

    ``pos`` is the line number in the reply; ``label`` the leading option
    letter or NULL (an open-ended candidate). A per-row explode: no shuffle.
    """
    lines = replies.select(key, F.posexplode(F.split(F.col(reply_col), "\n", -1))
                           .alias("pos", "text"))
    return (lines.filter(nonblank("text"))
            .select(key, "pos", "text", option_label("text").alias("label")))


def open_labels(candidates: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    """Candidates of open questions vote by their text: where there is no option
    letter, the label is the candidate's text without its line number, spaces
    around it or letter case."""
    bare = F.lower(py_strip(F.regexp_replace(F.col(text), r"^\s*\d+[.)]\s*", "")))
    return candidates.withColumn(label, F.coalesce(F.col(label), F.nullif(bare, F.lit(""))))


def vote(candidates: DataFrame, key: str = "qid", label: str = "label", pos: str = "pos",
         none_label: str = NONE_OF_ABOVE, tie_policy: str = "first",
         expected: DataFrame | None = None) -> DataFrame:
    """One row per key: ``winner, votes, n_candidates, n_labels, share,
    n_top, all_same, status``.

    - the winner is the label with most votes, never ``none_label`` when
      another label exists; ties go to the earliest first occurrence
      (``tie_policy='first'``) or to ``none_label`` (``'none_of_above'``);
    - ``status``: ``ok``, ``tie``, ``all_none`` (only ``none_label`` was
      proposed; no winner) or ``no_candidates`` (an expected key without any
      labelled candidate).

    The first aggregate is partial (map-side), so a hot key collapses to at
    most one row per distinct label before the second step.
    """
    if tie_policy not in ("first", "none_of_above"):
        raise ValueError(f"unknown tie policy {tie_policy!r}")
    per = (candidates.filter(F.col(label).isNotNull())
           .groupBy(key, label)
           .agg(F.count(F.lit(1)).alias("votes"), F.min(pos).alias("first_pos")))
    not_none = F.col(label) != F.lit(none_label)
    # Rows per key here are distinct labels only.
    w = Window.partitionBy(key)
    per = per.withColumn("_top", F.max(F.when(not_none, F.col("votes"))).over(w))
    rank = F.struct(not_none.cast("int").alias("a"), F.col("votes").alias("b"),
                    (-F.col("first_pos")).alias("c"), F.col(label).alias("label"))
    agg = per.groupBy(key).agg(
        F.max(F.when(not_none, rank)).alias("_best"),
        F.sum("votes").alias("n_candidates"),
        F.count(F.lit(1)).alias("n_labels"),
        F.count_if(not_none & (F.col("votes") == F.col("_top"))).alias("n_top"),
    )
    tie = F.col("n_top") > 1
    winner = F.col("_best")["label"]
    if tie_policy == "none_of_above":
        winner = F.when(tie, F.lit(none_label)).otherwise(winner)
    votes = F.coalesce(F.col("_best")["b"], F.lit(0)).cast("long")
    status = (F.when(F.col("_best").isNull(), F.lit("all_none"))
              .when(tie, F.lit("tie")).otherwise(F.lit("ok")))
    out = agg.select(
        key, winner.alias("winner"), votes.alias("votes"), "n_candidates", "n_labels",
        (votes / F.col("n_candidates")).alias("share"), "n_top",
        (F.col("n_labels") == 1).alias("all_same"), status.alias("status"))
    if expected is not None:
        exp = expected.select(key).distinct()
        out = exp.join(out, on=key, how="left").select(
            key, "winner", F.coalesce("votes", F.lit(0)).alias("votes"),
            F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"),
            F.coalesce("n_labels", F.lit(0)).alias("n_labels"), "share",
            F.coalesce("n_top", F.lit(0)).alias("n_top"),
            F.coalesce("all_same", F.lit(False)).alias("all_same"),
            F.coalesce("status", F.lit("no_candidates")).alias("status"))
    return out
