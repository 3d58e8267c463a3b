"""Logs whose batches are merged into a base."""

import os

import pytest
from pyspark.sql import functions as F

from quire.operators import resume as rs
from quire.plans import runs
from quire.session import scratch_path
from quire.sources import compact as cp
from quire.sources import io

from support import rows

ERR = "Error: Processing failed after retries"
LOG = "run_id INT, seq LONG, qid STRING, prediction STRING"


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test-compact")


def _round(spark, path, run_id, *answers):
    io.append_log(spark.createDataFrame(
        [(run_id, i, q, p) for i, (q, p) in enumerate(answers)], LOG), path, f"round-{run_id}")


def _read(spark, path):
    log = io.load_log(spark, path, LOG)
    got = rs.overlay_runs(log, original=None, won_col="won")
    ids = spark.createDataFrame([(q,) for q in "abcdez"], "qid STRING")
    return (sorted(rows(got, "qid", "prediction", "source", "first_seq", "won"), key=str),
            sorted(rows(rs.unanswered(ids, log, key="qid"))),
            sorted(rows(cp.unanswered(spark, ids, path, LOG))), runs.next_round(log))


def _three(spark, path):
    _round(spark, path, 0, ("a", "1"), ("b", ERR), ("c", "x"), ("c", ERR), ("d", ERR), (None, ERR))
    _round(spark, path, 1, ("b", ERR), ("c", "2"), ("d", ERR), (None, "0"))
    _round(spark, path, 2, ("b", "3"), ("d", ERR), ("a", ERR))


def _files(path):
    return sorted(os.path.join(d, f) for d, _, files in os.walk(path.removeprefix("file:"))
                  for f in files if f.endswith(".parquet"))


def test_what_is_read_stays_the_same(spark, path):
    _three(spark, path)
    before = _read(spark, path)
    for _ in range(2):
        cp.compact(spark, path, LOG, buckets=4)
        assert _read(spark, path) == before
    # A later round comes on top of the base, and into the next one.
    _round(spark, path, 3, ("d", "4"), ("e", "5"))
    after = _read(spark, path)
    assert after != before and after[1] == after[2] == [("z",)]
    cp.compact(spark, path, LOG, buckets=4)
    assert _read(spark, path) == after


def test_an_empty_log_has_no_base(spark, path):
    cp.compact(spark, path, LOG)
    assert io.current_base(spark, path) is None and io.load_log(spark, path, LOG).count() == 0


def test_a_driver_lost_before_the_swap_changes_nothing(spark, path, monkeypatch):
    _three(spark, path)
    before = _read(spark, path)
    with monkeypatch.context() as m:
        m.setattr(cp, "swap", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            cp.compact(spark, path, LOG, buckets=4)
    assert _read(spark, path) == before
    cp.compact(spark, path, LOG, buckets=4)
    assert _read(spark, path) == before


def test_a_driver_lost_while_sweeping_changes_nothing(spark, path, monkeypatch):
    _three(spark, path)
    before = _read(spark, path)
    cp.compact(spark, path, LOG, buckets=4)
    os.remove(next(f for f in _files(path) if "/_commits/" in f))  # the first step of a sweep
    assert _read(spark, path) == before
    cp.compact(spark, path, LOG, buckets=4)
    assert _read(spark, path) == before


def test_files_do_not_grow_with_the_rounds(spark, path):
    sizes = []
    for n in range(6):
        _round(spark, path, n, ("a", ERR), ("b", str(n)))
        if n % 2:
            cp.compact(spark, path, LOG, buckets=2)
            cp.sweep(spark, path)
            assert not [f for f in _files(path) if "/_rows/" in f or "/_commits/" in f]
            sizes.append((len([f for f in _files(path) if "/_base/" in f]),
                          io.load_log(spark, path, LOG).count()))
    assert sizes == [sizes[0]] * 3


def test_the_base_is_joined_without_a_shuffle(spark, path):
    _three(spark, path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cp.compact(spark, path, LOG, buckets=n)
    spark.sql(f"DROP TABLE {cp._table(io.current_base(spark, path)['generation'])}")  # a new session
    ids = spark.range(100).select(F.col("id").cast("string").alias("qid"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = cp.base_table(spark, path, LOG)
        plan = rs.unanswered(ids, base, key="qid")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1 and f"SelectedBucketsCount: {n}" in plan
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x)
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
    assert exchange < scan and "Range" in "".join(lines[exchange:scan])
