"""Questions that arrive as files: state by id instead of reading the log."""

import os
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException

from quire.operators import infer as inf
from quire.operators.responders import GoesDown
from quire.session import scratch_path
from quire.sources import io
from quire.streaming.resume import STREAM_LOG_SCHEMA, resume_stream, stream_answers

from support import rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])
ARRIVAL = "qid string, conv_id long, prompt string"
NO_RETRY = (0.0, 0.0, 0)


class Written:
    """Notes every call in a file of the folder, then answers or fails."""

    def __init__(self, folder, fail=()):
        self.folder, self.fail = str(folder), fail

    def __call__(self):
        def respond(prompt):
            with open(os.path.join(self.folder, "calls"), "a") as f:
                f.write(f"{prompt}\n")
            if prompt in self.fail:
                raise RuntimeError("403 permission denied")
            return f"A: {prompt}"

        return respond


class Place:
    def __init__(self, spark, folder):
        base = scratch_path(spark, "test-stream")
        self.spark, self.folder = spark, folder
        self.source, self.log, self.state = f"{base}/in", f"{base}/log", f"{base}/state"

    def arrive(self, *ids):
        self.spark.createDataFrame([(i, 1, f"p{i}") for i in ids], ARRIVAL).coalesce(1) \
            .write.mode("append").parquet(self.source)

    def answer(self, model=None, **kw):
        resume_stream(self.spark, self.source, self.log, self.state,
                      model or Written(self.folder), buckets=4, retry=NO_RETRY,
                      **kw).awaitTermination()

    def calls(self):
        with open(os.path.join(self.folder, "calls")) as f:
            return sorted(f.read().split())

    def answers(self):
        log = io.load_log(self.spark, self.log, STREAM_LOG_SCHEMA)
        return sorted(rows(stream_answers(log), "qid", "reply", "error", "asked"), key=str)


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def test_an_id_is_asked_once_and_a_failed_one_when_it_arrives_again(place):
    place.arrive("1", "2", "2", None)
    place.answer(Written(place.folder, fail=("p2",)))
    failed = "RuntimeError: 403 permission denied"
    assert place.answers() == [("1", "A: p1", None, 1), ("2", None, failed, 1),
                               (None, "A: pNone", None, 1)]
    place.arrive("1", "2", "3", None)
    place.answer()  # a restart: the state is that of the checkpoint
    assert place.answers() == [("1", "A: p1", None, 1), ("2", "A: p2", None, 2),
                               ("3", "A: p3", None, 1), (None, "A: pNone", None, 1)]
    place.answer()  # nothing new
    assert place.calls() == ["p1", "p2", "p2", "p3", "pNone"]


def test_the_log_is_not_read(place, monkeypatch):
    monkeypatch.setattr(io, "load_log", lambda *a: pytest.fail("the log was read"))
    place.arrive("1")
    place.answer()
    place.arrive("1", "2")
    place.answer()
    assert place.calls() == ["p1", "p2"]


def test_what_is_known_expires(place):
    place.arrive("1")
    place.answer(keep_seconds=1.0)
    time.sleep(1.5)
    place.arrive("1")
    place.answer(keep_seconds=1.0)
    assert place.calls() == ["p1", "p1"]


def test_an_older_log_is_taken_as_state(place):
    known = place.spark.createDataFrame([("1", None, 1), ("2", "503 unavailable", 4)],
                                        "qid string, error string, asked long")
    place.arrive("1", "2", "3")
    place.answer(known=known)
    assert place.answers() == [("2", "A: p2", None, 5), ("3", "A: p3", None, 1)]
    place.arrive("1", "3")
    place.answer(known=known)
    assert place.calls() == ["p2", "p3"]


def test_a_batch_that_runs_again_does_not_ask_again(place):
    ids = [str(i) for i in range(12)]
    place.arrive(*ids)
    down = GoesDown(Written(place.folder), lambda p: p == "p7")
    with pytest.raises(StreamingQueryException):
        place.answer(down, save_rows=1, max_in_flight=1)
    before = place.calls()
    place.answer(save_rows=1)
    assert [a[:2] for a in place.answers()] == sorted((i, f"A: p{i}") for i in ids)
    assert before and place.calls() == sorted(f"p{i}" for i in ids)
