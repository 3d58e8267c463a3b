import os
import tempfile

from pyspark.sql import functions as F

from quire.operators import infer as inf
from quire.plans.runs import LOG_SCHEMA, answer_run
from quire.session import scratch_path
from quire.sources import io

from support import SF_SMALL, rows


def _echo(text, n=20):
    import hashlib

    return f"A: {text[:n]} #{hashlib.md5(text.encode()).hexdigest()[:8]}"


def _flaky():
    """Fails with a retryable message on the first call per prompt (in one task)."""
    def factory():
        seen = set()

        def respond(p):
            if p not in seen:
                seen.add(p)
                raise RuntimeError("429 rate limit")
            return "ok:" + p

        return respond

    return factory


def _broken():
    def factory():
        def respond(p):
            raise RuntimeError("403 permission denied")

        return respond

    return factory


def test_infer_retries_and_records_failures(spark):
    df = spark.createDataFrame([("a", "p1"), ("b", "p2")], "qid string, prompt string")
    out = {r["qid"]: r for r in inf.infer(df, "prompt", _flaky(), partitions=2,
                                          initial_backoff=0.01, jitter=0).collect()}
    assert out["a"]["reply"] == "ok:p1" and out["a"]["attempts"] == 2 and out["a"]["error"] is None
    bad = inf.infer(df, "prompt", _broken(), partitions=2, initial_backoff=0.01).collect()
    assert all(r["reply"] is None and "403" in r["error"] and r["attempts"] == 1 for r in bad)


def test_infer_grouped_and_empty(spark):
    df = spark.createDataFrame([(str(i), i % 2, f"p{i}") for i in range(20)],
                               "qid string, g long, prompt string")
    out = inf.infer(df, "prompt", inf.PrefixResponder("A: ", 2), group_col="g", partitions=4)
    assert sorted(r["reply"] for r in out.collect()) == sorted(_echo(f"p{i}", 2) for i in range(20))
    assert inf.infer(df.limit(0), "prompt", _broken()).count() == 0


def test_replay_missing_is_error(spark):
    q = spark.createDataFrame([("a",), ("b",)], "qid string")
    rec = spark.createDataFrame([("a", "x")], "qid string, reply string")
    got = sorted(rows(inf.replay(q, rec), "qid", "reply", "error"))
    assert got == [("a", "x", None), ("b", None, "Error: No recorded reply")]


def test_backoff_schedule():
    assert inf.backoff_delays(2.0, 3) == [2.0, 4.0, 8.0]
    assert inf.classify_failure("HTTP 503") == "retryable"
    assert inf.classify_failure("404 not found") == "fatal"


def test_answer_run_retries_and_is_idempotent(spark):
    log_path = scratch_path(spark, "test-answer-log")
    out = answer_run(spark, SF_SMALL, log_path=log_path)
    res = out.collect()
    assert res and all(r["pred"].startswith("A:") for r in res)
    log = io.load_log(spark, log_path, LOG_SCHEMA)
    n0 = log.filter("run_id = 0").count()
    n1 = log.filter("run_id = 1").count()
    assert n0 == len(res) and 0 < n1 < n0
    # Second run over the same log: nothing new to answer, nothing failed.
    again = answer_run(spark, SF_SMALL, log_path=log_path).collect()
    log = io.load_log(spark, log_path, LOG_SCHEMA)
    assert log.count() == n0 + n1
    assert sorted(map(tuple, again)) == sorted(map(tuple, res))


def test_csv_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="quire-csv-")
    path = os.path.join(d, "q.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(",qid,video_id,question_type,capability,question,duration,question_prompt,answer,youtube_url\n")
        f.write('0,0008-0,v1,primary,c,"He said ""hi""\nthen left\\nok",8.85,,,https://x/v1 \n')
        f.write("7,0008-1,v1,primary,c,plain,15.06,p,,https://x/v1\n")
    q = io.read_questions_csv(spark, path)
    got = {r["qid"]: r for r in q.collect()}
    # Doubled quotes, a real newline and a literal backslash-n are kept as written.
    assert got["0008-0"]["question"] == 'He said "hi"\nthen left\\nok'
    assert got["0008-0"]["duration"] == 8.85 and "_c0" not in q.columns
    assert got["0008-0"]["pos"] < got["0008-1"]["pos"]
    # A NULL prediction is written as an empty string; qid stays text.
    preds = spark.createDataFrame([(" 0008-0 ", None), ("0008-1", " x ")], "qid string, prediction string")
    out = os.path.join(d, "sub")
    io.write_submission(io.submission(preds), out, order=("qid",))
    back = spark.read.schema("qid string, pred string").option("header", True).csv(out)
    assert sorted(rows(back.fillna(""))) == [("0008-0", ""), ("0008-1", "x")]


def test_json_array_source(spark):
    d = tempfile.mkdtemp(prefix="quire-json-")
    path = os.path.join(d, "a.json")
    with open(path, "w") as f:
        f.write('[{"qid": "1", "prediction": "A"}, 5, {"qid": "2", "prediction": null}]')
    df = io.read_json_array(spark, path, spark.createDataFrame([], "qid string, prediction string").schema)
    assert sorted(rows(df)) == [("1", "A"), ("2", None)]


def test_load_missing_log_is_empty(spark):
    assert io.load_log(spark, "/tmp/quire-does-not-exist-xyz", LOG_SCHEMA).count() == 0


def test_media_listing(spark):
    d = tempfile.mkdtemp(prefix="quire-media-")
    for name in ("v1.mp4", "v2.mp4", "notes.txt"):
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"xx")
    media = io.media_files(spark, d)
    q = spark.createDataFrame([("a", "v1"), ("b", "v3")], "qid string, video_id string")
    got = {r["qid"]: r["has_media"] for r in io.attach_media(q, media).collect()}
    assert got == {"a": True, "b": False}
    assert media.filter(F.col("media_id") == "notes").count() == 0


def test_context_run_retries_only_failures(spark):
    from quire.plans.runs import CONTEXT_LOG_SCHEMA, context_run

    log_path = scratch_path(spark, "test-context-log")
    out = context_run(spark, SF_SMALL, log_path=log_path).collect()
    assert out and all(not r["context"].startswith("Error:") for r in out)
    log = io.load_log(spark, log_path, CONTEXT_LOG_SCHEMA)
    first = log.filter("run_id = 0")
    failed = first.filter(F.col("prediction.context").startswith("Error:")).count()
    assert failed > 0 and log.filter("run_id = 1").count() == failed


def test_checkpoint_dir_is_read_from_session(spark):
    from quire.session import checkpoint_dir

    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()


def test_corrupt_log_fails_loudly(spark):
    # A corrupt log is an error, not an empty log (which would re-answer everything).
    import pytest

    d = tempfile.mkdtemp(prefix="quire-badlog-")
    with open(os.path.join(d, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        io.load_log(spark, d, LOG_SCHEMA).count()


def test_rate_limit_spreads_calls():
    import time as _t

    from quire.operators.calls import TokenBucket

    bucket = TokenBucket(20.0)
    t0 = _t.monotonic()
    for _ in range(6):
        bucket.take()
    assert _t.monotonic() - t0 >= 0.2  # 6 calls at 20/s need at least 5 gaps of 50 ms


def test_answer_with_cache_reuses_answers_but_not_errors(spark):
    import glob

    from quire.operators import cache as ca

    path = scratch_path(spark, "test-cache")
    req = spark.createDataFrame([("1", "m", "u", "q1", 1), ("2", "m", "u", "q1", 1),
                                 ("3", "m", "u", "q2", 1)],
                                "qid string, mode string, url string, question string, n int")

    def answer(keys):
        return keys.withColumn("answer", F.when(F.col("question") == "q2", F.lit("Error"))
                               .otherwise(F.concat(F.lit("a:"), "question")))

    first = sorted(rows(ca.answer_with_cache(req, path, answer), "qid", "answer"))
    assert first == [("1", "a:q1"), ("2", "a:q1"), ("3", "Error")]
    second = sorted(rows(ca.answer_with_cache(req, path, answer), "qid", "answer"))
    assert second == first
    batches = sorted(glob.glob(path.replace("file:", "") + "/_batch-*"), key=lambda p: __import__("os").path.getmtime(p))
    sizes = [spark.read.parquet(b).count() for b in batches]
    # First call: the two distinct keys; second call: only the error key again.
    assert sorted(sizes) == [1, 2]


def test_json_sink_keeps_nulls_and_template_source(spark):
    import glob

    d = tempfile.mkdtemp(prefix="quire-sink-")
    df = spark.createDataFrame([("1", None)], "qid string, answer string")
    io.write_json_rows(df, os.path.join(d, "out"))
    text = "".join(open(p).read() for p in glob.glob(os.path.join(d, "out", "*.json")))
    assert '"answer":null' in text  # S8: null fields are written, not dropped
    tpl = os.path.join(d, "t.txt")
    with open(tpl, "w") as f:
        f.write("Q: {question}\nN={n}\n")
    assert io.read_template(spark, tpl) == "Q: {question}\nN={n}\n"  # S9: read once, whole


def test_submission_csv_writes_empty_prediction(spark):
    import glob

    d = tempfile.mkdtemp(prefix="quire-sub-")
    preds = spark.createDataFrame([("q1", None), ("q2", "B")], "qid string, prediction string")
    io.write_submission(io.submission(preds), os.path.join(d, "s"), order=("qid",))
    body = "".join(open(p).read() for p in sorted(glob.glob(os.path.join(d, "s", "*.csv"))))
    lines = [x for x in body.splitlines() if x and x != "qid,pred"]
    # A missing prediction is an empty field, not the text "None".
    assert lines == ['q1,""', "q2,B"]


def test_json_array_source_pretty_printed(spark):
    import json as _json

    d = tempfile.mkdtemp(prefix="quire-json2-")
    path = os.path.join(d, "a.json")
    with open(path, "w") as f:
        _json.dump([{"qid": "0008-0", "prediction": "A"}, "junk",
                    {"qid": "0008-1", "prediction": None}], f, indent=2)
    schema = spark.createDataFrame([], "qid string, prediction string").schema
    assert sorted(rows(io.read_json_array(spark, path, schema))) == [("0008-0", "A"),
                                                                     ("0008-1", None)]


def _peak_tracker():
    def factory():
        import threading
        import time as _time

        lock = threading.Lock()
        state = {"now": 0, "peak": 0}

        def respond(p):
            with lock:
                state["now"] += 1
                state["peak"] = max(state["peak"], state["now"])
            _time.sleep(0.02)
            with lock:
                state["now"] -= 1
                return str(state["peak"])

        return respond

    return factory


def test_infer_caps_calls_in_flight(spark):
    df = spark.createDataFrame([(str(i), f"p{i}") for i in range(60)], "qid string, prompt string")
    peaks = [int(r["reply"]) for r in inf.infer(df, "prompt", _peak_tracker(), partitions=2,
                                                 max_in_flight=3).collect()]
    assert max(peaks) <= 3 and max(peaks) >= 2


def test_checkpoint_dir_never_local_on_a_cluster():
    import pytest

    from quire.session import ensure_checkpoint_dir

    class _Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

        def set(self, k, v):
            self[k] = v

    class _Sc:
        master = "spark://cluster:7077"

        def __init__(self, d=None):
            self.d = d

        def getCheckpointDir(self):
            return self.d

        def getConf(self):
            return _Conf()

        def setCheckpointDir(self, d):
            self.d = d

    class _Spark:
        def __init__(self, sc, conf):
            self.sparkContext, self.conf = sc, conf

    with pytest.raises(RuntimeError, match="shared folder"):
        ensure_checkpoint_dir(_Spark(_Sc(), _Conf()))
    # A named shared folder is read, never replaced.
    shared = _Spark(_Sc(), _Conf({"spark.checkpoint.dir": "hdfs://nn/ckpt"}))
    assert ensure_checkpoint_dir(shared) == "hdfs://nn/ckpt"
    assert shared.sparkContext.d == "hdfs://nn/ckpt"
