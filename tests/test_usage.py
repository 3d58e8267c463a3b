"""The README usage flow, end to end, with an offline responder."""

import os
import tempfile

from pyspark.sql import functions as F

from quire.functions.replies import reply_status
from quire.functions.text import combine_question
from quire.operators import infer as inf
from quire.operators import resume as rs
from quire.session import scratch_path
from quire.sources import io

LOG = "run_id INT, seq LONG, qid STRING, prediction STRING"


def test_readme_flow(spark):
    d = tempfile.mkdtemp(prefix="quire-usage-")
    csv = os.path.join(d, "questions.csv")
    with open(csv, "w") as f:
        f.write(",qid,video_id,question_type,capability,question,duration,question_prompt,answer,youtube_url\n")
        f.write("0,0008-0,v1,t,c,What moves?,8.85,(A) cat (B) dog,,u1\n")
        f.write("1,0038-7,v2,t,c,Who waves?,15.06,,,u2 \n")
        f.write("2,0008-1,v1,t,c,Why?,8.85,,,u1\n")
    questions = io.read_questions_csv(spark, csv)
    questions = questions.withColumn("prompt", combine_question("question", "question_prompt"))
    log_path = scratch_path(spark, "usage-log")

    def write_round(todo, run_id, factory):
        out = inf.infer(todo, "prompt", factory, keep=["qid"], group_col="video_id", max_retries=0)
        io.append_log(out.select(F.lit(run_id).alias("run_id"),
                                 F.monotonically_increasing_id().alias("seq"), "qid",
                                 reply_status("reply", "error").alias("prediction")), log_path)

    flaky = inf.PrefixResponder(fail_when=lambda p: p.startswith("Who"))
    write_round(rs.unanswered(questions, io.load_log(spark, log_path, LOG)), 0, flaky)
    failed = rs.error_ids(rs.overlay_runs(io.load_log(spark, log_path, LOG)))
    write_round(rs.only_ids(questions, failed), 1, inf.PrefixResponder())
    final = rs.overlay_runs(io.load_log(spark, log_path, LOG))
    ordered = rs.to_input_order(questions, final, pos=["pos"], sort=False)
    out = os.path.join(d, "submission")
    io.write_submission(io.submission(ordered, keep=("pos",)), out, order=("pos",))
    back = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .csv(out).collect())
    assert [r["qid"] for r in back] == ["0008-0", "0038-7", "0008-1"]  # input order
    assert all(r["pred"].startswith("A: ") for r in back)  # the failure was retried
    assert back[0]["pred"].startswith("A: What moves?")  # question + prompt combined
