"""Answer run where every task's first attempt dies mid-way (the Python
worker exits). Run in its own process with a master that retries tasks;
prints one JSON line with what the log holds."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from quire.operators.infer import PrefixResponder  # noqa: E402
from quire.plans.runs import LOG_SCHEMA, answer_run  # noqa: E402
from quire.session import ensure_checkpoint_dir, scratch_path  # noqa: E402
from quire.sources import io  # noqa: E402


class DiesOnFirstAttempt:
    """Kills its Python worker on the first attempt of every task, after
    answering a few rows (so a partial output exists when it dies); leaves a
    marker file per kill in ``marks``."""

    def __init__(self, marks):
        self.marks = marks

    def __call__(self):
        import uuid

        from pyspark import TaskContext

        inner = PrefixResponder()()
        seen = [0]
        marks = self.marks

        def respond(prompt):
            ctx = TaskContext.get()
            seen[0] += 1
            if ctx is not None and ctx.attemptNumber() == 0 and seen[0] > 2:
                os.makedirs(marks, exist_ok=True)
                open(os.path.join(marks, uuid.uuid4().hex), "w").close()
                os._exit(3)
            return inner(prompt)

        return respond


def main():
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(spark)
    log_path = scratch_path(spark, "fault-log")
    marks = sys.argv[2]
    out = answer_run(spark, sys.argv[1], log_path=log_path, first_factory=DiesOnFirstAttempt(marks),
                     retry_factory=DiesOnFirstAttempt(marks))
    res = out.collect()
    log = io.load_log(spark, log_path, LOG_SCHEMA)
    print(json.dumps({
        "rows": len(res),
        "distinct_qids": len({r["qid"] for r in res}),
        "errors": sum(1 for r in res if r["pred"].startswith("Error")),
        "log_rows_run0": log.filter("run_id = 0").count(),
        "log_distinct_run0": log.filter("run_id = 0").select("qid").distinct().count(),
        "killed_attempts": len(os.listdir(marks)) if os.path.isdir(marks) else 0,
    }))


if __name__ == "__main__":
    main()
