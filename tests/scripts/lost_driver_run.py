"""An answer round whose driver is killed once some calls were made: argv is the
tables' folder, the log, and a folder that gets a file per call."""

import os
import signal
import sys

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))]

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quire.plans.runs import answer_round  # noqa: E402
from quire.plans.shapes import questions  # noqa: E402
from quire.session import ensure_checkpoint_dir  # noqa: E402

KILL_AFTER = 40


class Killing:
    """Notes each call in a folder, and kills the processes once there are enough."""

    def __init__(self, folder, pids):
        self.folder, self.pids = folder, pids

    def __call__(self):
        import uuid

        folder, pids = self.folder, self.pids

        def answer(prompt):
            if len(os.listdir(folder)) >= KILL_AFTER:
                for pid in pids:
                    os.kill(pid, signal.SIGKILL)
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(prompt)
            return "A: " + prompt

        return answer


def main():
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(spark)
    q = questions(spark, sys.argv[1]).select("qid", "conv_id", F.col("qid").alias("prompt"))
    jvm = spark.sparkContext._jvm.java.lang.ProcessHandle.current().pid()
    answer_round(spark, q, sys.argv[2], Killing(sys.argv[3], [jvm, os.getpid()]), save=(5, 0.0))


if __name__ == "__main__":
    main()
