"""A model step whose workers die once per task, with a ledger; prints what was
asked and what came out."""

import json
import os
import sys
import tempfile

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))]

from pyspark.sql import SparkSession  # noqa: E402

from quire.operators import infer as inf  # noqa: E402
from quire.operators.ledger import new_ledger  # noqa: E402


class Dying:
    """Notes each call; the worker of a task's first attempt dies at its sixth."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        import time
        import uuid

        from pyspark import TaskContext

        folder, calls = self.folder, [0]

        def answer(prompt):
            calls[0] += 1
            dying = TaskContext.get().attemptNumber() == 0 and calls[0] == 6
            open(os.path.join(folder, f"{'killed' if dying else 'asked'}-{uuid.uuid4().hex}"), "w").close()
            if dying:
                time.sleep(1)  # the rows before it are in the ledger by now
                os._exit(3)
            return prompt

        return answer


def main():
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    folder, path = tempfile.mkdtemp(), tempfile.mkdtemp()
    df = spark.createDataFrame([(f"q{i}", f"p{i}") for i in range(30)], "qid string, prompt string")
    out = inf.infer(df, "prompt", Dying(folder), partitions=2, max_in_flight=1,
                    ledger=new_ledger(path, rows=1, seconds=0.0)).collect()
    names = os.listdir(folder)
    print(json.dumps({"rows": len(out), "distinct": len({r["qid"] for r in out}), "asked": len(names),
                      "killed": sum(n.startswith("killed") for n in names)}))


if __name__ == "__main__":
    main()
