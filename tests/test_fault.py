"""Task failures: a Python worker that dies mid-task is retried by Spark, and
the failed attempt leaves nothing in the answer log (one commit per round)."""

import json
import os
import subprocess
import sys
import tempfile

from support import ROOT, SF_SMALL


def test_answer_run_survives_task_failures():
    script = os.path.join(ROOT, "tests", "scripts", "task_failure_run.py")
    marks = os.path.join(tempfile.mkdtemp(prefix="quire-kills-"), "marks")
    proc = subprocess.run([sys.executable, script, SF_SMALL, marks], capture_output=True,
                          text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    line = [x for x in proc.stdout.splitlines() if x.startswith("{")][-1]
    got = json.loads(line)
    assert got["killed_attempts"] > 0  # workers really died mid-task
    assert got["rows"] == got["distinct_qids"] > 0
    assert got["errors"] == 0
    # Every question answered exactly once in the first round, despite the
    # killed attempts.
    assert got["log_rows_run0"] == got["log_distinct_run0"] == got["rows"]
