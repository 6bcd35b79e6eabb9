"""A failed writer task is retried and the result stays whole (no lost or repeated rows)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_write_survives_a_failed_task():
    script = os.path.join(ROOT, "tests", "scripts", "retry_write.py")
    out = subprocess.run(
        [sys.executable, script, ROOT], capture_output=True, text=True, timeout=600, check=True
    ).stdout
    result = json.loads(out.strip().splitlines()[-1])
    assert result["failed_tasks"] >= 1, "no task failure was injected"
    assert (result["rows"], result["distinct_ids"], result["per_partition_equal"]) == (40_000, 40_000, True)
