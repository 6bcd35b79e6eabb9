"""The loaders on a Hive-format table, as the reference defines it (own JVM with Hive support)."""

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_loaders_on_hive_format_table():
    script = os.path.join(ROOT, "tests", "scripts", "hive_tables.py")
    workdir = tempfile.mkdtemp(prefix="salesflow-hive-")
    out = subprocess.run(
        [sys.executable, script, ROOT], capture_output=True, text=True, timeout=600, check=True, cwd=workdir
    ).stdout
    result = json.loads(out.strip().splitlines()[-1])
    assert result["catalog"] == "hive" and result["provider"] == ["hive"]
    assert result["first"] == 6
    # Overwriting with one row of home goods/2022/01 replaced that partition (2 rows -> 1), kept the others.
    assert [tuple(x) for x in result["after"]] == [
        ("home goods", "01"), ("home goods", "10"), ("home goods", "10"), ("sport", "01"), ("sport", "10"),
    ]
    assert len(result["partitions"]) == 4
