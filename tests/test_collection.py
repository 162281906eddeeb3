"""The whole tree can be collected in one run, whatever folders are in it."""

import subprocess
import sys
from pathlib import Path


def test_all_files_are_collected():
    here = Path(__file__).resolve().parent
    done = subprocess.run([sys.executable, "-m", "pytest", str(here), "--collect-only", "-q", "-p", "no:cacheprovider"],
                          capture_output=True, text=True, cwd=here.parent)
    assert done.returncode == 0, done.stdout[-2000:]
    files = {path.name for path in here.rglob("test_*.py")}
    assert {line.split("::")[0].rpartition("/")[2] for line in done.stdout.splitlines() if "::" in line} == files
    assert done.stdout.count("test_query_equals_oracle[") >= 34
