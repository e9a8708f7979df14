"""Python tasks must run on workers that have no copy of the package."""

from __future__ import annotations

import os
import subprocess
import sys

from conftest import ROOT

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from jobweave.session import build_session
from jobweave.operators.matching import match_all_topk
from jobweave.sources.documents import extract_text
spark = build_session(master="local[2]", extra={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
left = spark.createDataFrame([("r", [1.0], ["a"])], "resume_id string, embedding array<double>, skills array<string>")
right = spark.createDataFrame([("j", [1.0], ["a"])], "job_id string, embedding array<double>, skills array<string>")
assert match_all_topk(left, right, 1).first()["score"] == 1.0
files = spark.createDataFrame([("x/cv.docx", None, 3, bytearray(b"bad"))], "path string, modificationTime timestamp, length long, content binary")
assert extract_text(files).first()["problem"] == "unreadable: BadZipFile"
print("shipped")
"""


def test_tasks_carry_their_code(new_dir):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(ROOT)], cwd=new_dir, env=environment, capture_output=True, text=True, timeout=200
    )
    assert "shipped" in done.stdout, done.stderr[-2000:]
