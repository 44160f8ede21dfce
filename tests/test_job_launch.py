"""The documented launch command, in both modes."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("mode", ["General", "Product"])
def test_job_runs_as_a_script(mode, data_path, tmp_path):
    out = str(tmp_path / "out")
    command = [sys.executable, os.path.join(ROOT, "peerrank/plans/job.py"), mode, "true", data_path("demo_reviews.csv"), out, "20", "2", "2", "0"]
    env = os.environ | {"PYTHONPATH": "", "PYSPARK_SUBMIT_ARGS": "--conf spark.ui.enabled=false pyspark-shell"}
    done = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert all(os.path.exists(f"{out}{x}/_SUCCESS") for x in ("", "_trace", "_runlog"))
    again = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert again.returncode != 0 and "output exists" in again.stderr
