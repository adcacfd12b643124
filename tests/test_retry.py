"""Observed stage counts survive a task retry (see observe_retry_check.py)."""

import os
import subprocess
import sys


def test_observed_counts_are_exact_after_a_retry():
    script = os.path.join(os.path.dirname(__file__), "observe_retry_check.py")
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert "equal True" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
