"""Task failures and retries: results stay exact (checkpointed operators)."""

import os
import subprocess
import sys


def test_operators_survive_a_failed_task_attempt():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_script.py")
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0 and out.stdout.strip().endswith("OK"), out.stderr[-2000:]
