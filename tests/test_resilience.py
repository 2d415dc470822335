"""Results survive task failures and recomputation (including batch numbering)."""

import json
import os
import subprocess
import sys

from conftest import SF01

HERE = os.path.dirname(os.path.abspath(__file__))


def test_payloads_identical_after_injected_task_failures(tmp_path):
    env = dict(os.environ, CLIENTELE_FAILURE_MARKERS=str(tmp_path))
    proc = subprocess.run(
        [sys.executable, os.path.join(HERE, "resilience_run.py"), SF01],
        capture_output=True, text=True, timeout=900, env=env,
    )
    assert proc.returncode == 0, proc.stderr[-3000:]
    line = [l for l in proc.stdout.splitlines() if l.startswith("RESULT ")][-1]
    result = json.loads(line[len("RESULT "):])
    assert result["clean"] and result["failed"] == result["clean"]
    assert len(list(tmp_path.iterdir())) >= 2  # failures were injected in both places
