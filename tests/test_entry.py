"""The contract without the part on training text."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SAYS = """
import __spark_entry__ as contract
import checks
assert contract.queries().keys() == checks.QUERIES.keys(), contract.queries().keys() ^ checks.QUERIES.keys()
assert contract.oracle_sql().keys() == checks.ORACLES.keys()
"""


def copied(to: Path, *, pipeline: bool) -> Path:
    """The repository without the folders on training text."""
    for name in ("framewright", "checks"):
        shutil.copytree(ROOT / name, to / name, ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
    for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, to / name)
    return to


def test_without_training_text(tmp_path):
    for pipeline in (False, True):
        at = copied(tmp_path / str(pipeline), pipeline=pipeline)
        env = os.environ | {"PYTHONPATH": str(at)}
        done = subprocess.run([sys.executable, "-c", SAYS], cwd=at, env=env, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
