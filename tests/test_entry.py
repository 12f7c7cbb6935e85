"""The entry without the training-data operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_entry_imports_without_the_training_data_package(tmp_path):
    keep = shutil.ignore_patterns(".git", "__pycache__", "llm", "*.json", "*.txt", ".pytest_cache")
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=keep)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert len(q) > 100 and set(s) == set(q), set(s) ^ set(q); assert not any(n.startswith('op1') for n in q)"
    for without_pipeline in (False, True):
        if without_pipeline and (copy / "corpus_pipeline.py").exists():
            (copy / "corpus_pipeline.py").unlink()
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": str(copy)})
        assert done.returncode == 0, done.stderr
