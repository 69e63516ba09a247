"""The driver's entry module without the optional folders."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), any(n == 'pipeline' or n.startswith('op1') for n in e.queries()))"


@pytest.mark.parametrize("missing", [("blocklog/llm",), ("corpus_pipeline.py",), ("blocklog/llm", "corpus_pipeline.py")])
def test_imports_without_the_text_operators(tmp_path, missing):
    shutil.copytree(f"{ROOT}/blocklog", tmp_path / "blocklog", ignore=lambda d, names: [n for n in names if n == "__pycache__" or f"{os.path.relpath(d, ROOT)}/{n}" in missing])
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in missing and os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path / name)
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, text = done.stdout.split()
    assert int(count) >= 73
    if "blocklog/llm" in missing:
        assert text == "False"
