"""The driver contract with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SHOW = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("gone", [["atomweft/llm", "tests/llm"], ["atomweft/llm", "tests/llm", "corpus_pipeline.py"]])
def test_the_rest_works_without_the_optional_subpackage(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *(Path(x).name for x in gone)))
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split()
    assert "avg_weighted" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
