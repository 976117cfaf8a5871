"""The library and its queries without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]
CODE = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(set(q) & set(e.oracle_sql())), 'pipeline' in q)"


@pytest.mark.parametrize("pipeline", [True, False])
def test_import_without_llm(tmp_path, pipeline):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *[] if pipeline else ["corpus_pipeline.py"]))
    run = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path / "copy", env={"PATH": "", "PYTHONPATH": ""}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    total, with_sql, has_pipeline = run.stdout.split()
    assert total == with_sql and int(total) >= 94 and has_pipeline == "False"
