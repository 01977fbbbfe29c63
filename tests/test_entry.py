"""The library without its part for text corpora."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("left_out", [("martloom/llm", "tests/llm"), ("martloom/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_imports_alone(tmp_path, left_out):
    gone = {str(ROOT / part) for part in left_out}
    skipped = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache")

    def ignore(folder, names):
        return skipped(folder, names) | {n for n in names if f"{folder}/{n}" in gone}

    shutil.copytree(ROOT, tmp_path / "copy", ignore=ignore)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(n.startswith('op') for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
    number, pipeline, corpus = out.stdout.split()
    assert int(number) > 80 and (pipeline, corpus) == ("False", "False")
