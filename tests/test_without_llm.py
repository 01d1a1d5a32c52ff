"""The library, its queries and its tests without the training-data subpackage."""

from __future__ import annotations

import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("left_over", ["pipeline", "nothing", "caches"])
def test_entry_and_tests_without_the_subpackage(tmp_path, left_over):
    """With corpus_pipeline.py left behind, without it, and with a folder that only holds caches."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "llm", *(["corpus_pipeline.py"] if left_over == "nothing" else [])))
    assert not (copy / "routecast" / "llm").exists() and not (copy / "tests" / "llm").exists()
    if left_over == "caches":
        (copy / "routecast" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) == set(e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split()
    assert len(names) > 70 and not any(n == "pipeline" or re.match(r"op\d+_", n) for n in names)
    found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, capture_output=True, text=True, timeout=300)
    assert found.returncode == 0, found.stdout + found.stderr


def test_nothing_else_imports_the_subpackage():
    own = [p for p in [*(ROOT / "routecast").rglob("*.py"), *(ROOT / "duckdb_oracle").rglob("*.py")] if "llm" not in p.parts]
    assert own and not any("routecast.llm" in p.read_text() for p in own)
