"""The entry stands without the training-text operators, but does not hide that one is broken."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture
def copy(tmp_path):
    to = tmp_path / "repo"
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests"))
    shutil.rmtree(to / "adlake" / "llm", ignore_errors=True)
    (to / "corpus_pipeline.py").unlink(missing_ok=True)
    return to


def entry(folder):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


def test_without_the_operators(copy):
    done = entry(copy)
    assert done.returncode == 0, done.stderr
    queries, sql = map(int, done.stdout.split())
    assert queries == sql > 50


def test_a_broken_operator_is_not_hidden(copy):
    (copy / "adlake" / "llm").mkdir()
    (copy / "adlake" / "llm" / "__init__.py").write_text("")
    (copy / "adlake" / "llm" / "queries.py").write_text("import no_such_module\n")
    (copy / "corpus_pipeline.py").write_text("")
    assert "no_such_module" in entry(copy).stderr
