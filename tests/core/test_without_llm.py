"""The library without its training-data subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]


def _copied(tmp_path, *left_out):
    skip = shutil.ignore_patterns(*left_out, ".git", "__pycache__", "spark-warehouse", ".pytest_cache", ".hypothesis")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    return tmp_path / "repo", {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_imports_without_it(tmp_path, left_out):
    code = "import __spark_entry__ as e; q = e.queries(); assert 'lifecycle_all' in q and 'pipeline' not in q and not any(n.startswith('op1') for n in q); assert set(e.oracle_sql()) <= set(q)"
    repo, env = _copied(tmp_path, *left_out)
    subprocess.run([sys.executable, "-c", code], cwd=repo, env=env, check=True, timeout=120)


def test_the_other_tests_pass_without_it(tmp_path):
    """A part of them, in a session of their own; none may need what is left out."""
    repo, env = _copied(tmp_path, "llm")
    assert not list(repo.rglob("llm"))
    run = [sys.executable, "-m", "pytest", "tests", "-q", "-x", "-p", "no:cacheprovider", "-k", "test_wikitext or test_entry or lifecycle or test_served"]
    subprocess.run(run, cwd=repo, env=env, check=True, timeout=600)


def test_a_broken_dependency_is_not_hidden(tmp_path):
    repo, env = _copied(tmp_path, "corpus_pipeline.py")
    (repo / "public_tokenizers.py").write_text("raise ImportError('broken')")
    got = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=repo, env=env, capture_output=True, text=True, timeout=120)
    assert got.returncode and "broken" in got.stderr


def test_nothing_else_imports_it():
    for path in (ROOT / "palimpsest").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
