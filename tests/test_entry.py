"""The entry with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


def names(folder):
    said = subprocess.run([sys.executable, "-B", "-c", NAMES], cwd=folder, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    return [set(line.split()) for line in said.stdout.splitlines()]


def test_the_rest_works_without_the_operators(tmp_path):
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns(
        ".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    queries, statements = names(tmp_path / "repo")
    assert queries == statements and len(queries) >= 124
    (tmp_path / "repo/rosterloom/llm").mkdir()
    assert names(tmp_path / "repo") == [queries, statements]
    everything, _ = names(REPO)
    assert everything >= queries
