"""The library and its entry point without the corpus subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names_in(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    found = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    return found.stdout.split()


def test_without_the_corpus_subpackage(tmp_path):
    from checks.queries import QUERIES

    for name in ("guichet", "checks"):
        shutil.copytree(os.path.join(ROOT, name), tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    assert names_in(tmp_path) == sorted(QUERIES)
    if os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        # A pipeline whose operators are gone is no query, but the others stay.
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
        assert names_in(tmp_path) == sorted(QUERIES)
