"""The entry point with and without the optional part."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry_points

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def counts(folder):
    got = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": ""}, check=True)
    return [int(n) for n in got.stdout.split()[-2:]]


def test_entry_without_the_optional_folders(tmp_path):
    copy = tmp_path / "copy"
    skipped = shutil.ignore_patterns(".git", "llm", "__pycache__")
    shutil.copytree(ROOT, copy, ignore=skipped)
    plain = entry_points.QUERIES
    assert counts(copy) == [len(plain), len(plain)]  # corpus_pipeline.py still lies there
    (copy / "corpus_pipeline.py").unlink()
    assert counts(copy) == [len(plain), len(plain)]
