"""The entry points with and without the optional pipeline operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(q.startswith('op') for q in e.queries()))"


@pytest.mark.parametrize("gone", [["tillwatch/llm", "tests/llm"], ["tillwatch/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_survives_without_the_operators(tmp_path, gone):
    copy = tmp_path / "copy"
    skipped = {str(ROOT / name) for name in gone}
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__") or str(Path(folder) / n) in skipped])
    done = subprocess.run([sys.executable, "-c", LIST], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, sql, _ = map(int, done.stdout.split())
    assert queries >= 88 and sql >= 87
