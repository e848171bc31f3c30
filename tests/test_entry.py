"""The entry module with and without the training-data package."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder):
    """Queries and SQL twins that a copy of the repository registers."""
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    got = subprocess.run([sys.executable, "-c", code], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr[-2000:]
    return [set(line.split()) for line in got.stdout.splitlines()[-2:]]


def test_without_the_training_data_package(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.md", "*.json"))
    here, without = names(ROOT), None
    for remove in (["pacekit/llm", "tests/llm"], ["corpus_pipeline.py"]):        # the pipeline first left behind, then gone
        for r in remove:
            path = copy / r
            shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
        without = names(copy)
        assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in without[0])
        assert len(without[0]) >= 86 and without[1] <= without[0] and without[0] <= here[0]
