"""The entry without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_works_without_the_training_data_operators(tmp_path):
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(os.path.join(REPO, "smelter"), tmp_path / "smelter", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(REPO, name)):
            shutil.copy(os.path.join(REPO, name), tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)},
                         capture_output=True, text=True, timeout=120)
    names = out.stdout.split()
    assert out.returncode == 0, out.stderr
    assert "plant_ranking" in names and "pipeline" not in names and not any(n.startswith("op") and "_" in n and n[2].isdigit() for n in names)
