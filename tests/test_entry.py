"""The library without the subpackage for training text, and in a session that no one configured."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]


def _run(code: str, at: Path, conf: Path) -> str:
    """What Python prints in a folder, with an empty folder for Spark's settings."""
    conf.mkdir(exist_ok=True)
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"PYTHONPATH": f"{at}:{os.environ.get('PYTHONPATH', '')}", "SPARK_CONF_DIR": str(conf), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", code], cwd=at, env=env, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_folders_for_training_text(tmp_path, pipeline):
    for name in ("__spark_entry__.py", "bench.py", *(["corpus_pipeline.py"] if pipeline else [])):
        if (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path)
    shutil.copytree(REPO / "tagmill", tmp_path / "tagmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(len(q), any(k.startswith('op') or k == 'pipeline' for k in q))"
    from tagmill.plans.all import QUERIES

    assert _run(code, tmp_path, tmp_path / "conf").split()[-2:] == [str(len(QUERIES)), "False"]


def test_working_tables_without_a_checkpoint_folder(tmp_path):
    code = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from tagmill.functions.working import checkpointed
print("rows", checkpointed(spark.range(5)).count())
"""
    assert "rows 5" in _run(code, REPO, tmp_path / "conf")
