"""The library must stand without its corpus subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import __spark_entry__ as entry
names = entry.queries()
assert "top_selling_monthly" in names and not [n for n in names if n.startswith("op") and n[2].isdigit()]
assert {left} in (None, "corpus_pipeline.py") and "pipeline" not in names
assert set(entry.oracle_sql()) <= set(names)
from skuflow.session import get_session
spark = get_session("local[2]", shuffle_partitions=2)
assert entry.entry(spark).columns
"""


def _copy(tmp_path, left):
    for name in ("__spark_entry__.py", left):
        if name:
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    shutil.copytree(os.path.join(ROOT, "skuflow"), tmp_path / "skuflow",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))


def _run(tmp_path, left):
    _copy(tmp_path, left)
    done = subprocess.run([sys.executable, "-c", CODE.format(left=repr(left))], cwd=tmp_path,
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_queries_run_without_the_corpus_folder_beside_the_pipeline_file(tmp_path):
    _run(tmp_path, "corpus_pipeline.py")


def test_queries_run_without_the_corpus_folder_and_the_pipeline_file(tmp_path):
    _run(tmp_path, None)
