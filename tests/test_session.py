"""Sessions without a preset checkpoint folder."""

import os
import subprocess
import sys

import pytest

from skuflow.session import checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, tmp_path):
    conf = tmp_path / "conf"
    conf.mkdir(exist_ok=True)
    env = os.environ | {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": ROOT}
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, timeout=300)


def test_entry_runs_in_a_stock_session(tmp_path):
    if not os.path.exists("/root/testdata/sf0.001/lineitem.parquet"):
        pytest.skip("test data not present")
    done = run("from pyspark.sql import SparkSession\n"
               "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
               "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
               "import __spark_entry__ as e\n"
               "print('rows', e.entry(s).count())\n"
               "print('stored', e.queries()['sales_refresh_monthly'](s, e.SMOKE_DIR).count())\n", tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "rows" in done.stdout and "stored" in done.stdout


class Context:
    def __init__(self, master):
        self.master, self.where = master, None

    def getCheckpointDir(self):
        return self.where

    def setCheckpointDir(self, where):
        self.where = where


class Session:
    def __init__(self, master, conf=None):
        self.sparkContext, self.conf = Context(master), conf or {}


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"])
def test_a_cluster_without_a_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session(master))


def test_the_named_folder_is_used():
    s = Session("yarn", {"spark.checkpoint.dir": "hdfs:///x"})
    assert checkpoint_dir(s) == "hdfs:///x" and s.sparkContext.where == "hdfs:///x"
    assert os.path.isdir(checkpoint_dir(Session("local[4]")))
