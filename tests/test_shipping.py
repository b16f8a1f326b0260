"""Functions that run in Python workers must not need the package installed."""

import subprocess
import sys
import tempfile

from pyspark import cloudpickle

import skuflow  # noqa: F401  (registers pickling by value)
from skuflow.operators import forecast as M


def test_worker_function_loads_without_the_package(tmp_path):
    payload = tmp_path / "fn.pkl"
    payload.write_bytes(cloudpickle.dumps(M.least_squares_model))
    code = (
        "import sys, pickle, pandas as pd\n"
        "sys.path = [p for p in sys.path if 'repo' not in p]\n"
        f"fn = pickle.loads(open({str(payload)!r}, 'rb').read())\n"
        "x = pd.DataFrame({'a': [0.0, 1.0, 2.0]}); y = pd.Series([1.0, 3.0, 5.0])\n"
        "tr, te = fn(x, y, pd.DataFrame({'a': [3.0]}))\n"
        "assert abs(te[0] - 7.0) < 1e-9\n"
        "import importlib.util; assert importlib.util.find_spec('skuflow') is None\n")
    with tempfile.TemporaryDirectory() as cwd:
        done = subprocess.run([sys.executable, "-c", code], cwd=cwd, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
