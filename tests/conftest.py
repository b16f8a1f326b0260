import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from skuflow.session import checkpoint_dir, get_session
    session = get_session("local[*]", app_name="skuflow-tests", shuffle_partitions=8)
    checkpoint_dir(session)  # a local folder only when the session names none
    yield session
