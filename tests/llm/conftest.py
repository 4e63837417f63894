import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])  # for Spark's Python workers
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def small_dir() -> str:
    return "/root/testdata/sf0.001"
