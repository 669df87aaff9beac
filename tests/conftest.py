import os
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE.parent), str(HERE), os.environ.get("PYTHONPATH", "")])  # of Python workers

from gleaner.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
