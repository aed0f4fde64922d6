import os
import sys
import tempfile
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# Functions defined in test modules must be importable in the workers.
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE), os.environ.get("PYTHONPATH", "")])

from recueil.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-")
    return local_session(4, 4, **{"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse"})


@pytest.fixture
def path(tmp_path):
    return str(tmp_path)
