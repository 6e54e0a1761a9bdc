import shutil
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from statutelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Executors run in this process, so a temporary folder is shared by all of them.
    folder = tempfile.mkdtemp(prefix="statutelake-")
    session = local_session(4, "8g", checkpoint=f"file://{folder}")
    yield session
    session.stop()
    shutil.rmtree(folder, ignore_errors=True)


@pytest.fixture
def one(spark):
    """Value of a column expression over one literal row."""

    def run(column, **values):
        return spark.createDataFrame([tuple(values.values())], list(values)).select(column).first()[0]

    return run
