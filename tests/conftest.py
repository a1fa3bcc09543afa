import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from creditloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("shared")
    return local_session(4, "tests", **{"spark.checkpoint.dir": str(base), "spark.driver.memory": "4g"})
