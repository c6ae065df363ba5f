import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from invspark.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, 4, "tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
