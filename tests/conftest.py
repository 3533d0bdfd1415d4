import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsflow.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # local[4,3]: up to 3 attempts per task, so tests can inject a lost task.
    s = get_session("local[4,3]", app="opsflow-tests", shuffle_partitions=4,
                    extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="opsflow-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    # Tests own a scratch checkpoint folder only because the session names none.
    checkpoint_dir(s, tempfile.mkdtemp(prefix="opsflow-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="opsflow-test-")
