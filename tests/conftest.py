import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arealens.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="arealens-tests", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="arealens-wh-")})
    # Tests only: the cluster names its shared folder; locally there is none.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="arealens-ckpt-"))
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="arealens-test-")
