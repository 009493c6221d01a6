import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medallion.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="medallion-tests")
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
