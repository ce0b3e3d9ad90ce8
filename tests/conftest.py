import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barlab.session import clean_scratch, get_spark
    s = get_spark("local[4]", 4, app_name="barlab-tests")
    yield s
    clean_scratch(s)
    s.stop()
