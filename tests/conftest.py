import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retail_marts.session import get_spark  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", app="retail_marts_tests",
                  **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false",
                     "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
