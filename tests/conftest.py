import os

import pytest

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 3g pyspark-shell")


@pytest.fixture(scope="session")
def spark():
    from threadloom.session import get_spark

    s = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
