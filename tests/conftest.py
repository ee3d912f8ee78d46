import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from layerhouse import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="layerhouse-tests-")
    spark = session.build("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": f"{home}/warehouse", "spark.checkpoint.dir": f"{home}/checkpoint",
    })
    spark.sparkContext.setLogLevel("ERROR")
    yield session.prepare(spark)
    spark.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])

    return collect
