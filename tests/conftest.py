import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerflow.config import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows(spark):
    """Collect a frame as a sorted list of tuples."""

    def take(df, *columns):
        part = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in part.collect()), key=repr)

    return take
