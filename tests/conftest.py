import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsloom.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session("newsloom-tests", **{
        "spark.master": "local[8]",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def texts(spark):
    """Texts to a (doc_id, text) table."""
    return lambda *rows: spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
