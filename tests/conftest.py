import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from provender.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one row of text cells."""
    def value(expression, **cells):
        schema = ", ".join(f"{k} string" for k in cells) or "x string"
        df = spark.createDataFrame([tuple(cells.values()) or (None,)], schema)
        return df.select(expression.alias("v")).first().v
    return value
