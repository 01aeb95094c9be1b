import os
import sys

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from themelake.session import build_session

    session = build_session(
        "tests", "local[4]",
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "4000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan(spark):
    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
