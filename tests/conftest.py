import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark():
    from shelfmark.session import get_spark

    session = get_spark(
        "shelfmark-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.files.openCostInBytes": "1048576",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
