from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gleanery.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def policies(spark):
    return spark.createDataFrame(
        [
            ("policy_01", "security", "Badge readers in the east wing are tested on the first Monday of a month, keys included."),
            ("policy_02", "deployment", "Ship the green build first; a warm standby takes over while the blue one restarts."),
            ("policy_03", "database", "Archive tables older than two summers to cold storage after the auditors have signed."),
        ],
        "id string, category string, content string",
    )


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
