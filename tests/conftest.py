import datetime as dt

import pytest

from strataflow.session import build_session

AS_OF = dt.date(2026, 3, 8)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def plan_of(df) -> str:
    """The physical plan as adaptive execution starts with it."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
