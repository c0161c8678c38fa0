import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fieldmark.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session(
        "fieldmark-tests",
        4,
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={tmp_path_factory.mktemp('derby')}",
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, nulls first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])

    return collect
