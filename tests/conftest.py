import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "tests",
        **{
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.driver.memory": "6g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of one expression over one column of inputs, in input order."""

    def run(values, expression, type_="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, c {type_}")
        return [r[0] for r in df.select("i", expression("c").alias("v")).orderBy("i").select("v").collect()]

    return run
