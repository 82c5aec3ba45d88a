import zlib

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of `doc_id, text` with nulls, empty and repeated rows, and a column of a clashing name."""

    def make(rows, schema="doc_id long, text string, score string"):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], schema)

    return make


@pytest.fixture(scope="session")
def in_fold():
    return lambda i, parts: zlib.crc32(str(i).encode()) % parts
