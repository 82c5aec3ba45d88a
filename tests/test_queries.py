"""Every query against its SQL counterpart on the same tables."""

import decimal
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return float(v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF)
    got = _rows(df.columns, df.collect())
    result = db.execute(contract.oracle_sql()[name])
    want = _rows([c[0] for c in result.description], result.fetchall())
    assert got[0] == want[0]
    if got[1] != want[1]:
        extra, lacking = got[1] - want[1], want[1] - got[1]
        pytest.fail(
            f"{sum(got[1].values())} rows, {sum(want[1].values())} wanted; "
            f"extra {sum(extra.values())}: {repr(list(extra)[:2])[:700]}; "
            f"lacking {sum(lacking.values())}: {repr(list(lacking)[:2])[:700]}"
        )
