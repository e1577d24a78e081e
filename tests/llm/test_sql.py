"""Every query of this subpackage with SQL gives the same rows in DuckDB."""

import math
import os

import duckdb
import pytest

from trailmark.llm.queries import oracle_sql, queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(rows):
    cell = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else f"{float(v):.9g}" if isinstance(v, (int, float)) else str(v)
    return sorted((tuple(cell(v) for v in r) for r in rows), key=str)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    df = queries()[name](spark, DATA)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]})").fetchall()
    assert plain(df.select(*columns).collect()) == plain(want)
