"""Every registered query equals its DuckDB oracle on the smallest test tables
(the driver runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare_oracle import TABLES, norm

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


ORACLE = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = df.toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    exp = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert norm(got) == norm(exp)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["item_id", "window_end", "cnt", "row_num"]
    assert df.count() > 0
