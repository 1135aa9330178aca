"""Every registered query against its DuckDB oracle (driver-style comparison) at sf0.001."""

import duckdb
import pytest
from conftest import SF001

from tools.check_oracles import TABLES, digest

import __spark_entry__ as E

ORACLES = E.oracle_sql()
#: The subpackage's queries have tests of their own beside it.
OWN = sorted(name for name in E.queries() if name != "pipeline" and not name.startswith("op"))


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 18
    assert df.columns == ["check_name", "status", "violations", "total_rows", "metric"]


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(OWN) - set(ORACLES)
    assert rows_only == set()
    assert set(ORACLES) <= set(E.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    got = digest(E.queries()[name](spark, SF001).toPandas())
    if name not in ORACLES:
        assert got[0] > 0
        return
    want = digest(con.execute(ORACLES[name]).df())
    assert got == want
