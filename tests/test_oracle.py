"""Every catalogued query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

from renewlens.plans.catalog import ORACLE, QUERIES, load_all
from tests.conftest import SF001
from tools.check_oracle import TABLES, loose_equal, rows_of

load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows) or loose_equal(s_cols, s_rows, d_cols, d_rows)
