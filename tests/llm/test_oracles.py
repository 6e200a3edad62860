import os

import duckdb
import pytest

from aerolith.llm.queries import oracle_sql, queries
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got = queries()[name](spark, SF)
    want = con.execute(oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_operators_are_registered():
    assert [n.split("_")[0] for n in queries()] == [f"op{i}" for i in range(1, 14)]
