"""Every registered query against its SQL in DuckDB, over the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from aerolith.plans import gold_queries, source_queries, table_queries  # noqa: F401  they register their queries
from aerolith.plans.queries import ORACLES, QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(x):
    if x is None or (not isinstance(x, (list, np.ndarray)) and pd.isna(x)):
        return "NULL"
    if isinstance(x, (int, float, np.integer, np.floating)) and not isinstance(x, bool):
        return float(x)
    return str(x)


def rows_of(df):
    return sorted((tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = rows_of(got), rows_of(want)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a == b or all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) < 2e-5 * max(1, abs(x))) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_clusters_cover_all_rows(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert len({r[0] for r in rows}) == len(rows) > 0 and all(0 <= r["cluster_id"] < 10 for r in rows)


def test_the_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_embedding_clusters_see_the_whole_vector(spark, tmp_path):
    """Two groups that are equal but for the last parts of their vectors share no cluster."""
    rng = np.random.default_rng(1)
    rows = [(i, [*rng.normal(size=8).tolist(), *([10.0 * (i % 2)] * 56)]) for i in range(120)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["embedding_clusters"](spark, str(tmp_path)).collect()
    assert len(got) == 120
    assert not {r["cluster_id"] for r in got if r["vec_id"] % 2} & {r["cluster_id"] for r in got if not r["vec_id"] % 2}
