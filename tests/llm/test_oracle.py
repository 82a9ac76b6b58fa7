"""Every operator that SQL can express equals its SQL, computed from the tables alone."""

import duckdb
import pytest

from conftest import SF01
from hitlens.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    res = con.sql(registry.ORACLE_SQL[name])
    df = registry.QUERIES[name](spark, SF01)
    assert sorted(df.columns) == sorted(res.columns)
    got = [tuple(r) for r in df.select(*res.columns).collect()]
    assert len(got) == len(set(got)) and set(got) == set(res.fetchall())
