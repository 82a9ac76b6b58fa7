"""Driver contract: entry smoke run, key coverage, oracle equality at sf0.001."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from check_oracle import digest  # noqa: E402

from hitlens.registry import BATCH_QUERIES as _BATCH  # noqa: E402
from hitlens.streaming.queries import STREAM_QUERIES as _STREAM  # noqa: E402

LOG_KEYS = {*_BATCH, *_STREAM}
STREAM_KEYS = {k for k in entry_mod.queries() if k.startswith(("stream_", "counter_"))}


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["product", "views"] and 0 < len(rows) <= 10


def test_every_key_has_an_oracle():
    from hitlens.registry import BATCH_QUERIES
    from hitlens.streaming.queries import STREAM_QUERIES
    qs, oracle = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(oracle) <= set(qs)
    assert set(oracle) >= {*BATCH_QUERIES, *STREAM_QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "nation", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(LOG_KEYS - STREAM_KEYS))
def test_batch_query_equals_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.sql(entry_mod.oracle_sql()[name])
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(res.columns, orows)
