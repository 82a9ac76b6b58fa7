import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hitlens.session import build_session
    session = build_session("local[*]", app="hitlens-tests", shuffle_partitions=8)
    sc = session.sparkContext
    if not sc.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield session
    session.stop()


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
