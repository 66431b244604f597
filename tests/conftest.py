import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wareloom.session import build_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    wh = str(tmp_path_factory.mktemp("warehouse"))
    s = build_session("local[*]", app="wareloom-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
