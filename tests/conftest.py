import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wattmirror import build_session  # noqa: E402
from wattmirror.session import ROCKSDB  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[8]", "tests", shuffle_partitions=4, **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_spans(spark):
    """Cut every key into very narrow spans."""
    spark.conf.set("wattmirror.spanWidth", "7")
    yield
    spark.conf.unset("wattmirror.spanWidth")
