import pytest

from tallywire.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.log.level": "ERROR",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def tiny_groups(spark):
    """Force the paths for oversized groups."""
    spark.conf.set("spark.tallywire.groupRows", "5")
    yield
    spark.conf.unset("spark.tallywire.groupRows")
