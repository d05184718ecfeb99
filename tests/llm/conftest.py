import pytest


@pytest.fixture(scope="module", autouse=True)
def small_session(spark):
    """The package on the executors, and few partitions: the fixtures are small and the operators run many jobs."""
    from plume.llm.common import ship

    ship(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
