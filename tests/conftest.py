import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("staywise-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def gold_table(spark, sf_dir, tmp_path_factory):
    """The derived gold rows, written once."""
    from staywise.operators import gold
    from staywise.plans import fixture

    path = str(tmp_path_factory.mktemp("gold") / "table")
    gold.features(fixture.customer_events(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def fitted(gold_table):
    from staywise.plans import training

    return training.fit(gold_table)
