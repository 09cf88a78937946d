import pytest

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def tables(spark):
    def load(name, sf="sf0.001"):
        return spark.read.parquet(f"{DATA}/{sf}/{name}.parquet")

    return load
