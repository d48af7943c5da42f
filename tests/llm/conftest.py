import pytest

from tarmac.llm.common import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture()
def docs_of(spark):
    """documents with extra columns whose names the operators use themselves."""
    def make(rows):
        data = [(i, t, f"fp{i}", 7) for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, fp string, n int").repartition(3)
    return make
