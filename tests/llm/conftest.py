import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").cache()


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture()
def make(spark):
    def rows(data, schema="doc_id long, text string"):
        return spark.createDataFrame(data, schema)
    return rows
