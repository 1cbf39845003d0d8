import pytest

from tests.llm import cases


@pytest.fixture(scope="session")
def doc_rows():
    return cases.documents()


@pytest.fixture(scope="session")
def docs(spark, doc_rows, tmp_path_factory):
    """The awkward documents as a stored table, in two files."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(doc_rows, cases.SCHEMA).repartition(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def labels(spark, doc_rows):
    return spark.createDataFrame(cases.labels(doc_rows), "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], cases.SCHEMA)
