import pyarrow.parquet as pq
import pytest

from llm_cases import DOCS, ODD, SF01


@pytest.fixture(scope="session")
def docs01():
    """(doc_id, text) of sf0.01."""
    t = pq.read_table(f"{SF01}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], DOCS)
