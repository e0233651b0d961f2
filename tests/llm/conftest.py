import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import SF  # noqa: E402

os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with workers that find the library."""
    spark.sparkContext.environment["PYTHONPATH"] = os.environ["PYTHONPATH"]
    return spark


@pytest.fixture(scope="session")
def whole(llm):
    """documents and benchmark of the smallest test tables, as lists."""
    docs = [tuple(r) for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in llm.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    return docs, items
