import os
import sys

import pytest

SF_SMALL = "/root/testdata/sf0.001"

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import EDGES, make_docs  # noqa: E402


@pytest.fixture(scope="session")
def edge_docs(spark):
    return make_docs(spark, EDGES)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, EDGES).limit(0)
