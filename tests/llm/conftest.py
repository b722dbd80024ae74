import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("PATRONSCOPE_TESTDATA", "/root/testdata") + "/sf0.001"


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    from patronscope.llm.common import importable

    importable(spark)
