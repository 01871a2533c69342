import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tidemark.llm.shared import ship

    ship(spark)
