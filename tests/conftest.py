import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from textloom.session import local_session

    return local_session("8", "tests")


@pytest.fixture(scope="session")
def tables(spark):
    from textloom.plans.registry import Tables

    return Tables(spark, SF)
