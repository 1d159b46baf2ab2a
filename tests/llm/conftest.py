"""Fixtures for the training-data operators: awkward rows, and workers that find the package."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests"), os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    return spark


@pytest.fixture(scope="session")
def awkward(spark):
    from odd_rows import AWKWARD, frame

    return frame(spark, AWKWARD)


@pytest.fixture(scope="session")
def nothing(spark):
    from odd_rows import SCHEMA

    return spark.createDataFrame([], SCHEMA)
