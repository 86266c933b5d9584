import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_rows import SCHEMA, hard_rows  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(hard_rows()[0], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(hard_rows()[1], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i in (3, 6, 8))) for i in range(17)] + [(3, 1, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
