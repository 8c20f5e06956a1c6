import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=4, memory="8g")


@pytest.fixture(scope="session")
def small_corpus(spark):
    """Two categories with their own words, plus an empty and an all-stop-word document."""
    rows = [(i, "pets", f"cat dog {'cat ' * (i % 3)}fur paw{'s' if i % 2 else ''}") for i in range(12)]
    rows += [(i, "cars", f"wheel motor {'road ' * (i % 4)}fuel brake") for i in range(12, 24)]
    rows += [(24, "cars", ""), (25, "pets", "the and of")]
    return spark.createDataFrame(rows, "id long, category string, text string")
