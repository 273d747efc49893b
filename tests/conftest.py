import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from check import session

    return session()


@pytest.fixture(scope="session")
def reviews(spark):
    """Forty short labelled texts, ten of them in the smaller class."""
    words = ["good", "fine", "great", "bad", "poor"]
    rows = []
    for i in range(40):
        minor = i % 4 == 0
        word = words[3 + i % 2] if minor else words[i % 3]
        rows.append((i, f"{word} service number{i % 7} and {word} food", int(minor)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, target int")
