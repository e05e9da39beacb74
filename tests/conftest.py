import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.schema import TRANSACTION_SCHEMA  # noqa: E402
from tillroll.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def dirty(spark):
    """Six lines: one repeated, one cancelled, prices 0 and -1, a zero quantity, empty and null text."""
    day = at("2011-01-03 10:15:00")
    rows = [
        ("1001", "A", "mug", 5, day, 2.0, 17, "UK"),
        ("1001", "A", "mug", 5, day, 2.0, 17, "UK"),
        ("C1002", "A", "mug", -1, day, 2.0, 17, "UK"),
        ("1003", "B", "", 3, day, 0.0, None, "France"),
        ("1004", "C", None, 2, day, -1.0, 18, "France"),
        ("1005", "D", "cup", 0, day, 4.0, 18, None),
    ]
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


@pytest.fixture(scope="session")
def buyers(spark):
    """Forty customers with a purchase every five days; even ones also buy in the last quarter."""
    from datetime import timedelta

    rows, start = [], at("2011-01-01 09:00:00")
    for customer in range(40):
        for visit in range(12 + (8 if customer % 2 == 0 else 0)):
            when = start + timedelta(days=5 * visit, minutes=customer)
            for line in range(2):
                rows.append(
                    (f"{customer:03d}{visit:03d}", f"P{(customer * 7 + visit + line) % 15}", f"item {line}",
                     1 + (customer + visit + line) % 6, when, 1.5 + (customer + line) % 9, 1000 + customer,
                     ["UK", "France", "Spain"][customer % 3])
                )
    rows.append(("999999", "P1", "item", 3, start, 2.0, None, "UK"))
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


@pytest.fixture(scope="session")
def blobs(spark):
    """45 points in three well separated groups."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(7)
    rows = []
    for label, centre in enumerate((-3.0, 0.0, 3.0)):
        for _ in range(15):
            p = [float(v) for v in rng.normal(centre, 0.3, 3)]
            rows.append((len(rows), label, *p, Vectors.dense(p)))
    return spark.createDataFrame(rows, ["id", "label", "x", "y", "z", "features"])
