import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from custlens.runtime import local_session  # noqa: E402

RAW = "Invoice string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, Price double, `Customer ID` double, Country string"


@pytest.fixture(scope="session")
def spark():
    return local_session("4", 4, "custlens-tests")


def day(text):
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def raw(spark):
    """Six lines of a garden shop that stay and four that cleaning drops (no id, cancelled, bad quantity, no price)."""
    rows = [
        ("5001", "G-10", "Oak bench", 2, day("2011-08-12T09:15"), 40.0, 301.0, "Norway"),
        ("5001", "G-22", "Clay pot", 10, day("2011-08-12T09:15"), 3.0, 301.0, "Norway"),
        ("5002", "G-22", "Clay pot", 4, day("2011-06-20"), 3.5, 302.0, "Portugal"),
        ("5003", "G-31", "Rake", 1, day("2011-08-31T12:50"), 12.0, 302.0, "Italy"),
        ("5004", "G-10", None, 1, day("2011-11-05"), 38.0, 303.0, "Norway"),
        ("5005", "G-31", "Rake", 3, day("2011-09-20"), 11.0, 301.0, "Norway"),
        ("5006", "G-31", "Rake", 2, day("2011-08-02"), 12.0, None, "Norway"),
        ("C5007", "G-10", "Oak bench", -2, day("2011-08-15"), 40.0, 301.0, "Norway"),
        ("5008", "G-22", "Clay pot", -1, day("2011-08-03"), 3.0, 303.0, "Norway"),
        ("5009", "G-22", "Clay pot", 6, day("2011-08-03"), 0.0, 303.0, "Norway"),
    ]
    return spark.createDataFrame(rows, RAW)


@pytest.fixture(scope="session")
def baskets6(spark):
    rows = [(str(i), c, f"item {c}") for i, b in enumerate(["PQR", "PQ", "QR", "PQRS", "P", "QS"]) for c in b]
    return spark.createDataFrame(rows, "Invoice string, StockCode string, Description string")


@pytest.fixture(scope="session")
def supervised(spark):
    """260 customers; the odds of churn rise with Recency and fall with Frequency; Malta is rare, Iceland uncommon."""
    import math
    import random

    from custlens.runtime import materialize

    rng = random.Random(19)
    rows = []
    for i in range(1, 261):
        recency, visits = rng.randint(0, 300), 1 + int(rng.expovariate(0.2))
        odds = 0.03 * (recency - 150) - 0.15 * (visits - 5)
        country = "Malta" if i % 90 == 0 else "Iceland" if i % 20 == 0 else rng.choice(["Norway", "Norway", "Italy", "Portugal"])
        basket = round(rng.lognormvariate(4, 0.6), 2)
        rows.append((i, recency, visits, round(basket * visits, 2), basket, round(rng.uniform(1, 60), 1), rng.randint(1, 10 * visits), country, int(rng.random() < 1 / (1 + math.exp(-odds)))))
    return materialize(spark.createDataFrame(
        rows, "CustomerID bigint, Recency int, Frequency bigint, Monetary double, avg_basket_value double, avg_basket_size double, "
        "unique_products bigint, DominantCountry string, churn int"))
