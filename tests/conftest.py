import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session(
        "tests",
        "local[8]",
        8,
        {
            "spark.driver.memory": "8g",
            "spark.log.level": "ERROR",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def orders(spark):
    """Orders from tuples (order_id, customer, product, quantity, amount, timestamp text, status)."""

    def build(rows):
        df = spark.createDataFrame(
            rows,
            "order_id string, customer_id string, product_id string, quantity int, "
            "total_amount double, order_timestamp string, status string",
        )
        return df.selectExpr("*", "try_cast(order_timestamp as date) as order_date")

    return build


@pytest.fixture
def daily(spark):
    """A daily series from revenues, one per day from a first date on."""
    import datetime as dt

    from ledgerline.operators.timeseries import daily_revenue

    def build(revenues, first=dt.date(2024, 1, 1)):
        rows = [
            (f"o{i}", float(amount), first + dt.timedelta(days=i))
            for i, amount in enumerate(revenues)
        ]
        df = spark.createDataFrame(rows, "order_id string, total_amount double, order_date date")
        return daily_revenue(df)

    return build
