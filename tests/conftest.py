import sys
import tempfile
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillspark.session import build_session  # noqa: E402

LINE_SCHEMA = (
    "invoice_no string, stock_code string, description string, quantity double, "
    "invoice_ts timestamp_ntz, unit_price double, customer_id long, country string, src_pos long"
)
EVENT_SCHEMA = (
    "event_ts timestamp_ntz, user_id string, team string, event_type string, feedback_score int"
)
NOON = datetime(2011, 3, 1, 12, 0)


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, {"spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    """A new folder per test; left in place."""
    return tempfile.mkdtemp(prefix="tillspark-")


def line(invoice, stock, description="RED MUG", quantity=2.0, ts=NOON, price=1.5,
         customer=17, country="France"):
    return (invoice, stock, description, quantity, ts, price, customer, country)


def lines_frame(spark, rows):
    return spark.createDataFrame(
        [(*row, at) for at, row in enumerate(rows)], LINE_SCHEMA
    ).coalesce(1)


@pytest.fixture(scope="session")
def sample(spark):
    """Two clean lines, a guest line, and six that each break one blocking rule."""
    return lines_frame(
        spark,
        [
            line("1", "A"),
            line("2", "A2", "BLUE MUG", customer=18, country="Spain"),
            line("1", "A"),
            line("C3", "A"),
            line("4", "A", quantity=-3.0),
            line("5", "A", price=0.0),
            line("6", "A", price=5000.0),
            line("7", "POST"),
            line("8", "A3", None, customer=None),
        ],
    )


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
