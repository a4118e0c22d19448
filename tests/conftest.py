import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from barlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "barlens-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bars(spark):
    """Bars from (ticker, day text, close[, volume]) tuples."""
    from pyspark.sql import functions as F

    def build(*rows):
        full = [(r[0], r[1], r[2], r[3] if len(r) > 3 else 1.0) for r in rows]
        df = spark.createDataFrame(full, "ticker string, time string, Close double, Volume double")
        return df.withColumn("time", F.to_timestamp("time"))

    return build


@pytest.fixture
def series(bars):
    """Consecutive daily bars of one instrument from its closes."""
    from datetime import date, timedelta

    def build(closes, ticker="A", start=date(2024, 1, 1)):
        return bars(*[(ticker, str(start + timedelta(days=i)), c) for i, c in enumerate(closes)])

    return build


def column(df, name, order="time"):
    return [row[0] for row in df.orderBy(order).select(name).collect()]
