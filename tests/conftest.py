from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from spanfan.session import ensure_checkpoint_dir  # noqa: E402

RANGE_DDL = (
    "point_of_delivery_ean string, profile_category_code string, sja decimal(18,3), sj_unit_of_measure string, "
    "commodity_type string, allocation_method string, effective_from_date date, effective_to_date date, "
    "__record_timestamp timestamp_ntz"
)
TS1 = dt.datetime(2024, 2, 1, 0, 0, 0)
TS2 = dt.datetime(2024, 2, 2, 0, 0, 0)
AS_OF = "2024-01-01"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = (
        SparkSession.builder.master("local[*]")
        .appName("spanfan-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


def day(d: int, month: int = 1) -> dt.date:
    return dt.date(2024, month, d)


def row(key, cat, d_from, d_to, ts=TS1, sja=1000, commodity="gas", method="PRF"):
    """A range row of the scenario fixture (days of January 2024)."""
    f = None if d_from is None else (d_from if isinstance(d_from, dt.date) else day(d_from))
    t = None if d_to is None else (d_to if isinstance(d_to, dt.date) else day(d_to))
    return (key, cat, Decimal(sja).quantize(Decimal("0.001")), "m3", commodity, method, f, t, ts)


def ranges_df(spark, rows):
    return spark.createDataFrame(rows, RANGE_DDL)


@pytest.fixture(scope="session")
def january_curve(spark):
    """Categories G1A and G2A, every UTC hour of January 2024, fraction 0.001."""
    from spanfan.sources.curve import hour_spine

    spans = spark.createDataFrame(
        [("G1A", day(1), day(31)), ("G2A", day(1), day(31))], "category string, first_day date, last_day date"
    )
    return hour_spine(spans).withColumn("profile_fraction", F.lit("0.001").cast("decimal(36,8)")).cache()


BASE_ROWS = [
    row("E1", "G1A", 1, 20),
    row("E2", "G1A", 1, 10),
    row("E3", "G1A", 5, 10),
    row("E4", "G1A", 1, 10, sja=2000),
    row("E5", "G2A", 1, 10),
    row("E6", "G1A", 1, 5),
    row("E6", "G1A", 11, 15, ts=TS2),
    row("E7", "G1A", 1, 10, commodity="electricity"),
    row("E8", "G1A", 1, 10, method="AMR"),
    row("E9", "G1A", 1, 10),
    row("E9", "G1A", 6, 15, ts=TS2, sja=1500),
]
