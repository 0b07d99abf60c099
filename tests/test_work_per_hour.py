"""What an hourly row costs is made before the fan-out, with the values of the decimal rule."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from conftest import AS_OF, BASE_ROWS, TS2, ranges_df, row
from pyspark.sql import functions as F

from spanfan.functions.allocation import energy, fixed_point, parts, unscaled_fraction, unscaled_quantity, volume
from spanfan.operators.allocate import build_window, segment_hours

STRATEGY = ["days", "range", "months"]


def test_few_rows_take_the_decimal_rule(spark):
    """One row in a thousand is a tie of the energy (three more places than the volume); one in fifty took the slow rule before."""
    rnd = random.Random(7)
    rows = [(Decimal(rnd.randrange(10**8)) / 1000, Decimal(rnd.randrange(10**6)) / 10**8) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "q decimal(18,3), f decimal(36,8)")
    out = fixed_point(df.withColumn("_q", unscaled_quantity(F.col("q"))).withColumn("_f", unscaled_fraction(F.col("f"))), "_q", "_f", "q", "f")
    assert out.filter(F.col(parts("offtake_volume_kwh")[1]).isNotNull()).count() < 100
    assert out.filter((F.col("offtake_volume_kwh") != energy(F.col("q"), F.col("f"))) | (F.col("offtake_volume_m3") != volume(F.col("q"), F.col("f")))).count() == 0


@pytest.mark.parametrize("strategy", STRATEGY)
def test_end_of_hour_and_whole_numbers_are_made_below_the_join(spark, january_curve, strategy):
    hours = build_window(ranges_df(spark, BASE_ROWS), january_curve, "2024-01-01", "2024-01-31", "per_day", strategy, as_of=AS_OF)
    above, below = hours._jdf.queryExecution().optimizedPlan().toString().split("Join Inner", 1)
    assert "HOUR" not in above and "HOUR" in below
    before_dedup = below.split("Aggregate", 1)
    assert "* 1000)" not in above + before_dedup[0] and "* 1000)" in before_dedup[1]
    assert "_q" not in hours.columns and len(hours.columns) == 13


@pytest.mark.parametrize("strategy", [*STRATEGY, "segments"])
@pytest.mark.parametrize("kind", ["decimal(36,8)", "decimal(18,6)"])
def test_fractions_of_any_width(spark, january_curve, strategy, kind):
    """Null, negative and wide fractions, repeated rows, and records that tie but for the quantity."""
    f = F.when(F.col("supply_hour") == 3, None).when(F.col("supply_hour") == 4, F.lit("-0.00000005"))
    f = f.when(F.col("supply_hour") == 5, F.lit("99999999999.12345678" if kind == "decimal(36,8)" else "999999999999.123456"))
    curve = january_curve.withColumn("profile_fraction", f.otherwise(F.col("profile_fraction")).cast(kind))
    rows = [*BASE_ROWS, BASE_ROWS[0], row("T", "G1A", 1, 3, sja=5), row("T", "G1A", 1, 3, sja=7), row("T", "G1A", 2, 3, ts=TS2, sja=6), row("H", "G2A", 1, 1, sja="99999999.999")]
    if strategy == "segments":
        got = segment_hours(build_window(ranges_df(spark, rows), curve, as_of=AS_OF, grain="segments"), curve)
    else:
        got = build_window(ranges_df(spark, rows), curve, "2024-01-01", "2024-01-31", "per_day", strategy, as_of=AS_OF)
    got = got.cache()
    q, f = F.col("sja"), F.col("profile_fraction")
    assert got.filter(~F.col("offtake_volume_m3").eqNullSafe(volume(q, f)) | ~F.col("offtake_volume_kwh").eqNullSafe(energy(q, f))).count() == 0
    assert got.filter("supply_end_date_time_utc <> supply_start_date_time_utc + interval 1 hour").count() == 0
    assert dict(got.dtypes)["profile_fraction"] == kind
    hours = january_curve.select("profile_category_code", "supply_start_date_time_utc")
    wrong = got.join(curve.select(*hours.columns, F.col("profile_fraction").alias("want")), hours.columns).filter(~f.eqNullSafe(F.col("want")))
    assert wrong.count() == 0 and got.filter("profile_fraction is null").count() > 0
    kept = {(r[0], r[1]) for r in got.filter("point_of_delivery_ean = 'T'").select(F.dayofmonth("supply_start_date_time_utc"), "sja").distinct().collect()}
    assert kept == {(1, Decimal("7.000")), (2, Decimal("6.000")), (3, Decimal("6.000"))}
    got.unpersist()
