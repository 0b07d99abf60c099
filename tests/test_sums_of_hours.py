"""What sums and maxima of hours cost a row."""

from __future__ import annotations

from conftest import AS_OF, BASE_ROWS, ranges_df, row
from pyspark.sql import functions as F

from spanfan.functions.allocation import exact_max
from spanfan.operators.allocate import build_window, segment_hours
from spanfan.operators.checks import reconcile


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_running_sums_of_decimals_are_left_alone_by_rows_without_one(spark, january_curve):
    f = F.when(F.col("supply_hour") == 3, None).when(F.col("supply_hour") == 5, F.lit("99999999999.12345678")).otherwise(F.col("profile_fraction"))
    curve = january_curve.withColumn("profile_fraction", f.cast("decimal(36,8)"))
    ranges = ranges_df(spark, [*BASE_ROWS, row("H", "G2A", 1, 1, sja="99999999.999"), row("H", "G2A", 2, 2, sja="-3.007"), row("M", "G2A", 1, 2, sja="-0.5")])
    segments = build_window(ranges, curve, as_of=AS_OF, grain="segments")
    sums = reconcile(segment_hours(segments, curve, with_parts=True))
    # the two sums of decimals have a filter, and no decimal is compared
    assert plan_of(sums).count("_rest#") and plan_of(sums).count("FILTER (WHERE isnotnull(") >= 2
    assert "max(sja#" not in plan_of(sums) and "max(sja_thousandths#" in plan_of(sums)
    plain = reconcile(segment_hours(segments, curve))
    assert sums.dtypes == plain.dtypes and sums.count() == plain.count() > 5
    assert sums.exceptAll(plain).count() == 0 and plain.exceptAll(sums).count() == 0
    other = segment_hours(segments.withColumn("sja", F.col("sja").cast("decimal(20,3)")), curve, with_parts=True)
    assert "thousandths" not in str(exact_max(other, "sja"))
