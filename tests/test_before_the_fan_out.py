"""What is merged, counted and stored before the fan-out gives the rows of the hours."""

from __future__ import annotations

import random
from decimal import Decimal

from conftest import AS_OF, BASE_ROWS, TS2, ranges_df, row
from pyspark.sql import functions as F

from spanfan.functions.allocation import exact_sum, fixed_point, unscaled_fraction, unscaled_quantity
from spanfan.operators.allocate import allocate_days, build_window, segment_hours
from spanfan.operators.checks import duplicate_hours, duplicate_keys
from spanfan.operators.merge import DAY_KEY, DAY_VALUES, hourly_actions, merge_actions, retracted_rows, retracting_merge
from spanfan.plans.history import load_history
from spanfan.session import work_dir
from spanfan.sources.target import Target

KEY = "point_of_delivery_ean"


def rows_of(df):
    return sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect())))


def test_merges_of_days_and_segments_are_those_of_hours(spark, january_curve):
    v2_rows = [r for r in BASE_ROWS if r[0] not in ("E1", "E2", "E9")] + [
        row("E1", "G1A", 1, 10, ts=TS2), row("E9", "G1A", 4, 22, ts=TS2, sja=77), row("N", "G2A", 3, 9)]
    keys = spark.createDataFrame([("E1",), ("E2",), ("E9",), ("N",)], f"{KEY} string")
    v1, v2 = ranges_df(spark, BASE_ROWS), ranges_df(spark, v2_rows).join(keys, KEY, "left_semi").select(*ranges_df(spark, []).columns)
    old, new = ({g: build_window(v, january_curve, as_of=AS_OF, grain=g) for g in ("hours", "days", "segments")} for v in (v1, v2))
    merged = segment_hours(retracting_merge(old["segments"], new["segments"], keys), january_curve)
    assert rows_of(merged) == rows_of(retracting_merge(old["hours"], new["hours"], keys))
    actions = hourly_actions(merge_actions(old["days"], new["days"], keys, DAY_KEY, DAY_VALUES), january_curve)
    assert rows_of(actions) == rows_of(merge_actions(old["hours"], new["hours"], keys))
    assert {r[0] for r in actions.select("merge_action").distinct().collect()} == {"insert", "update", "delete"}
    gone = allocate_days(retracted_rows(old["days"], new["days"], keys, DAY_KEY), january_curve)
    assert rows_of(gone) == rows_of(retracted_rows(old["hours"], new["hours"], keys))


def test_duplicate_hours_of_repeated_days_and_curve_rows(spark, january_curve):
    days = build_window(ranges_df(spark, BASE_ROWS), january_curve, as_of=AS_OF, grain="days")
    assert duplicate_hours(days, january_curve).count() == 0
    twice = days.unionByName(days.filter("supply_date = '2024-01-03'"))
    hour = F.col("supply_start_date_time_utc") == F.lit("2024-01-03 05:00:00").cast("timestamp_ntz")
    curve = january_curve.unionByName(january_curve.filter(hour)).unionByName(january_curve.filter(hour).withColumn("supply_date", F.lit("2024-01-04").cast("date")))
    for d in (days, twice):
        for c in (january_curve, curve):
            got = duplicate_hours(d, c)
            assert rows_of(got) == rows_of(duplicate_keys(allocate_days(d, c)))
    assert got.agg(F.max("n_rows")).first()[0] == 5


def test_exact_sums_of_longs_and_decimals(spark):
    rnd, d = random.Random(2), lambda n, k: Decimal(rnd.randrange(-(10 ** rnd.randrange(1, n)), 10 ** rnd.randrange(1, n))) / 10**k
    rows = [(rnd.randrange(30), d(18, 3), d(12, 8)) for _ in range(2000)] + [(30, None, Decimal(1)), (31, Decimal("1.001"), None)]
    rows += [(32, Decimal("999999999999999.999"), Decimal("9999999999.5"))] * 2
    df = spark.createDataFrame(rows, "g int, q decimal(18,3), f decimal(36,8)")
    df = fixed_point(df.withColumn("_q", unscaled_quantity(F.col("q"))).withColumn("_f", unscaled_fraction(F.col("f"))), "_q", "_f", "q", "f")
    for name in ("offtake_volume_m3", "offtake_volume_kwh"):
        sums = df.groupBy("g").agg(F.sum(name).alias("a"), exact_sum(df, name).alias("b"))
        assert dict(sums.dtypes)["b"] == "decimal(38,6)" and sums.filter("not (a <=> b)").count() == 0


def test_the_base_holds_segments(spark, january_curve):
    t = Target(spark, work_dir(spark, "t"), n_buckets=2)
    load_history(t, ranges_df(spark, BASE_ROWS), january_curve, windows=[("2024-01-01", "2024-01-15"), ("2024-01-16", "2024-01-31")], as_of=AS_OF)
    want = build_window(ranges_df(spark, BASE_ROWS), january_curve, as_of=AS_OF)
    assert rows_of(t.read()) == rows_of(want) and want.count() == 1944
    assert spark.read.parquet(t.data_path).count() < 30
