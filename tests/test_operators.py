"""Operator tests on hand-sized tables: guard, NULL rules, ties, relevance,
curve coverage, local days, strategy and policy equivalence."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import AS_OF, TS1, TS2, day, ranges_df, row
from spanfan.functions.predicates import relevant
from spanfan.operators.allocate import build_window
from spanfan.operators.checks import fanout_estimate, range_status_counts
from spanfan.operators.latest import latest_days
from spanfan.operators.ranges import classify, expand_days, rejected_ranges
from spanfan.sources.curve import hour_spine


def test_guard_classifies_without_raising(spark):
    rows = [
        row("A", "G1A", 5, 1),            # inverted
        row("B", "G1A", 1, None),         # open end
        row("C", "G1A", None, 5),         # no start
        row(None, "G1A", 1, 5),           # no key
        row("D", "G1A", 1, 3),
    ]
    df = ranges_df(spark, rows)
    st = {r["point_of_delivery_ean"]: r["range_status"] for r in classify(df, as_of=AS_OF).collect()}
    assert st == {"A": "inverted", "B": "ok", "C": "null_start", None: "null_key", "D": "ok"}
    assert rejected_ranges(df, as_of=AS_OF).count() == 3
    days = expand_days(df, as_of=AS_OF)
    per_key = {r[0]: r[1] for r in days.groupBy("point_of_delivery_ean").count().collect()}
    # the open end runs to the horizon: as_of + 3650 days
    assert per_key["D"] == 3
    assert per_key["B"] == (dt.date(2024, 1, 1) + dt.timedelta(days=3650) - dt.date(2024, 1, 1)).days + 1
    counts = {r["range_status"]: r["n_ranges"] for r in range_status_counts(df, as_of=AS_OF).collect()}
    assert counts == {"inverted": 1, "ok": 2, "null_start": 1, "null_key": 1}


def test_window_clipping_and_open_end(spark, january_curve):
    df = ranges_df(spark, [row("B", "G1A", 1, None), row("E", "G1A", dt.date(2023, 12, 25), 3)])
    h = build_window(df, january_curve, "2024-01-02", "2024-01-04", as_of=AS_OF)
    per_key = {r[0]: r[1] for r in h.groupBy("point_of_delivery_ean").count().collect()}
    assert per_key == {"B": 72, "E": 48}


def test_relevance_is_case_insensitive_and_untrimmed(spark):
    rows = [row("A", "G1A", 1, 2, commodity="GAS"), row("B", "G1A", 1, 2, commodity="Gas "),
            row("C", "G1A", 1, 2, method="prf"), row("D", "G1A", 1, 2, commodity=None)]
    kept = {r[0] for r in ranges_df(spark, rows).filter(relevant()).collect()}
    assert kept == {"A", "C"}


def test_equal_sequence_has_repeatable_winner(spark):
    rows = [row("A", "G1A", 1, 3, ts=TS1, sja=1000), row("A", "G1A", 1, 3, ts=TS1, sja=2000)]
    for policy in ("per_day", "per_segment", "per_record"):
        got = {r["sja"] for r in latest_days(ranges_df(spark, rows), policy, as_of=AS_OF).collect()}
        assert got == {2000}, policy


def test_range_outside_curve_yields_nothing(spark, january_curve):
    df = ranges_df(spark, [row("A", "G1A", dt.date(2025, 3, 1), dt.date(2025, 3, 5))])
    assert build_window(df, january_curve, as_of=AS_OF).count() == 0


def test_local_days_have_23_and_25_hours(spark):
    spans = spark.createDataFrame([("G1A", dt.date(2024, 3, 29), dt.date(2024, 11, 2))],
                                  "category string, first_day date, last_day date")
    spine = hour_spine(spans, zone="Europe/Amsterdam")
    n = {r["supply_date"]: r["count"] for r in spine.groupBy("supply_date").count().collect()}
    assert n[dt.date(2024, 3, 31)] == 23
    assert n[dt.date(2024, 10, 27)] == 25
    assert n[dt.date(2024, 6, 30)] == 24
    utc = hour_spine(spans)
    assert {r["count"] for r in utc.groupBy("supply_date").count().collect()} == {24}


def random_rows(seed: int, n: int = 60):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = f"K{rnd.randrange(6)}"
        cat = rnd.choice(["G1A", "G2A"])
        start = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(30))
        end = start + dt.timedelta(days=rnd.randrange(0, 20))
        ts = TS1 + dt.timedelta(hours=rnd.randrange(50))
        out.append(row(k, cat, start, end, ts=ts, sja=rnd.randrange(100, 5000)))
    return out


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_strategies_and_policies_agree(spark, january_curve):
    """Properties: J1 = J2 = J2b for each policy; W1 = W2b."""
    for seed in (1, 2):
        df = ranges_df(spark, random_rows(seed))
        w1 = latest_days(df, "per_day", as_of=AS_OF)
        w2b = latest_days(df, "per_segment", as_of=AS_OF)
        assert _same(w1, w2b)
        for policy in ("per_day", "per_record"):
            base = build_window(df, january_curve, "2024-01-03", "2024-01-25", policy, "days", as_of=AS_OF)
            for strategy in ("range", "months"):
                other = build_window(df, january_curve, "2024-01-03", "2024-01-25", policy, strategy, as_of=AS_OF)
                assert _same(base, other), (seed, policy, strategy)


def test_windowed_load_equals_single_load(spark, january_curve):
    df = ranges_df(spark, random_rows(3))
    whole = build_window(df, january_curve, as_of=AS_OF)
    parts = build_window(df, january_curve, "2024-01-01", "2024-01-15", as_of=AS_OF).unionByName(
        build_window(df, january_curve, "2024-01-16", "2024-12-31", as_of=AS_OF))
    assert _same(whole, parts)


def test_fanout_estimate_counts_days(spark):
    df = ranges_df(spark, [row("A", "G1A", 1, 10), row("B", "G1A", 1, 5, commodity="electricity"),
                           row("C", "G1A", 5, 1)])
    e = fanout_estimate(df, as_of=AS_OF).first()
    assert (e["n_rows"], e["n_relevant"], e["n_expandable"], e["n_day_rows"], e["n_hour_rows"]) == (3, 2, 1, 10, 240)


def test_hot_key_is_bounded_before_the_exchange(spark):
    """A third of all ranges on one key, category and month: what is dealt by (key,
    category, month) is at most its distinct pieces, and the winner is right."""
    from spanfan.operators.latest import latest_pieces
    from spanfan.operators.ranges import month_pieces

    n = 9000
    days = F.lit(dt.date(2024, 1, 1))
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("point_of_delivery_ean"),
        F.lit("G1A").alias("profile_category_code"),
        F.col("id").cast("decimal(18,3)").alias("sja"), F.lit("m3").alias("sj_unit_of_measure"),
        F.lit("gas").alias("commodity_type"), F.lit("PRF").alias("allocation_method"),
        F.date_add(days, (F.col("id") % 13).cast("int")).alias("effective_from_date"),
        F.date_add(days, (F.col("id") % 13 + F.col("id") % 11).cast("int")).alias("effective_to_date"),
        F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit(TS1).cast("timestamp_ntz")).alias("__record_timestamp"),
    )
    pieces = latest_pieces(month_pieces(df, as_of=AS_OF))
    hot = pieces.filter("point_of_delivery_ean = 'HOT'").count()
    assert hot <= 496 < n // 3
    for policy in ("per_day", "per_segment"):
        got = latest_days(df, policy, as_of=AS_OF).filter("point_of_delivery_ean = 'HOT'")
        best = {r["supply_date"]: int(r["sja"]) for r in got.collect()}
        for d, sja in best.items():
            i = (d - dt.date(2024, 1, 1)).days
            assert sja == max(x for x in range(0, n, 3) if x % 13 <= i <= x % 13 + x % 11)


def test_segments_scan_once(spark):
    df = ranges_df(spark, random_rows(4))
    path = df.sparkSession.conf.get("spark.checkpoint.dir") + "/seg-scan"
    df.write.mode("overwrite").parquet(path)
    plan = latest_days(spark.read.parquet(path), "per_segment", as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_draw_falls_into_its_share(spark):
    from spanfan.functions.draws import bucketed_length, weighted_pick

    df = spark.createDataFrame([(0.0, 0.0), (0.49, 0.99), (0.5, 0.0), (0.79, 0.5), (0.8, 0.0), (0.999, 0.999)], "b double, w double")
    got = df.select(weighted_pick(F.col("b"), ["x", "y", "z"], [0.5, 0.3, 0.2]),
                    bucketed_length(F.col("b"), F.col("w"), [(0.5, 1, 11), (0.3, 20, 30), (0.2, 100, 200)])).collect()
    assert [tuple(r) for r in got] == [("x", 1), ("x", 10), ("y", 20), ("y", 25), ("z", 100), ("z", 199)]
