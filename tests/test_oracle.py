"""Registered queries vs their DuckDB SQL on sf0.001 (the driver runs the
same comparison on sf0.01 with tools/check_oracle.py's method)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from spanfan.plans.workloads import QUERIES
from tools.check_oracle import digest, duck

SF = "/root/testdata/sf0.001"
FAST = [
    "range_explode_days", "range_clip_window", "inverted_range_guard", "latest_per_day", "latest_per_record",
    "latest_per_segment", "curve_normalised", "curve_from_events", "allocate_year_equi", "allocate_year_bucketed",
    "allocate_local_day", "allocate_year_range", "allocate_daily_total", "seasonal_curve", "curve_spine",
    "reconcile_entity_year", "target_duplicate_keys", "table_difference", "history_load_years", "history_load_windows",
    "stored_year_rows", "increment_equals_rebuild", "stream_increment", "stream_late_commit", "reload_equals_history",
    "year_row_counts", "duplicate_keys", "fanout_estimate", "snapshot_diff",
    "snapshot_as_of", "latest_version", "changed_keys", "rebuild_changed", "retracting_merge", "merge_actions",
    "retracted_rows", "weighted_pick", "bucketed_length",
    "increment_delta", "increment_folded", "stream_delta", "curve_change_increment", "reload_with_seam", "snapshot_from_base",
    "reconcile_bucketed", "merge_bucketed", "table_fingerprint_diff", "range_overlap", "validity_islands", "coverage_gaps",
    "fanout_after_dedup", "entity_codes",
]


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(SF):
        pytest.skip("no test data")
    return duck(SF)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert digest(df.columns, rows) == digest(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["point_of_delivery_ean", "profile_category_code"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_listed():
    assert {n for n in QUERIES if n not in E.oracle_sql()} == set()
    assert set(FAST) == set(QUERIES)


def test_results_do_not_depend_on_session_zone(spark, con):
    """Timestamps are zone-free (timestamp_ntz / dates): the same digest as
    the oracle under a non-UTC session zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for name in ("snapshot_diff", "allocate_local_day", "curve_from_events"):
            df = E.queries()[name](spark, SF)
            res = con.execute(E.oracle_sql()[name])
            assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(
                [d[0] for d in res.description], res.fetchall()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
