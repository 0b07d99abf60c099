"""Scenarios E1-E9 of FIXTURES.md section 5: history load, then one change
each, merged with retraction. Expected counts come from the fixture table."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, BASE_ROWS, TS2, ranges_df, row
from spanfan.operators.allocate import build_window
from spanfan.operators.checks import duplicate_keys
from spanfan.operators.merge import merge_actions, merge_summary, retracting_merge
from spanfan.plans.increment import rebuild_changed
from spanfan.sources.changes import changed_keys, initial_commit, snapshot_diff


def history(spark, curve, rows, policy="per_day"):
    return build_window(ranges_df(spark, rows), curve, policy=policy, as_of=AS_OF)


def test_history_counts(spark, january_curve):
    h = history(spark, january_curve, BASE_ROWS)
    per_key = {r[0]: r[1] for r in h.groupBy("point_of_delivery_ean").count().collect()}
    assert per_key == {"E1": 480, "E2": 240, "E3": 144, "E4": 240, "E5": 240, "E6": 240, "E9": 360}
    assert h.count() == 1944
    assert duplicate_keys(h).count() == 0
    # days 6-15 of E9 carry the later record (1500), days 1-5 the earlier one
    e9 = {
        (r["supply_start_date_time_utc"].day, r["sja"])
        for r in h.filter("point_of_delivery_ean = 'E9'").select("supply_start_date_time_utc", "sja").collect()
    }
    assert {d for d, q in e9 if q == Decimal("1500.000")} == set(range(6, 16))
    v = h.filter("point_of_delivery_ean = 'E1'").select("offtake_volume_m3", "offtake_volume_kwh").distinct().collect()
    assert [(r[0], r[1]) for r in v] == [(Decimal("1.000000"), Decimal("9.769000"))]


def replace(rows, key, new_rows):
    return [r for r in rows if r[0] != key] + list(new_rows)


# change name -> (v2 rows or None for no-op, extra touched keys, inserted, updated, deleted, total)
SCENARIOS = {
    "E1 shrinks": (replace(BASE_ROWS, "E1", [row("E1", "G1A", 1, 10, ts=TS2)]), [], 0, 240, 240, 1704),
    "E2 hard delete": (replace(BASE_ROWS, "E2", []), [], 0, 0, 240, 1704),
    "E2 re-opened": (replace(BASE_ROWS, "E2", [row("E2", "G1A", 1, None, ts=TS2)]), [], 504, 240, 0, 2448),
    "E1 front moves": (replace(BASE_ROWS, "E1", [row("E1", "G1A", 8, 20, ts=TS2)]), [], 0, 312, 168, 1776),
    "E4 correction appended": (BASE_ROWS + [row("E4", "G1A", 1, 10, ts=TS2, sja=2500)], [], 0, 240, 0, 1944),
    "E3 to electricity": (
        replace(BASE_ROWS, "E3", [row("E3", "G1A", 5, 10, ts=TS2, commodity="electricity")]), [], 0, 0, 144, 1800),
    "E1 shrinks, E2 deleted": (
        replace(replace(BASE_ROWS, "E1", [row("E1", "G1A", 1, 10, ts=TS2)]), "E2", []), [], 0, 240, 480, 1464),
    "no-op": (BASE_ROWS, [], 0, 0, 0, 1944),
    "E5 category change": (replace(BASE_ROWS, "E5", [row("E5", "G1A", 1, 10, ts=TS2)]), [], 240, 0, 240, 1944),
    "E1 shrink appended": (BASE_ROWS + [row("E1", "G1A", 1, 10, ts=TS2)], [], 0, 240, 240, 1704),
    "E6 touched": (BASE_ROWS, ["E6"], 0, 120, 120, 1824),
    "E9 touched": (BASE_ROWS, ["E9"], 0, 240, 120, 1824),
}


def run_change(spark, curve, v2_rows, touched, policy):
    v1 = ranges_df(spark, BASE_ROWS)
    v2 = ranges_df(spark, v2_rows)
    log = initial_commit(v1, 1).unionByName(snapshot_diff(v1, v2, version=2))
    keys = changed_keys(log, start_version=2)
    if touched:
        keys = keys.unionByName(spark.createDataFrame([(k,) for k in touched], "point_of_delivery_ean string"))
    target = history(spark, curve, BASE_ROWS)
    rebuilt = rebuild_changed(v2, curve, keys, policy=policy, as_of=AS_OF)
    summary = merge_summary(merge_actions(target, rebuilt, keys)).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_insert", "n_update", "n_delete", "n_unchanged")]
    ).first()
    merged = retracting_merge(target, rebuilt, keys)
    return summary, merged


@pytest.mark.parametrize("name", list(SCENARIOS))
def test_reference_rule_scenarios(spark, january_curve, name):
    """Per-day history + per-record increment: the counts of the fixture."""
    v2_rows, touched, ins, upd, dele, total = SCENARIOS[name]
    s, merged = run_change(spark, january_curve, v2_rows, touched, "per_record")
    assert (s["n_insert"], s["n_update"] + s["n_unchanged"], s["n_delete"]) == (ins, upd, dele)
    assert merged.count() == total
    assert duplicate_keys(merged).count() == 0


@pytest.mark.parametrize("name", list(SCENARIOS))
def test_per_day_increment_equals_rebuild(spark, january_curve, name):
    """With the per-day policy on both sides the merged table equals a
    history rebuild of v2 (touched keys lose nothing)."""
    v2_rows, touched, *_ = SCENARIOS[name]
    _, merged = run_change(spark, january_curve, v2_rows, touched, "per_day")
    rebuilt = history(spark, january_curve, v2_rows)
    cols = merged.columns
    assert merged.exceptAll(rebuilt.select(*cols)).count() == 0
    assert rebuilt.select(*cols).exceptAll(merged).count() == 0


def test_policies_differ_on_touched_keys(spark, january_curve):
    _, merged = run_change(spark, january_curve, BASE_ROWS, ["E6", "E9"], "per_day")
    per_key = {r[0]: r[1] for r in merged.groupBy("point_of_delivery_ean").count().collect()}
    assert per_key["E6"] == 240 and per_key["E9"] == 360
    _, merged = run_change(spark, january_curve, BASE_ROWS + [row("E1", "G1A", 1, 10, ts=TS2)], [], "per_day")
    assert merged.filter("point_of_delivery_ean = 'E1'").count() == 480


def test_merge_is_idempotent(spark, january_curve):
    v2_rows = SCENARIOS["E1 shrinks, E2 deleted"][0]
    v2 = ranges_df(spark, v2_rows)
    v1 = ranges_df(spark, BASE_ROWS)
    keys = changed_keys(snapshot_diff(v1, v2, version=2))
    target = history(spark, january_curve, BASE_ROWS)
    rebuilt = rebuild_changed(v2, january_curve, keys, policy="per_day", as_of=AS_OF)
    once = retracting_merge(target, rebuilt, keys)
    twice = retracting_merge(once, rebuilt, keys)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
