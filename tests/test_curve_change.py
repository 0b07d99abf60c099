"""Changes of the curve and of the horizon, and the reload runbook."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, BASE_ROWS, TS2, day, ranges_df, row
from spanfan.operators.allocate import build_window
from spanfan.plans.curve_change import advance_horizon, apply_curve, changed_days
from spanfan.plans.history import load_history
from spanfan.plans.increment import append_increment, fold
from spanfan.session import work_dir
from spanfan.sources.changes import append_commit, initial_commit, snapshot_diff
from spanfan.sources.curve import hour_spine
from spanfan.sources.target import Target
from spanfan.streaming.changefeed import reload_at, run_from_seam, run_stream_increment, seam_of

KEY = "point_of_delivery_ean"
ROWS = [*BASE_ROWS, row("L1", "G1A", day(20), day(25, 3), sja=500), row("L1", "G1A", day(5, 3), None, ts=TS2), row("L2", "G2A", day(3, 2), day(9, 3)),
        row("L3", "G1A", day(1, 2), day(5, 3))]


@pytest.fixture(scope="module")
def curve(spark):
    """G1A and G2A, January to June 2024."""
    spans = spark.createDataFrame([(c, day(1), day(30, 6)) for c in ("G1A", "G2A")], "category string, first_day date, last_day date")
    return hour_spine(spans).withColumn("profile_fraction", F.lit("0.001").cast("decimal(36,8)")).cache()


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def loaded(spark, curve, **kw):
    t = Target(spark, work_dir(spark, "t"), n_buckets=3)
    load_history(t, ranges_df(spark, ROWS), curve, **kw)
    return t


def files(t):
    return {p: t._files(p) for p in t.partitions()}


def other(curve):
    """February G1A: one day with other values, one without hours; March: a day more values for G2A; nothing in January."""
    f, d = F.col("profile_fraction"), F.col("supply_date")
    new = F.when((d == "2024-02-05") & (F.col("profile_category_code") == "G1A"), f * 3).when((d == "2024-03-01") & (F.col("profile_category_code") == "G2A"), f * 2)
    gone = (d == "2024-02-06") & (F.col("profile_category_code") == "G1A")
    return curve.filter(~gone).withColumn("profile_fraction", F.coalesce(new, f).cast("decimal(36,8)"))


@pytest.mark.parametrize("policy", ["per_day", "per_record", "per_segment"])
def test_a_changed_curve_writes_its_months_only(spark, curve, policy):
    kw = dict(as_of=AS_OF, horizon_days=150, policy=policy)
    t = loaded(spark, curve, **kw)
    before = files(t)
    new = other(curve)
    assert sorted(map(tuple, changed_days(curve, new).select("profile_category_code", F.col("supply_date").cast("string")).collect())) == [
        ("G1A", "2024-02-05"), ("G1A", "2024-02-06"), ("G2A", "2024-03-01")]
    r = ranges_df(spark, ROWS)
    assert apply_curve(t, r, new, **kw) == [(2024, 2), (2024, 3)]
    assert rows_of(t.read()) == rows_of(build_window(r, new, **kw)) != rows_of(build_window(r, curve, **kw))
    after = files(t)
    assert {p for p in before if before[p] != after.get(p)} == {p for p in before if p[2] in (2, 3)}
    assert apply_curve(t, r, new, **kw) == [] and files(t) == after
    apply_curve(t, r, curve, **kw)  # the day without hours comes back
    assert rows_of(t.read()) == rows_of(build_window(r, curve, **kw))


def test_a_changed_curve_reaches_keys_in_delta_batches(spark, curve):
    kw = dict(as_of=AS_OF, horizon_days=150)
    t, r, new = loaded(spark, curve, **kw), ranges_df(spark, ROWS), other(curve)
    append_increment(t, r, r.filter(f"{KEY} like 'L%'").select(KEY), curve, **kw)
    apply_curve(t, r, new, **kw)
    want = rows_of(build_window(r, new, **kw))
    assert t.batches() == [1] and rows_of(t.read()) == want
    fold(t, 0.0)
    assert rows_of(t.read()) == want


def test_an_interrupted_curve_change_is_repeated(spark, curve, monkeypatch):
    kw = dict(as_of=AS_OF, horizon_days=150)
    t, r, new = loaded(spark, curve, **kw), ranges_df(spark, ROWS), other(curve)
    with monkeypatch.context() as m:
        m.setattr(Target, "put_curve", lambda self, c: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            apply_curve(t, r, new, **kw)
    assert t.has_curve(curve)
    apply_curve(t, r, new, **kw)
    assert t.has_curve(new) and rows_of(t.read()) == rows_of(build_window(r, new, **kw))


def test_the_horizon_moves_on(spark, curve):
    r = ranges_df(spark, ROWS)
    t = loaded(spark, curve, as_of=AS_OF, horizon_days=70)
    append_increment(t, r, r.filter(f"{KEY} = 'E1'").select(KEY), as_of=AS_OF, horizon_days=70)
    append_increment(t, r, r.filter(f"{KEY} = 'L1'").select(KEY), as_of=AS_OF, horizon_days=70)
    before = files(t)
    for _ in range(2):  # repeated: the same table
        advance_horizon(t, r, AS_OF, "2024-02-20", horizon_days=70)
        want = rows_of(build_window(r, curve, as_of="2024-02-20", horizon_days=70))
        assert rows_of(t.read()) == want
    assert want != rows_of(build_window(r, curve, as_of=AS_OF, horizon_days=70))
    after = files(t)
    assert all(after[p] == before[p] for p in before if p[1:] < (2024, 3))
    advance_horizon(t, r, "2024-02-20", "2024-02-20", horizon_days=70)
    with pytest.raises(ValueError, match="moves on"):
        advance_horizon(t, r, "2024-02-20", AS_OF, horizon_days=70)
    fold(t, 0.0)
    assert rows_of(t.read()) == want


def test_reload_sets_the_seam_and_a_new_checkpoint(spark, curve):
    root = work_dir(spark, "s")
    versions = [ranges_df(spark, x) for x in (ROWS, ROWS[1:], ROWS[1:-1], [*ROWS[1:-1], row("N", "G1A", 1, 4)])]
    log, state = f"{root}/log", f"{root}/state"
    append_commit(initial_commit(versions[0], 1), log)
    kw = dict(as_of_date=AS_OF, horizon_days=150)
    t = Target(spark, f"{root}/target", n_buckets=3)
    reload_at(t, log, state, curve, 1, **kw)
    first = seam_of(spark, state)
    for i in (1, 2):
        append_commit(snapshot_diff(versions[i - 1], versions[i], version=i + 1), log)
    run_from_seam(spark, t, log, state, curve, **kw)
    want = [rows_of(build_window(v, curve, as_of=AS_OF, horizon_days=150)) for v in versions]
    assert rows_of(t.read()) == want[2]
    reload_at(t, log, state, curve, 2, **kw)  # back to an earlier version: its stream repeats what follows
    assert rows_of(t.read()) == want[1]
    second = seam_of(spark, state)
    assert second[0] == 2 and second[1] != first[1]
    append_commit(snapshot_diff(versions[2], versions[3], version=4), log)
    assert run_from_seam(spark, t, log, state, curve, merge="delta", **kw) == 4
    assert rows_of(t.read()) == want[3]
    assert run_from_seam(spark, t, log, state, curve, **kw) is None
    assert run_stream_increment(spark, t, log, first[1], curve, 1, **kw) == 4  # the old stream changes nothing for the worse
    assert rows_of(t.read()) == want[3]
