"""Increments as delta batches: reads before and after folding equal a rebuild."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, BASE_ROWS, TS2, ranges_df, row
from spanfan.operators.allocate import build_window
from spanfan.plans.history import load_history, reload
from spanfan.plans.increment import append_increment, apply_increment, fold
from spanfan.session import work_dir
from spanfan.sources.changes import append_commit, changed_keys, initial_commit, snapshot_diff
from spanfan.sources.target import Target
from spanfan.streaming.changefeed import run_stream_increment

KEY = "point_of_delivery_ean"
TS3 = TS2.replace(day=3)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def loaded(spark, curve, rows=BASE_ROWS, n_buckets=4):
    t = Target(spark, work_dir(spark, "t"), n_buckets=n_buckets)
    load_history(t, ranges_df(spark, rows), curve, as_of=AS_OF)
    return t


def keys_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], f"{KEY} string")


V2 = [r for r in BASE_ROWS if r[0] not in ("E1", "E2")] + [row("E1", "G1A", 1, 10, ts=TS2), row("N1", "G2A", 3, 9, ts=TS2)]
V3 = [r for r in V2 if r[0] not in ("E1", "N1")] + [row("E1", "G1A", 7, 25, ts=TS3, sja=3000)]


def test_reads_before_and_after_folding(spark, january_curve):
    """Shrink, delete, new key; then a second batch over some of them; then the fold."""
    t = loaded(spark, january_curve)
    v2, v3 = ranges_df(spark, V2), ranges_df(spark, V3)
    before = t.read_base().count()
    for _ in range(2):  # the same keys again change nothing
        append_increment(t, v2, keys_of(spark, "E1", "E2", "N1", None), january_curve, as_of=AS_OF)
        assert same(t.read(), build_window(v2, january_curve, as_of=AS_OF))
    append_increment(t, v3, keys_of(spark, "E1", "N1"), as_of=AS_OF)
    want = build_window(v3, january_curve, as_of=AS_OF)
    assert same(t.read(), want) and t.read_base().count() == before and t.batches() == [1, 2, 3]
    assert same(t.read(years=[2024]), want) and t.read(years=[2023]).count() == 0
    assert sum(t.read(buckets=[b]).count() for b in range(4)) == want.count()
    assert fold(t, 0.0) and t.batches() == [] and t.delta() is None
    assert same(t.read(), want) and same(t.read_base(), want)
    assert append_increment(t, v3, keys_of(spark, "E4"), as_of=AS_OF) == 1
    assert same(t.read(), want)


def test_only_buckets_over_the_share_are_folded(spark, january_curve):
    rows = [row(f"K{i}", "G1A", 1, 20) for i in range(40)]
    t = loaded(spark, january_curve, rows)
    per_bucket = {r[0]: r[1] for r in t.read(with_bucket=True).groupBy("key_bucket").agg(F.collect_set(KEY)).collect()}
    one, other = sorted(per_bucket)[:2]
    wide, narrow = per_bucket[one], per_bucket[other][:1]
    new = [row(k, "G1A", 3, 22, ts=TS2) for k in (*wide, *narrow)]
    v2 = ranges_df(spark, [r for r in rows if r[0] not in {x[0] for x in new}] + new)
    append_increment(t, v2, keys_of(spark, *wide, *narrow), as_of=AS_OF)
    want = build_window(v2, january_curve, as_of=AS_OF)
    assert fold(t, 0.5) == [one] and fold(t, 0.5) == [] and t.batches() == [1]
    assert same(t.read(), want)
    assert fold(t, 0.0) == [other] and same(t.read_base(), want)


def test_a_broken_batch_does_not_count(spark, january_curve):
    t = loaded(spark, january_curve)
    want = t.read().collect()
    append_increment(t, ranges_df(spark, []), keys_of(spark, "E1"), as_of=AS_OF)
    t.remove(f"{t.delta_path}/batch=1/_SUCCESS")  # as if the job had failed before its commit
    assert sorted(t.read().collect()) == sorted(want)
    assert append_increment(t, ranges_df(spark, V2), keys_of(spark, "E1", "E2", "N1"), as_of=AS_OF) == 2
    assert same(t.read(), build_window(ranges_df(spark, V2), january_curve, as_of=AS_OF))


def test_fold_interrupted_before_the_batches_go(spark, january_curve, monkeypatch):
    t = loaded(spark, january_curve)
    v2 = ranges_df(spark, V2)
    append_increment(t, v2, keys_of(spark, "E1", "E2", "N1"), as_of=AS_OF)
    want = build_window(v2, january_curve, as_of=AS_OF)
    with monkeypatch.context() as m:
        m.setattr(Target, "remove", lambda self, path: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            fold(t, 0.0)
    assert t.batches() == [1] and same(t.read(), want)
    fold(t, 0.0)
    assert t.batches() == [] and same(t.read(), want)


def test_other_writers_see_the_delta(spark, january_curve):
    """Rewriting increments and window loads fold first; a reload drops the delta."""
    v2, v3 = ranges_df(spark, V2), ranges_df(spark, V3)
    t = loaded(spark, january_curve)
    append_increment(t, v2, keys_of(spark, "E1", "E2", "N1"), as_of=AS_OF)
    apply_increment(t, v3, january_curve, keys_of(spark, "E1", "N1"), as_of=AS_OF)
    want = build_window(v3, january_curve, as_of=AS_OF)
    assert t.batches() == [] and same(t.read(), want)
    append_increment(t, v2, keys_of(spark, "E1", "N1"), as_of=AS_OF)
    load_history(t, v2, january_curve, windows=[("2024-01-05", "2024-01-09")], as_of=AS_OF)
    assert same(t.read(), build_window(v2, january_curve, as_of=AS_OF))
    append_increment(t, ranges_df(spark, []), keys_of(spark, "E4"), as_of=AS_OF)
    reload(t, v3, january_curve, as_of=AS_OF)
    assert t.batches() == [] and same(t.read(), want)


def test_another_curve_is_refused(spark, january_curve):
    t = loaded(spark, january_curve)
    other = january_curve.withColumn("profile_fraction", (F.col("profile_fraction") * 2).cast("decimal(36,8)"))
    with pytest.raises(ValueError, match="curve"):
        append_increment(t, ranges_df(spark, V2), keys_of(spark, "E1"), other, as_of=AS_OF)
    fresh = Target(spark, work_dir(spark, "t"), n_buckets=2)
    with pytest.raises(ValueError, match="curve"):
        append_increment(fresh, ranges_df(spark, V2), keys_of(spark, "E1"), as_of=AS_OF)
    append_increment(fresh, ranges_df(spark, V2), keys_of(spark, "E1"), january_curve, as_of=AS_OF)
    assert fresh.read().count() == 240


def test_increment_reads_nothing_of_the_base(spark, january_curve):
    t = loaded(spark, january_curve)
    for p in t.partitions():
        t.remove(t._folder(p))
    append_increment(t, ranges_df(spark, V2), keys_of(spark, "E1"), january_curve, as_of=AS_OF)
    assert t.read().count() == 240
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_stream_with_deltas(spark, january_curve):
    root = work_dir(spark, "s")
    v1, v2 = ranges_df(spark, BASE_ROWS), ranges_df(spark, V2)
    append_commit(initial_commit(v1, 1), f"{root}/log")
    t = Target(spark, f"{root}/target", n_buckets=4)
    load_history(t, v1, january_curve, as_of=AS_OF)
    append_commit(snapshot_diff(v1, v2, version=2), f"{root}/log")
    assert changed_keys(spark.read.parquet(f"{root}/log"), 2).count() == 3
    kw = dict(start_version=2, as_of_date=AS_OF, merge="delta", fold_share=10.0)
    assert run_stream_increment(spark, t, f"{root}/log", f"{root}/state", january_curve, **kw) == 2
    assert run_stream_increment(spark, t, f"{root}/log", f"{root}/state", january_curve, **kw) is None
    assert t.batches() == [1] and same(t.read(), build_window(v2, january_curve, as_of=AS_OF))
