"""Span algebra, whole-number allocation, fingerprints, bucketed tables and snapshots from a base."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, BASE_ROWS, TS2, ranges_df, row
from spanfan.functions.allocation import energy, fixed_point, unscaled_fraction, unscaled_quantity, volume
from spanfan.functions.predicates import relevant
from spanfan.operators.allocate import build_window
from spanfan.operators.checks import duplicate_keys, reconcile, table_difference, table_fingerprint_diff, unequal_groups
from spanfan.operators.latest import latest_days, latest_segments
from spanfan.operators import spans
from spanfan.session import work_dir
from spanfan.sources.bucketed import bucketed_merge, changed_pairs, save_bucketed
from spanfan.sources.changes import initial_commit, snapshot_diff
from spanfan.sources.snapshots import SnapshotLog

KEY, CAT = "point_of_delivery_ean", "profile_category_code"
OWN = [KEY, CAT]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list:
    return sorted(map(str, map(tuple, df.collect())))


# ------------------------------------------------------------- whole numbers
@pytest.mark.parametrize("factor", [9.769, 1.0, 0.5, -3.25])
def test_fixed_point_equals_the_decimal_rule(spark, factor):
    """Ties of both roundings, bounds of the long product and of the energy, negative values, nulls."""
    D = Decimal
    rows = [
        (D("1000"), D("0.0626095")), (D("0.001"), D("0.005")), (D("0.001"), D("0.015")), (D("-0.001"), D("0.005")), (D("0"), D("0")),
        (D("9000000000000.000"), D("0.01")), (D("9000000000000.001"), D("10")), (D("999999999999999.999"), D("0.00000001")),
        (D("999999999999999.999"), D("1")), (D("1"), D("9999999999.99999999")), (D("1"), D("10000000000")),
        (D("1"), D("99999999999999999999.99999999")), (None, D("1")), (D("1"), None), (D("8000000"), D("1")), (D("7999999.999"), D("1")),
    ]
    rnd = random.Random(5)
    for _ in range(3000):
        q = D(rnd.randrange(-(10 ** rnd.randrange(1, 17)), 10 ** rnd.randrange(1, 17))) / 1000
        rows.append((q, D(rnd.randrange(-5, 10 ** rnd.randrange(1, 12))) / 10**8))
    df = spark.createDataFrame(rows, "q decimal(18,3), f decimal(36,8)")
    fast = fixed_point(df.withColumn("a", unscaled_quantity(F.col("q"))).withColumn("b", unscaled_fraction(F.col("f"))), "a", "b", "q", "f", factor)
    both = fast.withColumn("m3", volume(F.col("q"), F.col("f"))).withColumn("kwh", energy(F.col("q"), F.col("f"), factor))
    wrong = both.filter("not (m3 <=> offtake_volume_m3) or not (kwh <=> offtake_volume_kwh)")
    assert both.count() == len(rows) and wrong.collect() == []
    assert dict(fast.dtypes)["offtake_volume_m3"] == dict(fast.dtypes)["offtake_volume_kwh"] == "decimal(38,6)"


# ------------------------------------------------------------- overlap join
def day(n) -> dt.date:
    return dt.date(2000, 1, 1) + dt.timedelta(days=n)


def random_spans(rnd, n, keys):
    out = []
    for i in range(n):
        a = rnd.randrange(0, 4000)
        length = rnd.choice([0, 1, 5, 30, 400, 3650])
        out.append((rnd.choice(keys), i, day(a), day(a + rnd.randrange(0, length + 1))))
    return out


@pytest.mark.parametrize("widths", [None, [1], [3, 24], [7, 56, 448, 3584]])
def test_overlap_join_equals_all_pairs(spark, widths):
    rnd = random.Random(3)
    a = random_spans(rnd, 150, ["x", "y", "hot"]) + [(None, 900, day(1), day(9)), ("x", 901, day(9), day(1)), ("x", 902, None, day(5))]
    b = random_spans(rnd, 200, ["x", "hot", "z"]) + [("hot", 7, day(0), day(4000)), ("hot", 7, day(0), day(4000)), (None, 903, day(1), day(9))]
    ddl = "k string, _bin int, s date, e date"
    j = spans.overlap_join(spark.createDataFrame(a, ddl), spark.createDataFrame(b, ddl), ["k"], ("s", "e"), ("s", "e"), widths)
    got = sorted((r["left"]["_bin"], r["right"]["_bin"], r["overlap_from"], r["overlap_to"]) for r in j.collect())
    ok = lambda r: r[0] is not None and None not in r and r[2] <= r[3]
    want = sorted((x[1], y[1], max(x[2], y[2]), min(x[3], y[3])) for x in a for y in b
                  if ok(x) and ok(y) and x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3])
    assert got == want
    assert "NestedLoop" not in plan_of(j) and "Cartesian" not in plan_of(j)


def test_a_long_span_is_a_few_rows(spark):
    df = spark.createDataFrame([("k", 1, day(0), day(3_000_000 // 300)), ("k", 2, day(5), day(6))], "k string, i int, s date, e date")
    widths = [2, 16, 128, 1024, 8192, 65536]
    binned = spans._binned(df, "s", "e", widths, "x")
    counts = {r["i"]: r["count"] for r in binned.groupBy("x.i").count().collect()}
    assert counts[1] <= 2 and counts[2] <= 2 * len(widths)
    assert spans.bin_widths((df.filter("i > 9"), "s", "e")) == [1]


# ------------------------------------------------------------- islands, union, gaps
def ranges_of(spark, seed=4, n=120):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        a = dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randrange(0, 700))
        b = None if rnd.random() < 0.03 else a + dt.timedelta(days=rnd.randrange(-3, 90))
        key = rnd.choice(["A", "B", "C", "hot", "hot", "hot", None])
        rows.append(row(key, rnd.choice(["G1A", "G2A"]), a, b, ts=dt.datetime(2024, 1, 1) + dt.timedelta(hours=i % 50), sja=1000 + i % 3))
    return ranges_df(spark, rows)


SHORT = dict(as_of="2024-06-01", horizon_days=300)


def test_islands_expand_to_latest_per_day(spark):
    r = ranges_of(spark)
    islands = spans.validity_islands(r, **SHORT)
    days = islands.select(*OWN, "sja", "sj_unit_of_measure", "__record_timestamp", F.explode(F.sequence("valid_from", "valid_to")).alias("supply_date"))
    want = latest_days(r, "per_day", **SHORT).select(*days.columns)
    assert rows_of(days) == rows_of(want)
    assert islands.count() < latest_segments(r, **SHORT).count()
    pairs = islands.alias("a").join(islands.alias("b"), OWN).filter("a.valid_to + 1 = b.valid_from and a.__record_timestamp = b.__record_timestamp and a.sja = b.sja")
    assert pairs.count() == 0


def test_gaps_and_measure_by_days(spark, january_curve):
    r = ranges_of(spark)
    days = latest_days(r, "per_day", **SHORT).select(*OWN, "supply_date")
    got = spans.latest_fanout(r, **SHORT)
    covered = {}
    for k, c, d in days.collect():
        covered.setdefault((k, c), set()).add(d)
    n = sum(map(len, covered.values()))
    first = got.first()
    assert (first["n_entity_categories"], first["n_day_rows_latest"], first["n_hour_rows_latest"]) == (len(covered), n, 24 * n)
    assert first["n_spans"] == sum((d - dt.timedelta(days=1)) not in s for s in covered.values() for d in s)
    assert "Generate" not in plan_of(got)

    curve = january_curve.filter("supply_date not between '2024-01-10' and '2024-01-12' and profile_category_code = 'G1A'")
    want = set()
    for (k, c), s in covered.items():
        want |= {(k, c, d, "uncovered") for d in (min(s) + dt.timedelta(days=i) for i in range((max(s) - min(s)).days)) if d not in s}
        has = {dt.date(2024, 1, i) for i in range(1, 32) if i not in (10, 11, 12)} if c == "G1A" else set()
        want |= {(k, c, d, "no_curve") for d in s - has}
    for bound in (spans.HOLES_BROADCAST_MAX_ROWS, 0):  # few holes are broadcast, many are met by bins
        old, spans.HOLES_BROADCAST_MAX_ROWS = spans.HOLES_BROADCAST_MAX_ROWS, bound
        try:
            gaps = spans.coverage_gaps(r, curve, **SHORT).collect()
        finally:
            spans.HOLES_BROADCAST_MAX_ROWS = old
        found = [(g[KEY], g[CAT], g["gap_from"] + dt.timedelta(days=i), g["kind"]) for g in gaps for i in range(g["n_days"])]
        assert len(found) == len(set(found)) and set(found) == want
        assert all((g["gap_to"] - g["gap_from"]).days + 1 == g["n_days"] for g in gaps)


def test_spans_of_nothing(spark, january_curve):
    none = ranges_df(spark, [])
    assert spans.validity_islands(none, as_of=AS_OF).count() == 0 == spans.coverage_gaps(none, january_curve, as_of=AS_OF).count()
    assert tuple(spans.latest_fanout(none, as_of=AS_OF).first()) == (0, 0, 0, 0)


# ------------------------------------------------------------- fingerprints
def test_fingerprint_diff_equals_the_whole_comparison(spark):
    base = [(i % 40, i % 7, f"v{i % 11}" if i % 13 else None) for i in range(3000)]
    other = base[:-3] + [base[0], (3, 2, "new"), (99, 1, None)]  # three rows less, one once more, two new
    a, b = (spark.createDataFrame(x, "k int, m int, v string") for x in (base, other))
    groups = [F.pmod("k", F.lit(16)), F.col("m")]
    assert rows_of(table_fingerprint_diff(a, b, groups)) == rows_of(table_difference(a, b)) != []
    changed = {(r[0] % 16, r[1]) for r in (*base[-3:], base[0], (3, 2), (99, 1))}
    assert {tuple(r) for r in unequal_groups(a, b, groups).collect()} == changed
    assert table_fingerprint_diff(a, a.repartition(3), groups).count() == 0
    same_xor = spark.createDataFrame([(1, 1, "x")] * 2, a.schema)  # a pair of equal rows is not nothing
    assert table_fingerprint_diff(same_xor, same_xor.limit(0), groups).count() == 2


# ------------------------------------------------------------- bucketed tables
def test_checks_and_merge_on_bucketed_tables_without_exchange(spark, january_curve):
    rows = build_window(ranges_df(spark, BASE_ROWS), january_curve, as_of=AS_OF)
    v2 = [r for r in BASE_ROWS if r[0] not in ("E1", "E2")] + [row("E1", "G1A", 1, 10, ts=TS2)]
    want = build_window(ranges_df(spark, v2), january_curve, as_of=AS_OF)
    keys = spark.createDataFrame([("E1",), ("E2",)], f"{KEY} string")
    conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        t = save_bucketed(rows, "bt_target", work_dir(spark, "bt"), 4)
        new = save_bucketed(want.join(keys, KEY, "left_semi").select(*want.columns), "bt_new", work_dir(spark, "bn"), 4)
        twice = save_bucketed(rows.union(rows.limit(3)), "bt_twice", work_dir(spark, "bt"), 4)
        assert duplicate_keys(twice).count() == 3 and duplicate_keys(t).count() == 0
        assert rows_of(reconcile(t)) == rows_of(reconcile(rows))
        pairs = changed_pairs(t, new, keys)
        path = work_dir(spark, "bp")
        pairs.repartition(4, *OWN).write.format("parquet").option("path", path).bucketBy(4, *OWN).sortBy(*OWN).saveAsTable("bt_pairs")
        merged = bucketed_merge(spark, "bt_target", "bt_pairs", "bt_new")
        assert rows_of(merged) == rows_of(want)
        kept = spark.table("bt_target").join(spark.table("bt_pairs").hint("merge"), OWN, "left_anti")
        for df in (duplicate_keys(t), reconcile(t), kept, reconcile(kept)):
            assert "Exchange" not in plan_of(df), plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
        for name in ("bt_target", "bt_new", "bt_pairs", "bt_twice"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


# ------------------------------------------------------------- snapshots from a base
def test_snapshots_read_the_tail_only(spark):
    states = [BASE_ROWS, BASE_ROWS[1:], BASE_ROWS[1:] + [row("N", "G1A", 1, 2)], BASE_ROWS[3:], BASE_ROWS[3:] + BASE_ROWS[:1] * 2]
    dfs = [ranges_df(spark, s) for s in states]
    log = SnapshotLog(spark, work_dir(spark, "snap"))
    assert log.compact(1) is None
    log.append(initial_commit(dfs[0], 1))
    for i in range(1, 3):
        log.append(snapshot_diff(dfs[i - 1], dfs[i], version=i + 1))
    assert log.compact(4) is None and log.compact(3) == 3 and log.bases() == [3]
    for i in range(3, 5):
        log.append(snapshot_diff(dfs[i - 1], dfs[i], version=i + 1))
    assert log.versions() == [1, 2, 3, 4, 5] and log.log().select("_commit_version").distinct().count() == 5
    for i, df in enumerate(dfs):
        assert rows_of(log.as_of(i + 1)) == rows_of(df)
    files = log.as_of(5).inputFiles()
    assert any("/base/version=3/" in f for f in files)
    assert {f.split("_commit_version=")[1].split("/")[0] for f in files if "_commit_version=" in f} == {"4", "5"}
    keys = spark.createDataFrame([("E1",), ("E4",)], f"{KEY} string")
    assert rows_of(log.as_of(5, keys)) == rows_of(dfs[4].filter(f"{KEY} in ('E1', 'E4')"))
    late = snapshot_diff(dfs[4], dfs[4].union(ranges_df(spark, [row("L", "G1A", 1, 2)])), version=2)
    log.append(late)  # the base at 3 does not know it
    assert log.bases() == [] and rows_of(log.as_of(5)) == rows_of(dfs[4].union(ranges_df(spark, [row("L", "G1A", 1, 2)])))
    log.append(late.limit(0))
    assert rows_of(ranges_of(spark).filter(relevant())) != []


# ------------------------------------------------------------- draws, tables and their schemas
def test_hash_draws_and_entity_codes(spark):
    from spanfan.functions.draws import entity_code, hash_unif

    df = spark.range(20_000).select("id", hash_unif(F.col("id")).alias("u"), hash_unif(F.col("id"), salt=1).alias("v"), entity_code(F.col("id")).alias("e"))
    again = df.repartition(7).select(*df.columns)
    assert table_difference(df, again).count() == 0  # no state, no order
    s = df.agg(F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("u").alias("m"), F.corr("u", "v").alias("c"), F.countDistinct("e").alias("n"),
               F.min(F.length("e")).alias("a"), F.max(F.length("e")).alias("b")).first()
    assert 0 <= s["lo"] < 0.001 and 0.999 < s["hi"] < 1 and abs(s["m"] - 0.5) < 0.01 and abs(s["c"]) < 0.03
    assert (s["n"], s["a"], s["b"]) == (20_000, 18, 18) and df.filter("id = 42").first()["e"] == "871000000000000042"


def test_seeded_noise_keeps_the_profile_in_its_bounds(spark, january_curve):
    from spanfan.sources.curve import standard_profile

    spine = january_curve.select("profile_category_code", "supply_start_date_time_utc", "supply_year", "supply_month", "supply_date", "supply_hour")
    plain = standard_profile(spine).select("realized_temperature", "supply_start_date_time_utc", "profile_category_code", "profile_fraction")
    noisy = standard_profile(spine, noise=F.rand(3)).withColumnsRenamed({"realized_temperature": "t", "profile_fraction": "f"})
    both = plain.join(noisy, ["supply_start_date_time_utc", "profile_category_code"]).withColumn("d", F.col("t") - F.col("realized_temperature"))
    s = both.agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.countDistinct("d").alias("n"), F.sum((F.col("f") != F.col("profile_fraction")).cast("int")).alias("x")).first()
    assert s["hi"] - s["lo"] > 0 and s["n"] > 500 and s["x"] == 0


def test_writes_follow_the_schema_rule(spark):
    from spanfan.sources.tables import SchemaChange, read_source, schema_changes, write_table

    path = work_dir(spark, "table")
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    write_table(one, path)
    write_table(one.select("v", "k"), path)  # another order is no change
    read_source(spark, path).createOrReplaceTempView("source_view")
    assert rows_of(read_source(spark, "source_view")) == rows_of(one.union(one))
    wide = spark.createDataFrame([(2, "b", 1.5)], "k int, v string, w double")
    other = spark.createDataFrame([("x", "b")], "k string, v string")
    read = lambda: sorted(map(tuple, spark.read.option("mergeSchema", "true").parquet(path).collect()), key=str)
    for df, mode in ((wide, "append"), (other, "append"), (wide, "overwrite"), (one.drop("v"), "append")):
        with pytest.raises(SchemaChange):
            write_table(df, path, mode)
    assert read() == [(1, "a")] * 2  # nothing was touched
    with pytest.raises(SchemaChange, match="k: int became string"):
        write_table(other, path, "append", "add")
    write_table(wide, path, "append", "add")
    write_table(one.drop("v"), path, "append", "add")
    assert read() == sorted([(1, "a", None)] * 2 + [(2, "b", 1.5), (1, None, None)], key=str)
    write_table(spark.read.option("mergeSchema", "true").parquet(path).filter("k = 2"), path, "overwrite")  # from itself
    assert read() == [(2, "b", 1.5)]
    write_table(other, path, "overwrite", "replace", ("v",))
    assert spark.read.parquet(path).columns == ["k", "v"] and read() == [("x", "b")] and "v=b" in spark.read.parquet(path).inputFiles()[0]
    assert schema_changes(one.schema, wide.schema) == ["added w double"] and schema_changes(one.schema, one.schema) == []
    with pytest.raises(ValueError, match="no write"):
        write_table(one, path, "append", "replace")


def test_listing_of_many_partitions_in_one_answer(spark, january_curve, monkeypatch):
    from spanfan.plans.history import load_history
    from spanfan.sources import target
    from spanfan.sources.target import Target

    t = Target(spark, work_dir(spark, "t"), n_buckets=5)
    assert t.partitions() == [] and t.files([(0, 2024, 1)]) == {}
    load_history(t, ranges_df(spark, BASE_ROWS), january_curve, as_of=AS_OF)
    parts = t.partitions()
    few = t.files(parts)
    monkeypatch.setattr(target, "FEW_PARTITIONS", 0)
    assert t.files(parts) == few and set(few) == set(parts) and t.files(parts[:1]) == {parts[0]: few[parts[0]]}
    load_history(t, ranges_df(spark, BASE_ROWS[:1]), january_curve, as_of=AS_OF)
    assert t.read().count() == 480 and len(t.partitions()) == 1
