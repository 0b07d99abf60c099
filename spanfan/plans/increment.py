"""Increment: rebuild changed entities (X6) and merge them into a ``Target``
with retraction (M1), idempotently.

Two ways to the same rows:

* ``append_increment`` writes a delta batch: the changed keys and their current
  segments. Its cost follows the change (the ranges are scanned once, nothing of the target is read); readers
  merge. ``fold`` later writes the buckets whose delta has grown to a share of their base.
* ``apply_increment`` rewrites the touched partitions of the base at once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CURVE, HORIZON_DAYS, M3_TO_KWH, RANGE, RELEVANCE, CurveCols, RangeCols
from ..functions.predicates import relevant
from ..operators.allocate import build_window, latest_spans
from ..operators.join import MONTH, prune_curve
from ..operators.ranges import month_pieces
from ..session import remove_dir, work_dir
from ..sources.target import PART_COLS, SEGMENT_COLS, SEGMENT_TYPES, Partition, Target, key_bucket

# keys (one string and one int each) that may be broadcast, about 10 MB
KEYS_BROADCAST_MAX_ROWS = 100_000
# the same bound for keys in Parquet files, whose size is known without a job
KEYS_BROADCAST_MAX_BYTES = 4 << 20
# share of a bucket's base rows that its delta may stand for before it is folded
FOLD_SHARE = 0.1


def scoped_ranges(ranges: DataFrame, keys: DataFrame, relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
                  cols: RangeCols = RANGE) -> DataFrame:
    """The relevant range rows of ``keys``."""
    r = ranges if relevance is None else ranges.filter(relevant(relevance))
    return r.join(keys.select(cols.key).distinct(), cols.key, "left_semi")


def rebuild_changed(
    ranges: DataFrame,
    curve: DataFrame,
    keys: DataFrame,
    policy: str = "per_day",
    strategy: str = "days",
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    factor: float = M3_TO_KWH,
    cols: RangeCols = RANGE,
    cc: CurveCols = CURVE,
    grain: str = "hours",
) -> DataFrame:
    """Current hourly rows (or days or segments, see ``build_window``) of the changed keys, from the current source.

    The source is scoped by a semi join with the key DataFrame before anything
    is expanded, then built like history without a window. A key with no
    current relevant record yields no rows, which the merge turns into a full
    retraction.

    ``policy="per_day"`` makes increment and history agree; ``per_record``
    is the single-latest-record rule for sources that append corrections."""
    scoped = scoped_ranges(ranges, keys, relevance, cols)
    return build_window(scoped, curve, None, None, policy, strategy, as_of, horizon_days, None, factor, cols, cc, grain=grain)


def affected_partitions(target: Target, keys: DataFrame, scoped: DataFrame, buckets: list[int], as_of=None,
                        horizon_days: int | None = HORIZON_DAYS, cols: RangeCols = RANGE) -> list[Partition]:
    """Partitions with an old row of ``keys`` (key column of their buckets only)
    or a month piece of their current ranges. At most one row per partition
    of these buckets reaches the driver."""
    old = target.read_segments(buckets=buckets).join(keys, ["key_bucket", cols.key], "left_semi")
    new = month_pieces(scoped, cols, None, None, as_of, horizon_days, keep=[cols.key]).withColumn(
        "key_bucket", key_bucket(cols.key, target.n_buckets)
    )
    parts = old.select(*PART_COLS).distinct().unionByName(new.select(*PART_COLS).distinct()).distinct()
    return sorted(tuple(r) for r in parts.collect())


def apply_increment(
    target: Target,
    ranges: DataFrame,
    curve: DataFrame,
    keys: DataFrame,
    policy: str = "per_day",
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    factor: float = M3_TO_KWH,
    cols: RangeCols = RANGE,
    cc: CurveCols = CURVE,
) -> None:
    """Merge the rebuilt segments of ``keys`` into ``target``. ``curve`` must be the table's.

    The keys and the scoped range rows are written to the shared folder once:
    both are used twice, and it cuts the lineage back to the change log. Only
    the buckets of the keys are read (static partition pruning), and only
    (bucket, year, month) partitions with an old or a new row of a changed key
    are rewritten: rows of other keys are carried over, the changed keys' rows
    are replaced, and a partition left without rows is removed. Applying the
    same keys again gives the same table."""
    if factor != target.factor:
        raise ValueError(f"the table has the factor {target.factor}, not {factor}")
    spark, key = target.spark, cols.key
    target.follow(curve)
    fold(target, 0.0)
    scratch = work_dir(spark, "increment")
    keys.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(
        "key_bucket", key_bucket(key, target.n_buckets)
    ).write.parquet(f"{scratch}/keys")
    k = spark.read.parquet(f"{scratch}/keys")
    scoped_ranges(ranges, k, relevance, cols).write.parquet(f"{scratch}/ranges")
    scoped = spark.read.schema(ranges.schema).parquet(f"{scratch}/ranges")
    if k.count() <= KEYS_BROADCAST_MAX_ROWS:
        k = F.broadcast(k)
    buckets = [r[0] for r in k.select("key_bucket").distinct().collect()]  # at most n_buckets
    affected = affected_partitions(target, k, scoped, buckets, as_of, horizon_days, cols)
    rows = table_segments(target, scoped, curve, None, None, policy, as_of, horizon_days, None, cols, cc)
    if affected:
        # bounded by the partitions of the buckets
        parts = F.broadcast(spark.createDataFrame(affected, ", ".join(f"{c} int" for c in PART_COLS)))
        old = target.read_segments(years={p[1] for p in affected}, buckets=buckets)
        carried = old.join(parts, PART_COLS, "left_semi").join(k, ["key_bucket", key], "left_anti")
        rows = carried.unionByName(rows)  # the new rows lie by partition already, the carried ones stay where they are
    target.replace(rows, affected)
    remove_dir(spark, scratch)


def append_increment(
    target: Target,
    ranges: DataFrame,
    keys: DataFrame,
    curve: DataFrame | None = None,
    policy: str = "per_day",
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    cols: RangeCols = RANGE,
) -> int:
    """Write the changed ``keys`` and their current segments as a delta batch; returns its number.

    A key without a current relevant record has its marker only, which retracts it. The same
    keys again give a newer batch with the same rows. The hours follow the curve stored with the
    table; ``curve`` (optional) must be that one: another is a change of the second input
    (``plans.curve_change``), which concerns all keys."""
    spark, key = target.spark, cols.key
    if curve is not None:
        target.follow(curve)
    if target.curve() is None:
        raise ValueError("the table has no stored curve: load its history first")
    scratch = work_dir(spark, "increment")
    keys.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(
        "key_bucket", key_bucket(key, target.n_buckets)
    ).write.parquet(f"{scratch}/keys")
    k = spark.read.schema(f"{key} string, key_bucket int").parquet(f"{scratch}/keys")
    if target.bytes_of(f"{scratch}/keys") <= KEYS_BROADCAST_MAX_BYTES:
        k = F.broadcast(k)
    spans, sf, st = latest_spans(scoped_ranges(ranges, k, relevance, cols), policy, cols, None, None, as_of, horizon_days, target.n_buckets)
    batch = target.append_delta(_markers(k, cols).unionByName(_segments(spans, sf, st, cols)))
    remove_dir(spark, scratch)
    return batch


def table_segments(
    target: Target,
    ranges: DataFrame,
    curve: DataFrame,
    lo=None,
    hi=None,
    policy: str = "per_day",
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    cols: RangeCols = RANGE,
    cc: CurveCols = CURVE,
) -> DataFrame:
    """X3 as the table stores it: the segments of the days ``lo..hi`` in months for which the curve has hours, dealt and
    ordered as the partitions want them. Their hours are those of ``build_window``."""
    r = ranges if relevance is None else ranges.filter(relevant(relevance))
    spans, sf, st = latest_spans(r, policy, cols, lo, hi, as_of, horizon_days, target.n_buckets)
    months = prune_curve(curve, lo, hi, cc).select(F.col(cc.category).alias(cols.category), *MONTH).distinct()
    rows = _segments(spans, sf, st, cols).join(F.broadcast(months), [cols.category, *MONTH], "left_semi")
    return rows.sortWithinPartitions(*PART_COLS, cols.key)


def _segments(spans: DataFrame, sf: str, st: str, cols: RangeCols) -> DataFrame:
    named = spans.withColumnsRenamed({sf: "seg_from", st: "seg_to"})
    return named.select("key_bucket", cols.key, *SEGMENT_COLS)


def _markers(keys: DataFrame, cols: RangeCols) -> DataFrame:
    nulls = [F.lit(None).cast(t).alias(c) for c, t in SEGMENT_TYPES.items()]
    return keys.select("key_bucket", cols.key, *nulls)


def fold(target: Target, share: float = FOLD_SHARE, cols: RangeCols = RANGE) -> list[int]:
    """Write the delta of those buckets into the base in which it stands for at least ``share`` of the base
    rows (an estimate: 24 hours a day, a month for a retracted key); returns the buckets.

    Partitions with an old row of a changed key or with a segment of one are written anew. Rows of other
    keys are carried over where they lie: only the new rows are shuffled. The batches' folders of a bucket are removed last, so a
    reader, or a repeat after a failure, sees the same rows at any time."""
    delta = target.delta()
    if delta is None:
        return []
    spark, key, batches = target.spark, cols.key, target.batches()
    marks, segments = target.newest(delta)
    days = F.sum(F.datediff("seg_to", "seg_from") + 1)
    hours = (
        marks.join(segments.groupBy("key_bucket", key).agg((24 * days).alias("hours")), ["key_bucket", key], "left")
        .groupBy("key_bucket").agg(F.sum(F.coalesce("hours", F.lit(24 * 30))).alias("hours"))
    )
    base = target.read_segments().groupBy("key_bucket").agg((24 * days).alias("rows"))
    due = hours.join(base, "key_bucket", "left").filter(F.col("hours") >= share * F.coalesce("rows", F.lit(0)))
    buckets = sorted(r[0] for r in due.select("key_bucket").collect())  # at most n_buckets
    if not buckets:
        return []
    scratch = work_dir(spark, "fold")
    mine = F.col("key_bucket").isin(buckets)
    marks.filter(mine).select("key_bucket", key).write.parquet(f"{scratch}/keys")
    segments.filter(mine).write.parquet(f"{scratch}/segments")
    k = spark.read.parquet(f"{scratch}/keys")
    if target.bytes_of(f"{scratch}/keys") <= KEYS_BROADCAST_MAX_BYTES:
        k = F.broadcast(k)
    new = spark.read.parquet(f"{scratch}/segments")
    old = target.read_segments(buckets=buckets)
    parts = old.join(k, ["key_bucket", key], "left_semi").select(*PART_COLS).distinct().unionByName(new.select(*PART_COLS).distinct())
    affected = sorted(tuple(r) for r in parts.distinct().collect())  # bounded by the partitions of the buckets
    if affected:
        touched = F.broadcast(spark.createDataFrame(affected, ", ".join(f"{c} int" for c in PART_COLS)))
        stay = target.read_segments({p[1] for p in affected}, buckets).join(touched, PART_COLS, "left_semi")
        rows = new.repartition(*PART_COLS).sortWithinPartitions(*PART_COLS)
        target.replace(stay.join(k, ["key_bucket", key], "left_anti").unionByName(rows), affected)
    for n in batches:
        for b in buckets:
            target.remove(f"{target.delta_path}/batch={n}/key_bucket={b}")
        if not target._glob(f"{target.delta_path}/batch={n}/key_bucket=*"):
            target.remove(f"{target.delta_path}/batch={n}")
    remove_dir(spark, scratch)
    return buckets
