"""Maintenance from the second input: a changed curve, and a horizon that moves on.

An entity is not rebuilt when the curve changes. ``apply_curve`` compares the new curve with the one stored with
the table, hour by hour; the changed (category, day) pairs say which months are touched. In these, the ranges that cover a
changed day give it again if the new curve has hours for it, and the other stored days are carried over; months
without a change are neither read nor written. Delta batches hold date spans, which
a curve does not change. All readers take the new curve as soon as it is stored, which is
the last step. A repeat after a failure finds the old curve stored and does the same again.

``advance_horizon`` adds the days that enter the horizon when ``as_of`` moves on: ranges that reach beyond the old
cap are allocated for the new days only, in the base for all keys, and as further segments for the
keys that live in delta batches.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CURVE, HORIZON_DAYS, RANGE, RELEVANCE, RangeCols
from ..functions.dates import as_date
from ..functions.predicates import relevant
from ..operators.allocate import latest_spans
from ..operators.join import MONTH
from ..operators.latest import latest_per_record
from ..operators.ranges import expand_pieces, month_pieces
from ..session import remove_dir, work_dir
from ..sources.target import CURVE_COLS, PART_COLS, Target
from .history import load_history
from .increment import KEYS_BROADCAST_MAX_BYTES, _segments, table_segments

CATEGORY, DAY = CURVE.category, CURVE.day


def changed_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct ``category, day, supply_year, supply_month`` whose hours differ between two curves
    (added, removed or with other values); one shuffle by hour."""
    signed = old.select(*CURVE_COLS, F.lit(-1).alias("_v")).unionByName(new.select(*CURVE_COLS, F.lit(1).alias("_v")))
    net = signed.groupBy(*CURVE_COLS).agg(F.sum("_v").alias("_n")).filter(F.col("_n") != 0)
    return net.select(CATEGORY, DAY, *MONTH).distinct()


def apply_curve(
    target: Target,
    ranges: DataFrame,
    curve: DataFrame,
    policy: str = "per_day",
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    cols: RangeCols = RANGE,
) -> list[tuple[int, int]]:
    """Bring the table to ``curve``; returns the (year, month) pairs that were written. ``ranges`` and
    ``as_of`` are those of the table."""
    stored = target.curve()
    if stored is None:
        raise ValueError("the table has no stored curve to compare with: load its history first")
    spark, scratch = target.spark, work_dir(target.spark, "curve-change")
    changed_days(stored, curve).write.parquet(f"{scratch}/days")
    days = spark.read.parquet(f"{scratch}/days")
    months = sorted((r[0], r[1]) for r in days.select(*MONTH).distinct().collect())  # one row a month of the curve
    if not months:
        remove_dir(spark, scratch)
        return []
    if target.bytes_of(f"{scratch}/days") <= KEYS_BROADCAST_MAX_BYTES:
        days = F.broadcast(days)
    bounds = days.agg(F.min(DAY).alias("lo"), F.max(DAY).alias("hi")).first()

    r = ranges if relevance is None else ranges.filter(relevant(relevance))
    if policy == "per_record":
        r = latest_per_record(r, cols)
    pieces = month_pieces(r, cols, bounds["lo"], bounds["hi"], as_of, horizon_days)
    changed = days.select(F.col(CATEGORY).alias(cols.category), DAY)
    own = [cols.category, *MONTH]
    changed_months = days.select(F.col(CATEGORY).alias(cols.category), *MONTH).distinct()
    cut = pieces.join(changed_months, own, "left_semi").drop(*MONTH).withColumnsRenamed({"piece_from": cols.start, "piece_to": cols.end})
    new_days = curve.select(F.col(CATEGORY).alias(cols.category), DAY).join(changed, [cols.category, DAY], "left_semi").distinct()
    rows = _by_day(table_segments(target, cut, curve, None, None, "per_day", None, None, None, cols)).join(
        new_days, [cols.category, DAY], "left_semi"
    )

    parts = [p for p in target.partitions() if p[1:] in set(months)]
    month = F.struct(*MONTH)
    wanted = [F.struct(F.lit(y).alias(MONTH[0]), F.lit(m).alias(MONTH[1])) for y, m in months]
    base = target.read_segments(years={y for y, _ in months}).filter(month.isin(*wanted))
    same = _by_day(base.join(changed_months, own, "left_semi")).join(changed, [cols.category, DAY], "left_anti")
    one_day = same.unionByName(rows).withColumn("seg_from", F.col(DAY)).withColumn("seg_to", F.col(DAY)).drop(DAY)
    segments = base.join(changed_months, own, "left_anti").unionByName(one_day)
    target.replace(segments.repartition(*PART_COLS).sortWithinPartitions(*PART_COLS), parts)
    target.put_curve(curve)
    remove_dir(spark, scratch)
    return months


def _by_day(segments: DataFrame) -> DataFrame:
    """One row a day of the segments."""
    return expand_pieces(segments.withColumnsRenamed({"seg_from": "piece_from", "seg_to": "piece_to"}), DAY)


def advance_horizon(
    target: Target,
    ranges: DataFrame,
    old_as_of,
    as_of,
    policy: str = "per_day",
    horizon_days: int = HORIZON_DAYS,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    cols: RangeCols = RANGE,
) -> None:
    """Add the days after ``old_as_of + horizon_days`` up to ``as_of + horizon_days``. Repeating it
    gives the same table."""
    spark = target.spark
    window = spark.range(1).select(
        F.date_add(as_date(old_as_of), horizon_days + 1).cast("string"), F.date_add(as_date(as_of), horizon_days).cast("string")
    ).first()
    if window[0] > window[1]:
        if str(old_as_of)[:10] > str(as_of)[:10]:
            raise ValueError("the horizon only moves on; load the history again for an earlier one")
        return
    delta = target.delta()
    if delta is not None:
        marks, _ = target.newest(delta)
        r = ranges if relevance is None else ranges.filter(relevant(relevance))
        keys = marks.select(cols.key).distinct()
        scoped = r.join(keys, cols.key, "left_semi")
        spans, sf, st = latest_spans(scoped, policy, cols, window[0], window[1], as_of, horizon_days, target.n_buckets)
        target.append_delta(_segments(spans, sf, st, cols))
    load_history(target, ranges, target.curve(), [tuple(window)], policy, as_of, horizon_days, relevance, target.factor,
                 cols, keep_delta=True)
