"""Allocation of annual quantities to hours (X2) and one window of history."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CURVE, FRACTION_TYPE, HORIZON_DAYS, M3_TO_KWH, RANGE, RELEVANCE, CurveCols, RangeCols
from ..functions.allocation import THOUSANDTHS, fixed_point, narrow_fraction, parts, unscaled_fraction, unscaled_quantity
from ..functions.dates import next_hour
from ..functions.predicates import relevant
from .join import (
    CURVE_BROADCAST_MAX_BYTES,
    STRATEGIES,
    broadcast_if_small,
    join_days,
    join_spans,
    join_spans_by_month,
    prune_curve,
)
from .latest import latest_days, latest_per_record, latest_segments
from .ranges import deal_pieces, expand_pieces, month_pieces


def target_columns(cols: RangeCols = RANGE, cc: CurveCols = CURVE) -> list:
    """The 13 columns of the hourly target, from a joined row with its volume and energy and the end of its hour."""
    q, f = F.col(cols.quantity), F.col(cc.fraction)
    return [
        F.col(cols.key),
        F.col(cc.category).alias(cols.category),
        q.alias(cols.quantity),
        F.col(cols.unit),
        F.col(cc.hour_start),
        F.col("_end").alias("supply_end_date_time_utc"),
        F.col(cc.hour),
        f.alias(cc.fraction),
        F.col("offtake_volume_m3"),
        F.col("offtake_volume_kwh"),
        F.col("supply_year"),
        F.col("supply_month"),
        F.col(cols.seq),
    ]


def allocate_days(days: DataFrame, curve: DataFrame, cols: RangeCols = RANGE, cc: CurveCols = CURVE,
                  factor: float = M3_TO_KWH, day_col: str = "supply_date", with_parts: bool = False) -> DataFrame:
    """J1 + projection: deduplicated day rows -> hourly target rows. ``with_parts`` keeps what ``exact_sum`` adds up and
    ``exact_max`` compares."""
    days, curve = _unscaled(days, curve, cols, cc)
    return _target(join_days(days, curve, cols.category, day_col, cc), cols, cc, factor, with_parts)


def allocate_spans(spans: DataFrame, curve: DataFrame, strategy: str, span_from: str, span_to: str,
                   cols: RangeCols = RANGE, cc: CurveCols = CURVE, factor: float = M3_TO_KWH,
                   with_parts: bool = False) -> DataFrame:
    """J2 / J2b + projection: non-overlapping date spans -> hourly rows."""
    spans, curve = _unscaled(spans, curve, cols, cc)
    if strategy == "range":
        j = join_spans(spans, curve, cols.category, span_from, span_to, cc)
    elif strategy == "months":
        j = join_spans_by_month(spans, curve, cols.category, span_from, span_to, cc)
    else:
        raise ValueError(f"span strategy must be 'range' or 'months', not {strategy!r}")
    return _target(j, cols, cc, factor, with_parts)


def _unscaled(rows: DataFrame, curve: DataFrame, cols: RangeCols, cc: CurveCols) -> tuple[DataFrame, DataFrame]:
    """What an hour needs of its day, span or curve row alone, made there, before the fan-out: quantity and fraction as longs
    too, the end of the hour, and the fraction as a decimal that needs no big integer (the wide one stays where there is no
    such). Rows that carry ``_q`` keep it: Spark puts off a projection below a join to the rows of the join."""
    f = F.col(cc.fraction)
    more = {"_f": unscaled_fraction(f), "_end": next_hour(F.col(cc.hour_start))}
    if curve.schema[cc.fraction].dataType.simpleString() == FRACTION_TYPE:
        more |= {"_narrow": narrow_fraction(f), cc.fraction: F.when(narrow_fraction(f).isNull(), f)}
    return _with_longs(rows, cols), curve.withColumns(more)


def _with_longs(rows: DataFrame, cols: RangeCols) -> DataFrame:
    return rows if "_q" in rows.columns else rows.withColumn("_q", unscaled_quantity(F.col(cols.quantity)))


def _target(joined: DataFrame, cols: RangeCols, cc: CurveCols, factor: float, with_parts: bool) -> DataFrame:
    """Target columns, the bucket when the rows carry one, and the parts of volume, energy and quantity if wanted."""
    more = ["key_bucket"] if "key_bucket" in joined.columns else []
    if with_parts:
        more += [*parts("offtake_volume_m3"), *parts("offtake_volume_kwh"), cols.quantity + THOUSANDTHS]
        joined = joined.withColumn(cols.quantity + THOUSANDTHS, F.col("_q"))
    if "_narrow" in joined.columns:
        joined = joined.withColumn(cc.fraction, F.coalesce(F.col("_narrow").cast(FRACTION_TYPE), F.col(cc.fraction)))
    return fixed_point(joined, "_q", "_f", cols.quantity, cc.fraction, factor).select(*target_columns(cols, cc), *more)


def segment_hours(segments: DataFrame, curve: DataFrame, cols: RangeCols = RANGE, cc: CurveCols = CURVE, factor: float = M3_TO_KWH,
                  with_parts: bool = False) -> DataFrame:
    """Hourly target rows of segments (``seg_from..seg_to`` inside a month): days first, each of which meets its own hours only."""
    days = expand_pieces(_with_longs(segments, cols).withColumnsRenamed({"seg_from": "piece_from", "seg_to": "piece_to"}))
    return allocate_days(days, broadcast_if_small(curve), cols, cc, factor, with_parts=with_parts)


def latest_spans(ranges: DataFrame, policy: str, cols: RangeCols = RANGE, lo=None, hi=None, as_of=None,
                 horizon_days: int | None = HORIZON_DAYS, n_buckets: int | None = None) -> tuple[DataFrame, str, str]:
    """Non-overlapping spans per (key, category) after dedup, each inside one
    month, and the names of their bound columns."""
    if policy == "per_record":
        pieces = month_pieces(latest_per_record(ranges, cols), cols, lo, hi, as_of, horizon_days)
        return deal_pieces(pieces, cols, n_buckets), "piece_from", "piece_to"
    if policy in ("per_day", "per_segment"):
        return latest_segments(ranges, cols, lo, hi, as_of, horizon_days, n_buckets), "seg_from", "seg_to"
    raise ValueError(f"unknown policy {policy!r}")


def build_window(
    ranges: DataFrame,
    curve: DataFrame,
    lo=None,
    hi=None,
    policy: str = "per_day",
    strategy: str = "days",
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    factor: float = M3_TO_KWH,
    cols: RangeCols = RANGE,
    cc: CurveCols = CURVE,
    broadcast_max_bytes: int = CURVE_BROADCAST_MAX_BYTES,
    n_buckets: int | None = None,
    with_parts: bool = False,
    grain: str = "hours",
) -> DataFrame:
    """Hourly target rows for the days ``lo..hi`` (``None``: unbounded).

    relevance filter -> guard and clip to window and horizon -> dedup under
    ``policy`` -> fan-out with ``strategy`` -> target columns. Windows are
    independent, so loading window by window equals one load. With
    ``n_buckets`` the rows carry ``key_bucket`` and lie as the target's
    partitions want them: the pieces are dealt by (bucket, year, month) and
    ordered by it before the hours are made, so a write needs neither a shuffle nor a
    sort of hourly rows. ``grain`` is ``days`` or ``segments`` for the rows before the fan-out, which merges take: an hour
    is one of these and a curve row, so rows that are merged before the fan-out are the merged hours."""
    if grain not in ("hours", "days", "segments"):
        raise ValueError(f"unknown grain {grain!r}")
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; expected one of {STRATEGIES}")
    r = ranges if relevance is None else ranges.filter(relevant(relevance))
    if grain == "days":
        return latest_days(r, policy, cols, lo, hi, as_of, horizon_days, n_buckets)
    if grain == "segments":
        spans, sf, st = latest_spans(r, policy, cols, lo, hi, as_of, horizon_days, n_buckets)
        return spans.withColumnsRenamed({sf: "seg_from", st: "seg_to"})
    c = broadcast_if_small(prune_curve(curve, lo, hi, cc), broadcast_max_bytes)
    r, cols = _with_longs(r, cols), replace(cols, extra=(*cols.extra, "_q"))
    if strategy == "days":
        days = latest_days(r, policy, cols, lo, hi, as_of, horizon_days, n_buckets)
        if n_buckets:
            days = days.sortWithinPartitions("key_bucket", "supply_year", "supply_month", cols.key)
        return allocate_days(days, c, cols, cc, factor, with_parts=with_parts)
    spans, sf, st = latest_spans(r, policy, cols, lo, hi, as_of, horizon_days, n_buckets)
    if n_buckets:
        spans = spans.sortWithinPartitions("key_bucket", "supply_year", "supply_month", cols.key)
    return allocate_spans(spans, c, strategy, sf, st, cols, cc, factor, with_parts)


def allocate_daily(days: DataFrame, day_curve: DataFrame, cols: RangeCols = RANGE, cc: CurveCols = CURVE,
                   day_col: str = "supply_date") -> DataFrame:
    """Daily totals without hourly rows: days x daily-summed curve.

    ``day_volume_m3 = quantity * sum(fraction of the day)``. Equal to the sum
    of the hourly volumes only up to rounding (hourly volumes are rounded to
    6 places one by one)."""
    d = days if day_col == cc.day else days.withColumnRenamed(day_col, cc.day)
    j = d.join(day_curve.drop("supply_year", "supply_month"), [cols.category, cc.day])
    return j.select(
        cols.key, cols.category, cols.quantity, cc.day, "supply_year", "supply_month", "n_hours",
        F.col("day_fraction"),
        (F.col(cols.quantity) * F.col("day_fraction")).cast("decimal(38,6)").alias("day_volume_m3"),
    )
