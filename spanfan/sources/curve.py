"""Hourly curves: calendar spine, synthetic standard profile, curves measured
from event data, and the daily-summed curve.

A curve row is (category, hour start) with a fraction of the annual quantity
for that hour. Curves are small dimensions (categories x hours of the span),
independent of the number of entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CURVE, FRACTION_TYPE, RANGE, CurveCols, RangeCols
from ..functions.curve_shape import curve_columns
from ..functions.dates import day_of_hour, horizon_cap


def calendar_columns(hour_start: Column, zone: str = "UTC", cc: CurveCols = CURVE) -> list[Column]:
    """Year, month, day and hour-of-day of an hour (G4). The day is the
    calendar day in ``zone``; year and month follow that day."""
    day = day_of_hour(hour_start, zone)
    return [
        F.year(day).alias("supply_year"),
        F.month(day).alias("supply_month"),
        day.alias(cc.day),
        F.hour(hour_start).alias(cc.hour),
    ]


def category_spans(ranges: DataFrame, cols: RangeCols = RANGE, as_of=None, horizon_days: int | None = None) -> DataFrame:
    """First and last day per category over a range table: the span a curve
    must cover for these ranges. Open ends reach the horizon when one is set."""
    end = F.col(cols.end).cast("date")
    if horizon_days is not None:
        end = F.coalesce(end, horizon_cap(as_of, horizon_days))
    return (
        ranges.filter(F.col(cols.category).isNotNull() & F.col(cols.start).isNotNull())
        .groupBy(F.col(cols.category).alias("category"))
        .agg(F.min(F.col(cols.start).cast("date")).alias("first_day"), F.max(end).alias("last_day"))
    )


def hour_spine(spans: DataFrame, cc: CurveCols = CURVE, zone: str = "UTC") -> DataFrame:
    """G1: one row per category and hour from ``first_day`` 00:00 to
    ``last_day`` 23:00 (UTC hours), with calendar columns (G4).

    Input: (category, first_day, last_day). Days are exploded first and
    hours second, so no single row fans out to the whole span at once."""
    days = spans.select(
        F.col("category").alias(cc.category),
        F.explode(F.sequence(F.col("first_day"), F.col("last_day"), F.expr("INTERVAL 1 DAY"))).alias("_d"),
    )
    hours = days.select(
        cc.category,
        F.explode(
            F.sequence(
                F.col("_d").cast("timestamp_ntz"),
                F.col("_d").cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS"),
                F.expr("INTERVAL 1 HOUR"),
            )
        ).alias(cc.hour_start),
    )
    return hours.select(cc.category, cc.hour_start, *calendar_columns(F.col(cc.hour_start), zone, cc))


def category_offset(category: Column) -> Column:
    """Default per-category shift of the morning peak (0..4)."""
    return F.pmod(F.xxhash64(category), F.lit(5))


def standard_profile(
    spine: DataFrame,
    offset: Column | None = None,
    noise: Column | None = None,
    cc: CurveCols = CURVE,
) -> DataFrame:
    """G2 + G3: profile fractions on an hour spine.

    ``offset`` shifts the morning peak per category (default from a hash of
    the category); ``noise`` in [0, 1) perturbs the temperature (``None``:
    noise-free, reproducible in any engine)."""
    off = category_offset(F.col(cc.category)) if offset is None else offset
    hs = F.col(cc.hour_start)
    return spine.select(
        cc.category,
        cc.hour_start,
        *curve_columns(hs, off, noise),
        "supply_year",
        "supply_month",
        cc.day,
        cc.hour,
    )


def curve_from_events(
    events: DataFrame,
    category: str = "event_type",
    ts: str = "ts",
    value: str = "value",
    value_type: str = "decimal(18,2)",
    zone: str = "UTC",
    cc: CurveCols = CURVE,
) -> DataFrame:
    """A curve measured from data: per category, the share of the total value
    that falls into each hour of the observed period.

    Values are summed as decimals, so the shares do not depend on the order
    of summation; only hours with events get a row."""
    hourly = (
        events.filter(F.col(category).isNotNull() & F.col(ts).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(category).alias(cc.category), F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz").alias(cc.hour_start))
        .agg(F.sum(F.col(value).cast(value_type)).alias("hour_value"), F.count(F.lit(1)).alias("n_events"))
    )
    totals = hourly.groupBy(cc.category).agg(F.sum("hour_value").alias("total_value"))
    # one row per category; AQE turns this into a broadcast join at run time
    return hourly.join(totals, cc.category).select(
        cc.category,
        cc.hour_start,
        (F.col("hour_value").cast("double") / F.col("total_value").cast("double")).cast(FRACTION_TYPE).alias(cc.fraction),
        "n_events",
        *calendar_columns(F.col(cc.hour_start), zone, cc),
    )


def daily_curve(curve: DataFrame, cc: CurveCols = CURVE) -> DataFrame:
    """Curve summed per category and day (24x fewer rows; 23/25 on local DST
    days). Joining days to it gives daily totals without hourly rows."""
    return curve.groupBy(cc.category, cc.day, "supply_year", "supply_month").agg(
        F.sum(cc.fraction).alias("day_fraction"), F.count(F.lit(1)).alias("n_hours")
    )
