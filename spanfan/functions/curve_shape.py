"""Shape of a standard hourly load curve (seasonal x diurnal) and the
temperature-corrected variants, as column expressions of an hour column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import FRACTION_TYPE

# --- fixed values of the synthetic gas profile shape ---
SEASONAL_AMPLITUDE = 0.8      # 1 + 0.8 * cos(2*pi*(day_of_year - 15) / 365): winter peak
SEASONAL_PEAK_DAY = 15
YEAR_DAYS = 365.0
MORNING_PEAK_WEIGHT = 0.5     # exp(-(hour - (7 + 0.2*offset))^2 / 6)
MORNING_PEAK_HOUR = 7
MORNING_OFFSET_STEP = 0.2
EVENING_PEAK_WEIGHT = 0.6     # exp(-(hour - 19)^2 / 6)
EVENING_PEAK_HOUR = 19
PEAK_WIDTH = 6.0
MEAN_SHAPE = 1.20             # calibration so one year of fractions sums to about 1
HOURS_PER_YEAR = 8760.0
TEMP_MEAN = 10.5              # 10.5 + 8.5 * sin(2*pi*(day_of_year - 100) / 365) + 3*(noise - 0.5)
TEMP_AMPLITUDE = 8.5
TEMP_PHASE_DAY = 100
TEMP_NOISE_SPAN = 3.0
TOP_FACTOR = 1.08             # profile_fraction_top = fraction * 1.08
RER_THRESHOLD = 15.0          # profile_fraction_rer = fraction * (1 + max(0, 15 - temp) * 0.01)
RER_STEP = 0.01
# --- end of fixed values ---


def seasonal_weight(hour_start: Column) -> Column:
    doy = F.dayofyear(hour_start)
    return F.lit(1.0) + F.lit(SEASONAL_AMPLITUDE) * F.cos(
        F.lit(2 * math.pi) * (doy - F.lit(SEASONAL_PEAK_DAY)) / F.lit(YEAR_DAYS)
    )


def diurnal_weight(hour_start: Column, offset: Column) -> Column:
    h = F.hour(hour_start)
    morning = F.lit(MORNING_PEAK_HOUR) + offset.cast("double") * F.lit(MORNING_OFFSET_STEP)
    return (
        F.lit(1.0)
        + F.lit(MORNING_PEAK_WEIGHT) * F.exp(-F.pow(h - morning, 2) / F.lit(PEAK_WIDTH))
        + F.lit(EVENING_PEAK_WEIGHT) * F.exp(-F.pow(h - F.lit(EVENING_PEAK_HOUR), 2) / F.lit(PEAK_WIDTH))
    )


def shape_fraction(hour_start: Column, offset: Column) -> Column:
    """Share of the annual quantity for one hour (double)."""
    return seasonal_weight(hour_start) * diurnal_weight(hour_start, offset) / F.lit(MEAN_SHAPE * HOURS_PER_YEAR)


def temperature(hour_start: Column, noise: Column | None = None) -> Column:
    """Daily temperature curve; ``noise`` in [0, 1) (e.g. ``rand(seed)``),
    ``None`` for the noise-free curve."""
    doy = F.dayofyear(hour_start)
    t = F.lit(TEMP_MEAN) + F.lit(TEMP_AMPLITUDE) * F.sin(
        F.lit(2 * math.pi) * (doy - F.lit(TEMP_PHASE_DAY)) / F.lit(YEAR_DAYS)
    )
    if noise is not None:
        t = t + (noise - F.lit(0.5)) * F.lit(TEMP_NOISE_SPAN)
    return t


def curve_columns(hour_start: Column, offset: Column, noise: Column | None = None) -> list[Column]:
    """The fraction columns of a profile row (all ``decimal(36,8)``)."""
    frac = shape_fraction(hour_start, offset)
    temp = temperature(hour_start, noise)
    return [
        frac.cast(FRACTION_TYPE).alias("profile_fraction"),
        (frac * F.lit(TOP_FACTOR)).cast(FRACTION_TYPE).alias("profile_fraction_top"),
        (frac * (F.lit(1.0) + F.greatest(F.lit(0.0), F.lit(RER_THRESHOLD) - temp) * F.lit(RER_STEP)))
        .cast(FRACTION_TYPE)
        .alias("profile_fraction_rer"),
        temp.cast(FRACTION_TYPE).alias("realized_temperature"),
    ]
