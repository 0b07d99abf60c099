"""Validity ranges: guard, window clipping and expansion to days / months.

A range row is valid on ``[start, end]`` (both inclusive). Before anything is
exploded the rows are classified, so a bad row is reported instead of making
``sequence`` raise:

* ``null_key``   - no entity key
* ``null_start`` - no start date
* ``inverted``   - end before start
* ``outside``    - nothing left after clipping to window and horizon
* ``ok``         - expandable; ``clip_from <= clip_to``

A NULL end means open: it runs to the horizon cap (and window end).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HORIZON_DAYS, RANGE, RangeCols
from ..functions.dates import (
    as_date,
    clipped_end,
    clipped_start,
    day_sequence,
    horizon_cap,
    month_sequence,
)

CLIP_FROM = "clip_from"
CLIP_TO = "clip_to"
STATUS = "range_status"


def _cap(as_of, horizon_days: int | None) -> Column | None:
    return None if horizon_days is None else horizon_cap(as_of, horizon_days)


def classify(
    ranges: DataFrame,
    cols: RangeCols = RANGE,
    lo=None,
    hi=None,
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
) -> DataFrame:
    """Add ``clip_from``, ``clip_to`` and ``range_status`` (see module doc)."""
    cap = _cap(as_of, horizon_days)
    s, e = F.col(cols.start).cast("date"), F.col(cols.end).cast("date")
    cf, ct = clipped_start(cols.start, lo), clipped_end(cols.end, hi, cap)
    status = (
        F.when(F.col(cols.key).isNull(), "null_key")
        .when(s.isNull(), "null_start")
        .when(e.isNotNull() & (e < s), "inverted")
        .when(ct.isNull() | (cf > ct), "outside")
        .otherwise("ok")
    )
    return ranges.withColumn(CLIP_FROM, cf).withColumn(CLIP_TO, ct).withColumn(STATUS, status)


def valid_ranges(ranges: DataFrame, cols: RangeCols = RANGE, lo=None, hi=None, as_of=None,
                 horizon_days: int | None = HORIZON_DAYS) -> DataFrame:
    """Rows that can be expanded, with their clipped bounds.

    The window test is also written as a plain overlap predicate on the raw
    columns, so Parquet can skip row groups by min/max of the dates."""
    df = ranges
    if hi is not None:
        df = df.filter(F.col(cols.start).cast("date") <= as_date(hi))
    if lo is not None:
        df = df.filter(F.col(cols.end).isNull() | (F.col(cols.end).cast("date") >= as_date(lo)))
    return (
        classify(df, cols, lo, hi, as_of, horizon_days)
        .filter(F.col(STATUS) == "ok")
        .drop(STATUS)
    )


def rejected_ranges(ranges: DataFrame, cols: RangeCols = RANGE, lo=None, hi=None, as_of=None,
                    horizon_days: int | None = HORIZON_DAYS) -> DataFrame:
    """Rows that are not expanded, with the reason in ``range_status``."""
    return classify(ranges, cols, lo, hi, as_of, horizon_days).filter(F.col(STATUS) != "ok")


def clipped_days(cols_from: str = CLIP_FROM, cols_to: str = CLIP_TO) -> Column:
    """Number of days of a clipped range (inclusive)."""
    return F.datediff(F.col(cols_to), F.col(cols_from)) + F.lit(1)


def fanout_partitions(df: DataFrame, partitions: int | None = None) -> int:
    """Partitions to spread an expansion over: explicit, else the session's
    ``spark.sql.shuffle.partitions`` (sized by the operator for the cluster)."""
    if partitions:
        return int(partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def month_pieces(
    ranges: DataFrame,
    cols: RangeCols = RANGE,
    lo=None,
    hi=None,
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per touched calendar month of every valid range:
    ``supply_year``, ``supply_month`` and the piece ``piece_from..piece_to``
    of the range inside it. A range of d days yields about d/30 + 1 rows
    instead of d. No shuffle."""
    keep = keep if keep is not None else [cols.key, cols.category, *cols.payload]
    v = valid_ranges(ranges, cols, lo, hi, as_of, horizon_days)
    m = F.col("month")
    return v.select(*keep, CLIP_FROM, CLIP_TO,
                    F.explode(month_sequence(F.col(CLIP_FROM), F.col(CLIP_TO))).alias("month")).select(
        *keep,
        F.year(m).alias("supply_year"),
        F.month(m).alias("supply_month"),
        F.greatest(F.col(CLIP_FROM), m).alias("piece_from"),
        F.least(F.col(CLIP_TO), F.last_day(m)).alias("piece_to"),
    )


def piece_group(cols: RangeCols, n_buckets: int | None) -> list[str]:
    """Columns that say where a piece is dealt: its (key, category, month), or the
    partition of a stored target."""
    return (["key_bucket"] if n_buckets else [cols.key, cols.category]) + ["supply_year", "supply_month"]


def deal_pieces(pieces: DataFrame, cols: RangeCols = RANGE, n_buckets: int | None = None,
                partitions: int | None = None) -> DataFrame:
    """Hash-partition month pieces by (key, category, year, month), or by the
    target layout (``key_bucket`` is added) when ``n_buckets`` is given."""
    if n_buckets:
        pieces = pieces.withColumn("key_bucket", F.pmod(F.xxhash64(F.col(cols.key)), F.lit(n_buckets)).cast("int"))
    return pieces.repartition(fanout_partitions(pieces, partitions), *piece_group(cols, n_buckets))


def expand_pieces(pieces: DataFrame, day_col: str = "supply_date") -> DataFrame:
    """Day rows of month pieces."""
    rest = [c for c in pieces.columns if c not in ("piece_from", "piece_to", "supply_year", "supply_month", "key_bucket")]
    bucket = ["key_bucket"] if "key_bucket" in pieces.columns else []
    return pieces.select(
        *rest, *bucket, "supply_year", "supply_month",
        F.explode(day_sequence(F.col("piece_from"), F.col("piece_to"))).alias(day_col),
    ).select(*rest, day_col, *bucket, "supply_year", "supply_month")


def expand_days(
    ranges: DataFrame,
    cols: RangeCols = RANGE,
    lo=None,
    hi=None,
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    keep: list[str] | None = None,
    day_col: str = "supply_date",
    partitions: int | None = None,
    n_buckets: int | None = None,
) -> DataFrame:
    """One row per day of every valid range.

    Columns: ``keep`` (default key, category, quantity, unit, sequence), the
    day, and its year and month. Only the kept columns enter the Generate.

    A range table is small next to its expansion (hundreds of days per row),
    and few input splits would otherwise explode everything in few tasks.
    Ranges are therefore cut into calendar-month pieces first, and the pieces
    are dealt out evenly, whatever their keys (or by the target layout with
    ``n_buckets``), before the days are generated."""
    pieces = month_pieces(ranges, cols, lo, hi, as_of, horizon_days, keep)
    if n_buckets:
        dealt = deal_pieces(pieces, cols, n_buckets, partitions)
    else:
        dealt = pieces.repartition(fanout_partitions(ranges, partitions))
    return expand_pieces(dealt, day_col)
