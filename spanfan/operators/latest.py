"""Latest-record-wins deduplication at three grains.

* ``per_day``     - every day keeps the latest of *all* records covering it
                    (expand first, then keep one row per key, category, day).
* ``per_record``  - only the single latest record per key and category is
                    kept, then expanded. Right for sources that *append*
                    corrections; on sources whose records cover different
                    periods it drops valid days of older records.
* ``per_segment`` - same result as ``per_day``, computed on elementary
                    segments (pieces between consecutive range boundaries
                    inside a calendar month) instead of single days, so the
                    shuffle moves segments, not days.

"Latest" is the largest sequence value; ties are broken by the remaining
columns, so the winner is repeatable. All three use aggregation
(``max`` of a struct) rather than a window over rows of a key.

``per_day`` and ``per_segment`` first keep, of the month pieces with equal
bounds, the latest record only (``latest_pieces``): no other can win a day of
the piece. A month has at most 496 pieces, so after this aggregate, which
combines map-side, a (key, category, month) is at most 496 rows, however many
records a hot key has. These pieces are dealt by (key, category, month), or by
the target layout, and the rest needs no further shuffle. ``per_record``
combines map-side before its shuffle of range rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import HORIZON_DAYS, RANGE, RangeCols
from .ranges import deal_pieces, expand_days, expand_pieces, month_pieces

POLICIES = ("per_day", "per_record", "per_segment")


def _winner(order_first: str, others: list[str]):
    """``max(struct(seq, others...))``: latest by sequence, then by the other
    columns (repeatable tie-break)."""
    return F.max(F.struct(F.col(order_first).alias("_o"), *[F.col(c) for c in others])).alias("_w")


def latest_pieces(pieces: DataFrame, cols: RangeCols = RANGE) -> DataFrame:
    """Of the month pieces of a (key, category) with equal bounds, the latest."""
    group = [cols.key, cols.category, "supply_year", "supply_month", "piece_from", "piece_to"]
    others = [c for c in pieces.columns if c not in group and c != cols.seq]
    won = pieces.groupBy(*group).agg(_winner(cols.seq, others))
    return won.select(*group, F.col("_w._o").alias(cols.seq), *[F.col(f"_w.{c}").alias(c) for c in others]).select(
        *pieces.columns
    )


def latest_per_day(days: DataFrame, cols: RangeCols = RANGE, day_col: str = "supply_date") -> DataFrame:
    """W1 on an expanded frame: one row per (key, category, day).

    Bucket, year and month (functions of key and day) lead the grouping keys when
    present, so the partitioning of the pieces already satisfies the aggregate
    and its sort order is that of the target's partitions."""
    group = [*[c for c in ("key_bucket", "supply_year", "supply_month") if c in days.columns], cols.key, cols.category,
             day_col]
    others = [c for c in days.columns if c not in group and c != cols.seq]
    agg = days.groupBy(*group).agg(_winner(cols.seq, others))
    return agg.select(*group, F.col("_w._o").alias(cols.seq), *[F.col(f"_w.{c}").alias(c) for c in others]).select(
        *days.columns
    )


def latest_per_record(ranges: DataFrame, cols: RangeCols = RANGE) -> DataFrame:
    """The single latest record per (key, category), before expansion."""
    group = [cols.key, cols.category]
    others = [c for c in ranges.columns if c not in group and c != cols.seq]
    agg = ranges.filter(F.col(cols.key).isNotNull()).groupBy(*group).agg(_winner(cols.seq, others))
    return agg.select(*group, F.col("_w._o").alias(cols.seq), *[F.col(f"_w.{c}").alias(c) for c in others]).select(
        *ranges.columns
    )


def latest_segments(
    ranges: DataFrame,
    cols: RangeCols = RANGE,
    lo=None,
    hi=None,
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    n_buckets: int | None = None,
) -> DataFrame:
    """Winning record per elementary segment.

    The pieces are read and dealt once. The distinct piece boundaries of a
    (key, category, month), at most 32 of at most 496 pieces, are a
    window aggregate over that partitioning; each piece then yields the
    segments it covers, and the latest record per segment wins. Output: key,
    category, payload, year, month, ``seg_from``, ``seg_to`` (and
    ``key_bucket`` with ``n_buckets``)."""
    payload = cols.payload
    pieces = latest_pieces(month_pieces(ranges, cols, lo, hi, as_of, horizon_days), cols)
    bucket = ["key_bucket"] if n_buckets else []
    grp = [*bucket, "supply_year", "supply_month", cols.key, cols.category]
    month = Window.partitionBy(*grp)
    dealt = deal_pieces(pieces, cols, n_buckets).withColumn(
        "bounds",
        F.array_sort(
            F.array_union(
                F.collect_set("piece_from").over(month),
                F.collect_set(F.date_add("piece_to", 1)).over(month),
            )
        ),
    )
    segs = F.arrays_zip(
        F.slice("bounds", 1, F.size("bounds") - 1).alias("s"),
        F.slice("bounds", 2, F.size("bounds") - 1).alias("n"),
    )
    covered = F.filter(segs, lambda z: (z["s"] >= F.col("piece_from")) & (z["s"] <= F.col("piece_to")))
    seg_rows = dealt.select(*grp, *payload, F.explode(covered).alias("_z")).select(
        *grp, *payload, F.col("_z.s").alias("seg_from"), F.date_sub(F.col("_z.n"), 1).alias("seg_to")
    )
    others = [c for c in payload if c != cols.seq]
    won = seg_rows.groupBy(*grp, "seg_from", "seg_to").agg(_winner(cols.seq, others))
    return won.select(
        cols.key, cols.category,
        *[F.col(f"_w.{c}").alias(c) for c in others],
        F.col("_w._o").alias(cols.seq),
        *bucket, "supply_year", "supply_month", "seg_from", "seg_to",
    )


def latest_per_segment(
    ranges: DataFrame,
    cols: RangeCols = RANGE,
    lo=None,
    hi=None,
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    day_col: str = "supply_date",
    n_buckets: int | None = None,
) -> DataFrame:
    """W2b expanded to days: equal to ``latest_per_day(expand_days(...))``."""
    segs = latest_segments(ranges, cols, lo, hi, as_of, horizon_days, n_buckets)
    return expand_pieces(
        segs.withColumnRenamed("seg_from", "piece_from").withColumnRenamed("seg_to", "piece_to"), day_col
    )


def latest_days(
    ranges: DataFrame,
    policy: str = "per_day",
    cols: RangeCols = RANGE,
    lo=None,
    hi=None,
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    n_buckets: int | None = None,
) -> DataFrame:
    """Deduplicated day rows of ``ranges`` under ``policy`` (see module doc).
    With ``n_buckets`` they carry ``key_bucket`` and are dealt by the target layout.

    With ``per_record`` the latest record is chosen among *all* records of
    the key before the window is applied, so loading window by window gives
    the same rows as one load."""
    if policy == "per_day":
        pieces = latest_pieces(month_pieces(ranges, cols, lo, hi, as_of, horizon_days), cols)
        return latest_per_day(expand_pieces(deal_pieces(pieces, cols, n_buckets)), cols)
    if policy == "per_segment":
        return latest_per_segment(ranges, cols, lo, hi, as_of, horizon_days, n_buckets=n_buckets)
    if policy == "per_record":
        return expand_days(latest_per_record(ranges, cols), cols, lo, hi, as_of, horizon_days, n_buckets=n_buckets)
    raise ValueError(f"unknown policy {policy!r}; expected one of {POLICIES}")
