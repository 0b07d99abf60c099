"""Algebra of date spans without expanding days: overlap join, islands, union, measure, gaps.

Bounds are inclusive dates. ``overlap_join`` pairs spans of two tables that share a key and a
day. The others work per (key, category) on the clipped valid ranges.

* The overlap join puts spans on levels of bins. A span belongs to the finest level whose bins are at least as long as it,
  so it touches one or two bins there and on every coarser level. At a level spans of that level
  meet spans of it and of finer ones, by an equi-join on (key, level, bin); a pair is kept in its first common bin
  only, so it appears once. A span that lasts for years is a row or two of a coarse level, and never one per bin.
* Union, measure and gaps first keep, of the ranges of a (key, category) with one start, the longest. That combines map-side
  and leaves at most one row a day of the horizon, however many records a hot key has; a running maximum of the
  ends over these rows, ordered by start, shows where coverage breaks.
* Islands join neighbouring segments with one winner, also over month ends; a (key, category) has at most one segment a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CURVE, HORIZON_DAYS, RANGE, CurveCols, RangeCols
from .latest import latest_segments
from .ranges import CLIP_FROM, CLIP_TO, valid_ranges

LEVEL_FACTOR = 8
# rows (a category and two dates) that may be broadcast
HOLES_BROADCAST_MAX_ROWS = 100_000
# beyond every date of the model
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"


def bin_widths(*spans: tuple[DataFrame, str, str]) -> list[int]:
    """Bin widths in days, finest first: the median length, and ``LEVEL_FACTOR`` times as much up to the longest.
    One aggregate a table; at most seven widths for dates of four digits."""
    median, longest = 1, 1
    for df, lo, hi in spans:
        days = F.datediff(F.col(hi), F.col(lo)) + 1
        row = df.filter(F.col(lo) <= F.col(hi)).agg(F.percentile_approx(days, 0.5), F.max(days)).first()
        median, longest = max(median, row[0] or 1), max(longest, row[1] or 1)
    widths = [median]
    while widths[-1] < longest:
        widths.append(widths[-1] * LEVEL_FACTOR)
    return widths


def _binned(df: DataFrame, lo: str, hi: str, widths: list[int], name: str) -> DataFrame:
    """One row per span, level from its own up, and touched bin, as ``_level, _bin, _own`` and the row as a struct."""
    start, end = F.unix_date(F.col(lo)), F.unix_date(F.col(hi))
    own = F.lit(len(widths) - 1)
    for i in reversed(range(len(widths) - 1)):
        own = F.when(end - start + 1 <= widths[i], i).otherwise(own)

    def bin_of(day: Column, level: Column) -> Column:
        out = F.floor(day / widths[-1])
        for i in reversed(range(len(widths) - 1)):
            out = F.when(level == i, F.floor(day / widths[i])).otherwise(out)
        return out

    levels = F.sequence(own, F.lit(len(widths) - 1))
    rows = df.filter(F.col(lo) <= F.col(hi)).select(F.struct(*df.columns).alias(name), start.alias("_s"), end.alias("_e"), own.alias("_own"),
                                                    F.explode(levels).alias("_level"))
    rows = rows.withColumn("_first", bin_of(F.col("_s"), F.col("_level"))).withColumn("_last", bin_of(F.col("_e"), F.col("_level")))
    return rows.withColumn("_bin", F.explode(F.sequence("_first", "_last")))


def overlap_join(left: DataFrame, right: DataFrame, on: list[str], left_span: tuple[str, str], right_span: tuple[str, str],
                 widths: list[int] | None = None) -> DataFrame:
    """Pairs ``left`` (struct), ``right`` (struct), ``overlap_from``, ``overlap_to`` of rows with equal ``on`` columns
    whose spans share a day. A null key or bound, and an inverted span, meets nothing; repeated rows pair each on their own."""
    widths = widths or bin_widths((left, *left_span), (right, *right_span))
    a = _binned(left, *left_span, widths, "left").select("left", *[F.col(f"left.`{c}`").alias(f"_k{i}") for i, c in enumerate(on)],
                                                       "_level", "_bin", F.col("_own").alias("_oa"), F.col("_first").alias("_fa"),
                                                       F.col("_s").alias("_sa"), F.col("_e").alias("_ea"))
    b = _binned(right, *right_span, widths, "right").select("right", *[F.col(f"right.`{c}`").alias(f"_k{i}") for i, c in enumerate(on)],
                                                          "_level", "_bin", F.col("_own").alias("_ob"), F.col("_first").alias("_fb"),
                                                          F.col("_s").alias("_sb"), F.col("_e").alias("_eb"))
    j = a.join(b, [*[f"_k{i}" for i in range(len(on))], "_level", "_bin"])
    j = j.filter((F.greatest("_oa", "_ob") == F.col("_level")) & (F.col("_bin") == F.greatest("_fa", "_fb")))
    j = j.withColumn("_f", F.greatest("_sa", "_sb")).withColumn("_t", F.least("_ea", "_eb")).filter(F.col("_f") <= F.col("_t"))
    return j.select("left", "right", F.date_from_unix_date("_f").alias("overlap_from"), F.date_from_unix_date("_t").alias("overlap_to"))


def validity_islands(ranges: DataFrame, cols: RangeCols = RANGE, lo=None, hi=None, as_of=None,
                     horizon_days: int | None = HORIZON_DAYS) -> DataFrame:
    """W2b coalesced: ``key, category, payload, valid_from, valid_to``; the longest spans in which one record wins every day."""
    own = [cols.key, cols.category]
    order = Window.partitionBy(*own).orderBy("seg_from")
    winner = F.struct(*cols.payload)
    segs = latest_segments(ranges, cols, lo, hi, as_of, horizon_days)
    new = ~(F.date_add(F.lag("seg_to").over(order), 1).eqNullSafe(F.col("seg_from")) & F.lag(winner).over(order).eqNullSafe(winner))
    segs = segs.withColumn("_new", new.cast("int")).withColumn("_island", F.sum("_new").over(order))
    return segs.groupBy(*own, "_island", *cols.payload).agg(F.min("seg_from").alias("valid_from"), F.max("seg_to").alias("valid_to")).drop("_island")


def _covered(spans: DataFrame, own: list[str], lo: str, hi: str) -> tuple[DataFrame, Column]:
    """Longest span per start, and the last day covered by earlier ones (``_before``)."""
    longest = spans.groupBy(*own, F.col(lo).alias("_from")).agg(F.max(hi).alias("_to"))
    order = Window.partitionBy(*own).orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    return longest.withColumn("_before", F.max("_to").over(order)), F.col("_from") > F.date_add("_before", 1)


def union_spans(spans: DataFrame, own: list[str], lo: str, hi: str) -> DataFrame:
    """The union of the spans per ``own`` columns as disjoint, not touching spans ``span_from, span_to``."""
    rows, gap = _covered(spans, own, lo, hi)
    order = Window.partitionBy(*own).orderBy("_from").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_part", F.sum((F.col("_before").isNull() | gap).cast("int")).over(order))
    return rows.groupBy(*own, "_part").agg(F.min("_from").alias("span_from"), F.max("_to").alias("span_to")).drop("_part")


def inner_gaps(spans: DataFrame, own: list[str], lo: str, hi: str) -> DataFrame:
    """Uncovered spans between the first and the last covered day: ``gap_from, gap_to``."""
    rows, gap = _covered(spans, own, lo, hi)
    return rows.filter(gap).select(*own, F.date_add("_before", 1).alias("gap_from"), F.date_sub("_from", 1).alias("gap_to"))


def curve_gaps(curve: DataFrame, cc: CurveCols = CURVE) -> DataFrame:
    """Per category the spans of days without an hour, before the first and after the last day too."""
    days = curve.select(cc.category, cc.day).filter(F.col(cc.category).isNotNull() & F.col(cc.day).isNotNull())
    inner = inner_gaps(days.select(cc.category, F.col(cc.day).alias("_a"), F.col(cc.day).alias("_b")), [cc.category], "_a", "_b")
    ends = days.groupBy(cc.category).agg(F.min(cc.day).alias("_lo"), F.max(cc.day).alias("_hi"))
    date = lambda d: F.lit(d).cast("date")
    outer = F.array(F.struct(date(FIRST_DAY).alias("gap_from"), F.date_sub("_lo", 1).alias("gap_to")),
                    F.struct(F.date_add("_hi", 1).alias("gap_from"), date(LAST_DAY).alias("gap_to")))
    return inner.unionByName(ends.select(cc.category, F.explode(outer).alias("g")).select(cc.category, "g.*"))


def coverage_gaps(ranges: DataFrame, curve: DataFrame, cols: RangeCols = RANGE, lo=None, hi=None, as_of=None,
                  horizon_days: int | None = HORIZON_DAYS, cc: CurveCols = CURVE) -> DataFrame:
    """J1, days that vanish: ``key, category, gap_from, gap_to, n_days, kind``. ``uncovered``: no range between two
    ranges of a (key, category). ``no_curve``: a range, but no hour of the curve (or no such category in it)."""
    own = [cols.key, cols.category]
    v = valid_ranges(ranges, cols, lo, hi, as_of, horizon_days).filter(F.col(cols.category).isNotNull()).select(*own, CLIP_FROM, CLIP_TO)
    uncovered = inner_gaps(v, own, CLIP_FROM, CLIP_TO).withColumn("kind", F.lit("uncovered"))
    spans = union_spans(v, own, CLIP_FROM, CLIP_TO)
    holes = curve_gaps(curve, cc).withColumnRenamed(cc.category, cols.category)
    if holes.limit(HOLES_BROADCAST_MAX_ROWS + 1).count() <= HOLES_BROADCAST_MAX_ROWS:  # categories are few: not a key to deal by
        meet = (F.col("gap_from") <= F.col("span_to")) & (F.col("gap_to") >= F.col("span_from"))
        missing = spans.join(F.broadcast(holes), cols.category).filter(meet)
        missing = missing.select(*own, F.greatest("gap_from", "span_from").alias("gap_from"), F.least("gap_to", "span_to").alias("gap_to"))
    else:
        pairs = overlap_join(spans, holes, [cols.category], ("span_from", "span_to"), ("gap_from", "gap_to"))
        missing = pairs.select(*[F.col(f"left.`{c}`").alias(c) for c in own], F.col("overlap_from").alias("gap_from"),
                               F.col("overlap_to").alias("gap_to"))
    known = curve.select(F.col(cc.category).alias(cols.category)).distinct()
    foreign = spans.join(known, cols.category, "left_anti").select(*own, F.col("span_from").alias("gap_from"), F.col("span_to").alias("gap_to"))
    no_curve = missing.unionByName(foreign).withColumn("kind", F.lit("no_curve"))
    out = uncovered.unionByName(no_curve)
    return out.select(*own, "gap_from", "gap_to", (F.datediff("gap_to", "gap_from") + 1).alias("n_days"), "kind")


def latest_fanout(ranges: DataFrame, cols: RangeCols = RANGE, lo=None, hi=None, as_of=None,
                  horizon_days: int | None = HORIZON_DAYS) -> DataFrame:
    """A6 after dedup: keys, disjoint spans, and day and hour rows of the history (24 a day), as the measure of the union
    of the ranges of each (key, category). One row."""
    own = [cols.key, cols.category]
    v = valid_ranges(ranges, cols, lo, hi, as_of, horizon_days)
    days = F.datediff("span_to", "span_from") + 1
    per_key = union_spans(v, own, CLIP_FROM, CLIP_TO).groupBy(*own).agg(F.count(F.lit(1)).alias("spans"), F.sum(days).alias("days"))
    n = F.coalesce(F.sum("days"), F.lit(0)).cast("long")
    return per_key.agg(
        F.count(F.lit(1)).alias("n_entity_categories"),
        F.coalesce(F.sum("spans"), F.lit(0)).cast("long").alias("n_spans"),
        n.alias("n_day_rows_latest"),
        (24 * n).alias("n_hour_rows_latest"),
    )
