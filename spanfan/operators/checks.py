"""Quality checks and estimates, each one distributed aggregate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CURVE, HORIZON_DAYS, RANGE, RELEVANCE, TARGET_KEY, CurveCols, RangeCols
from ..functions.allocation import exact_max, exact_sum
from ..functions.predicates import relevant
from ..session import work_dir
from .ranges import CLIP_FROM, CLIP_TO, STATUS, classify


def row_counts_by(df: DataFrame, *cols: str) -> DataFrame:
    """A1: rows per group (e.g. per ``supply_year``) in one pass."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_keys(df: DataFrame, key: list[str] = TARGET_KEY) -> DataFrame:
    """A3: key values that occur more than once, with their count. Empty
    means the key is unique."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def duplicate_hours(days: DataFrame, curve: DataFrame, cols: RangeCols = RANGE, cc: CurveCols = CURVE,
                    day_col: str = "supply_date") -> DataFrame:
    """A3 on the fan-out of ``days`` (of ``latest_days``) with ``curve``, without making all hours. An hour occurs more than
    once only if its day does, or if the curve has more than one row of its category and hour. The hours of
    these are made and counted; for unique days and a unique curve there are none. The days are counted where they lie."""
    hour = [cc.category, cc.hour_start]
    c = curve.select(*hour, cc.day)
    twice = c.groupBy(*hour).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*hour)
    d = days.select(F.col(cols.key), F.col(cols.category).alias(cc.category), F.col(day_col).alias(cc.day), "supply_year", "supply_month")
    counted = d.groupBy(cols.key, cc.category, "supply_year", "supply_month", cc.day).agg(F.count(F.lit(1)).alias("n"))
    own = [cols.key, cc.category, cc.day]
    repeated = counted.filter("n > 1").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(*own)
    on = [cc.category, cc.day]
    hours = repeated.join(c.join(twice, hour, "left_anti"), on).unionByName(d.select(*own).join(c.join(twice, hour, "left_semi"), on))
    return duplicate_keys(hours.select(cols.key, F.col(cc.category).alias(cols.category), cc.hour_start), [cols.key, cols.category, cc.hour_start])


def reconcile(hourly: DataFrame, cols: RangeCols = RANGE, tolerance: float = 0.02) -> DataFrame:
    """A4: per entity, category and year: hours, summed volume and energy,
    the volume as a ``share`` of the annual quantity (largest of the year), and a
    verdict: ``partial`` when hours of the year are missing, else ``match`` if
    the share is within ``tolerance`` of 1 and ``mismatch`` if not."""
    g = hourly.groupBy(cols.key, cols.category, "supply_year").agg(
        F.count(F.lit(1)).alias("n_hours"),
        exact_sum(hourly, "offtake_volume_m3").alias("sum_m3"),
        exact_sum(hourly, "offtake_volume_kwh").alias("sum_kwh"),
        exact_max(hourly, cols.quantity).alias("max_quantity"),
    )
    year = F.col("supply_year")
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    share = F.round(F.col("sum_m3").cast("double") / F.col("max_quantity").cast("double"), 6)
    return g.withColumn("year_hours", F.when(leap, 8784).otherwise(8760)).withColumn("share", share).withColumn(
        "verdict",
        F.when(F.col("n_hours") < F.col("year_hours"), "partial")
        .when(F.abs(F.col("share") - 1) <= tolerance, "match")
        .otherwise("mismatch"),
    )


def curve_normalisation(curve: DataFrame, cc: CurveCols = CURVE, tolerance: float = 0.02) -> DataFrame:
    """A5: per category and year the summed fraction and whether it is
    within ``tolerance`` of 1 (complete years only are expected to pass)."""
    return (
        curve.groupBy(cc.category, "supply_year")
        .agg(F.sum(cc.fraction).alias("sum_fraction"), F.count(F.lit(1)).alias("n_hours"))
        .withColumn("within_tolerance", F.abs(F.col("sum_fraction") - F.lit(1)) <= F.lit(tolerance))
    )


def fanout_estimate(
    ranges: DataFrame,
    lo=None,
    hi=None,
    as_of=None,
    horizon_days: int | None = HORIZON_DAYS,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    cols: RangeCols = RANGE,
) -> DataFrame:
    """One pass over the real table: rows, relevant rows, expandable
    rows, day rows before dedup (sum of clipped lengths) and hour rows at 24
    per day, plus the mean clipped length."""
    rel = relevant(relevance) if relevance is not None else F.lit(True)
    c = classify(ranges.withColumn("_rel", rel), cols, lo, hi, as_of, horizon_days)
    ok = F.col("_rel") & (F.col(STATUS) == "ok")
    days = F.when(ok, F.datediff(F.col(CLIP_TO), F.col(CLIP_FROM)) + 1).otherwise(0)
    return c.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.col("_rel"), 1).otherwise(0)).cast("bigint").alias("n_relevant"),
        F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("n_expandable"),
        F.sum(days).cast("bigint").alias("n_day_rows"),
        (F.sum(days).cast("bigint") * F.lit(24)).alias("n_hour_rows"),
        (F.sum(days).cast("double") / F.sum(F.when(ok, 1).otherwise(0)).cast("double")).alias("mean_days"),
    )


def range_status_counts(ranges: DataFrame, cols: RangeCols = RANGE, lo=None, hi=None, as_of=None,
                        horizon_days: int | None = HORIZON_DAYS) -> DataFrame:
    """Guard report: rows and expandable days per range status."""
    c = classify(ranges, cols, lo, hi, as_of, horizon_days)
    days = F.when(F.col(STATUS) == "ok", F.datediff(F.col(CLIP_TO), F.col(CLIP_FROM)) + 1).otherwise(0)
    return c.groupBy(STATUS).agg(F.count(F.lit(1)).alias("n_ranges"), F.sum(days).cast("bigint").alias("n_days"))


def table_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (as a multiset) in one table and not the other, with
    the side they are on. Empty means equal. One signed count per distinct row, so one shuffle; equal rows
    of both sides cancel before it where they meet in a task."""
    cols = [F.col(f"`{c}`") for c in a.columns]
    signed = a.select(*cols, F.lit(1).alias("__net")).unionByName(b.select(*cols, F.lit(-1).alias("__net")))
    net = signed.groupBy(*cols).agg(F.sum("__net").alias("__net")).filter(F.col("__net") != 0)
    # a row that is over n times is repeated in two steps of about sqrt(n), so no array grows with n
    n = F.abs(F.col("__net"))
    step = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    blocks = net.withColumn("__step", step).withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(n / step).cast("long") - 1)))
    size = F.least(F.col("__step"), n - F.col("__block") * F.col("__step"))
    rows = blocks.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), size)))
    return rows.select(*cols, F.when(F.col("__net") > 0, "left").otherwise("right").alias("side"))


def table_fingerprints(df: DataFrame, groups: list[Column]) -> DataFrame:
    """Order-free digest of the rows (a multiset) per group: ``g0, g1, ..., n_rows, sum_hash, xor_hash``. A row that occurs
    twice counts twice. One aggregate with a map-side combine: a row a group and task is shuffled."""
    named = [g.alias(f"g{i}") for i, g in enumerate(groups)]
    first, second = F.xxhash64(*df.columns), F.xxhash64(F.lit(1), *reversed(df.columns))
    rows = df.select(*named, first.alias("_h"), second.alias("_x"))
    return rows.groupBy(*[f"g{i}" for i in range(len(groups))]).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("sum_hash"), F.bit_xor("_x").alias("xor_hash")
    )


# groups that may be broadcast as a filter, about 10 MB
UNEQUAL_BROADCAST_MAX_ROWS = 100_000


def unequal_groups(a: DataFrame, b: DataFrame, groups: list[Column]) -> DataFrame:
    """The groups whose fingerprints differ or that one side does not have."""
    keys = [f"g{i}" for i in range(len(groups))]
    x, y = table_fingerprints(a, groups), table_fingerprints(b.select(*a.columns), groups)
    same = x.intersect(y).select(*keys)
    both = x.select(*keys).unionByName(y.select(*keys)).distinct()
    return both.exceptAll(same)


def table_fingerprint_diff(a: DataFrame, b: DataFrame, groups: list[Column]) -> DataFrame:
    """A7 for tables that are mostly equal: as ``table_difference``, but rows of groups with equal fingerprints (count, sum and
    xor of 64-bit hashes) are not shuffled. Choose groups of a few thousand rows that a change touches few of, such as
    a key's bucket and a month."""
    b = b.select(*a.columns)
    spark, path = a.sparkSession, work_dir(a.sparkSession, "unequal-groups")
    unequal_groups(a, b, groups).write.parquet(path)
    wanted = spark.read.parquet(path)
    if wanted.count() <= UNEQUAL_BROADCAST_MAX_ROWS:
        wanted = F.broadcast(wanted)

    def rest(df: DataFrame) -> DataFrame:
        return df.join(wanted, [g.eqNullSafe(wanted[f"g{i}"]) for i, g in enumerate(groups)], "left_semi")

    return table_difference(rest(a), rest(b))
