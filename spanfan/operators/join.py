"""Fan-out joins of day rows or date spans with an hourly curve.

Three strategies give the same rows:

* ``days``   (J1) - spans are exploded to days first; equi-join on
                    (category, day): every day row meets exactly its 24 hours.
* ``range``  (J2) - spans of any length join with ``day BETWEEN from AND to``.
                    They are cut into calendar-month pieces, so the join has the
                    equi-keys (category, year, month) and tests a piece
                    against the hours of one month, not of the whole curve.
* ``months`` (J2b) - as ``range`` for spans that lie inside one month already
                    (segments carry their year and month): nothing is cut.

A curve that is a stored table is broadcast when its planned size, which is that
of its files and needs no job, is within the bound (``broadcast_if_small``);
otherwise the planner decides (sort-merge on the equi-keys, or an AQE broadcast
when the filtered side turns out small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CURVE, CurveCols

STRATEGIES = ("days", "range", "months")
# planned bytes of a stored curve that may be broadcast
CURVE_BROADCAST_MAX_BYTES = 64 << 20
MONTH = ["supply_year", "supply_month"]


def broadcast_if_small(df: DataFrame, max_bytes: int = CURVE_BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint when ``df`` is a projection or filter of a stored table of at
    most ``max_bytes``. Other plans (a Generate multiplies rows that the
    planner does not count) get no hint."""
    plan = df._jdf.queryExecution().optimizedPlan()
    nodes = [line.strip(" +-:").split(" ")[0] for line in plan.toString().splitlines() if line.strip()]
    if not set(nodes) <= {"Project", "Filter", "Relation"}:
        return df
    return F.broadcast(df) if int(str(plan.stats().sizeInBytes())) <= max_bytes else df


def prune_curve(curve: DataFrame, lo=None, hi=None, cc: CurveCols = CURVE) -> DataFrame:
    """Only the columns a fan-out needs, only the days of the window."""
    from ..functions.dates import as_date

    c = curve.select(cc.category, cc.day, cc.hour_start, cc.hour, cc.fraction, *MONTH)
    if lo is not None:
        c = c.filter(F.col(cc.day) >= as_date(lo))
    if hi is not None:
        c = c.filter(F.col(cc.day) <= as_date(hi))
    return c


def join_days(days: DataFrame, curve: DataFrame, category: str, day_col: str = "supply_date",
              cc: CurveCols = CURVE) -> DataFrame:
    """Day rows x curve on (category, day). Year and month stay those of the
    day side (they are functions of the day), and with them its order."""
    d = days
    if category != cc.category:
        d = d.withColumnRenamed(category, cc.category)
    if day_col != cc.day:
        d = d.withColumnRenamed(day_col, cc.day)
    return d.join(curve.drop(*MONTH), [cc.category, cc.day])


def cut_months(spans: DataFrame, span_from: str, span_to: str) -> DataFrame:
    """Spans cut at month ends, with the year and month of each piece."""
    m = F.col("_month")
    first, last = F.trunc(F.col(span_from), "month"), F.trunc(F.col(span_to), "month")
    rest = [c for c in spans.columns if c not in (span_from, span_to, *MONTH)]
    return spans.select(
        *rest, F.col(span_from).alias("_sf"), F.col(span_to).alias("_st"),
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("_month"),
    ).select(
        *rest,
        F.year(m).cast("int").alias("supply_year"),
        F.month(m).cast("int").alias("supply_month"),
        F.greatest(F.col("_sf"), m).alias(span_from),
        F.least(F.col("_st"), F.last_day(m)).alias(span_to),
    )


def join_spans_by_month(spans: DataFrame, curve: DataFrame, category: str, span_from: str, span_to: str,
                        cc: CurveCols = CURVE) -> DataFrame:
    """Spans inside one month x curve on (category, year, month), ``day
    BETWEEN span_from AND span_to``."""
    s = spans if category == cc.category else spans.withColumnRenamed(category, cc.category)
    j = s.join(curve, [cc.category, *MONTH])
    return j.filter(F.col(cc.day).between(F.col(span_from), F.col(span_to))).drop(span_from, span_to)


def join_spans(spans: DataFrame, curve: DataFrame, category: str, span_from: str, span_to: str,
               cc: CurveCols = CURVE) -> DataFrame:
    """Spans of any length x curve on category and ``day BETWEEN span_from
    AND span_to``."""
    return join_spans_by_month(cut_months(spans, span_from, span_to), curve, category, span_from, span_to, cc)
