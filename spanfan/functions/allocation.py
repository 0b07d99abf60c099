"""Exact decimal rules of the hourly allocation, and the same rules in whole numbers.

``quantity(18,3) * fraction(36,8)`` is typed ``decimal(38,6)`` by Spark and
rounded half-up to 6 places, so the volume cast is a no-op. The energy is the
rounded volume times a *double* factor, cast back to ``decimal(38,6)``.

Decimals of that width are BigDecimal objects. ``fixed_point`` gives the same values from longs wherever that
is proven to be exact, row by row:

* the volume in millionths is ``(q * f + half) div 10 ** 5`` of the unscaled quantity (3 places) and
  fraction (8 places), if ``|q * f|`` is at most 9e18 (the bound is tested in double precision, whose error of 2 ** -52
  cannot reach 2 ** 63);
* such a volume is below 2 ** 53 millionths, so its double is the correctly rounded quotient by 10 ** 6, and the product with the
  factor is the double that the decimal rule gets. That rule rounds the decimal string of this double, which is within half a
  unit in the last place of it, and the product with 10 ** 6 adds another half: string and ``t = energy * 10 ** 6`` in doubles
  differ by at most ``t * 2 ** -52``. So rounding to the next whole number agrees unless the fraction of ``t`` is nearer to a tie
  than ``NEAR_TIE * t`` (more than four times that) plus a billionth.

All other rows (overflow, ties, nulls) take the decimal rule. A long becomes a ``decimal(38,6)`` as a
number of microseconds, which Spark casts without arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FRACTION_TYPE, M3_TO_KWH, QUANTITY_TYPE, VOLUME_TYPE

LARGEST_PRODUCT = 9.0e18
LARGEST_ENERGY = 8.0e6
NEAR_TIE = 1e-15


def volume(quantity: Column, fraction: Column) -> Column:
    return (quantity.cast(QUANTITY_TYPE) * fraction.cast(FRACTION_TYPE)).cast(VOLUME_TYPE)


def energy(quantity: Column, fraction: Column, factor: float = M3_TO_KWH) -> Column:
    vol = quantity.cast(QUANTITY_TYPE) * fraction.cast(FRACTION_TYPE)
    return (vol * F.lit(float(factor))).cast(VOLUME_TYPE)


def unscaled_quantity(quantity: Column) -> Column:
    """Thousandths as a long."""
    return (quantity.cast(QUANTITY_TYPE) * F.lit(1000).cast("decimal(4,0)")).cast("long")


def unscaled_fraction(fraction: Column) -> Column:
    """Hundred-millionths as a long; null for a fraction that has no place in one."""
    return (fraction.cast(FRACTION_TYPE).try_cast("decimal(18,8)") * F.lit(10**8).cast("decimal(9,0)")).cast("long")


def narrow_fraction(fraction: Column) -> Column:
    """The fraction as a decimal that Spark keeps in a long; null for one that has no place in it."""
    return fraction.try_cast("decimal(18,8)")


def _millionths(value: Column) -> Column:
    return (F.expr("INTERVAL '0.000001' SECOND") * value).cast(VOLUME_TYPE)


MILLIONTHS, REST, THOUSANDTHS = "_millionths", "_rest", "_thousandths"


def parts(name: str) -> list[str]:
    """The two columns whose sum is the decimal column ``name``: millionths as a long, and the decimal of the rows that have no such long."""
    return [name + MILLIONTHS, name + REST]


def exact_sum(rows: DataFrame, name: str) -> Column:
    """``sum(name)``, a decimal(38,6). Rows that carry its parts are added up as longs in two halves of 32 bits (which cannot
    overflow below 2 ** 31 rows a group), so no decimal object is made for them. The rest is added up under a filter: without
    one, Spark reads and writes the decimal of the running sum for every row, null or not."""
    long, rest = parts(name)
    if long not in rows.columns:
        return F.sum(name)
    whole = lambda c: c.cast("decimal(20,0)")
    high, low = F.sum(F.shiftright(long, 32)), F.sum(F.col(long).bitwiseAND(F.lit(0xFFFFFFFF)))
    quick = ((whole(high) * F.lit(2**32).cast("decimal(10,0)") + whole(low)) * F.lit("0.000001").cast("decimal(6,6)")).cast(VOLUME_TYPE)
    slow = F.expr(f"sum(`{rest}`) FILTER (WHERE `{rest}` IS NOT NULL)")
    return F.when(slow.isNull(), quick).otherwise((slow + F.coalesce(quick, F.lit(0).cast(VOLUME_TYPE))).cast(VOLUME_TYPE))


def exact_max(rows: DataFrame, name: str) -> Column:
    """``max(name)`` of a quantity. Rows that carry its thousandths are compared as longs."""
    if name + THOUSANDTHS not in rows.columns or rows.schema[name].dataType.simpleString() != QUANTITY_TYPE:
        return F.max(name)
    return (F.max(name + THOUSANDTHS).cast("decimal(20,0)") * F.lit("0.001").cast("decimal(3,3)")).cast(QUANTITY_TYPE)


def fixed_point(rows: DataFrame, q: str, f: str, quantity: str, fraction: str, factor: float = M3_TO_KWH,
                names: tuple[str, str] = ("offtake_volume_m3", "offtake_volume_kwh")) -> DataFrame:
    """``rows`` with volume and energy and their ``parts``; ``q`` and ``f`` are the columns of ``unscaled_quantity`` and
    ``unscaled_fraction``, which are best made before the rows are multiplied. They are dropped."""
    product = F.col(q) * F.col(f)
    fits = F.abs(F.col(q).cast("double") * F.col(f).cast("double")) <= LARGEST_PRODUCT
    half = F.when(product < 0, -50_000).otherwise(50_000)
    rows = rows.withColumn("_v", F.when(fits, F.call_function("div", product + half, F.lit(100_000).cast("long"))))
    rows = rows.withColumn("_e", F.col("_v").cast("double") / F.lit(1e6) * F.lit(float(factor)))
    t = F.col("_e") * F.lit(1e6)
    clear = (F.abs("_e") < LARGEST_ENERGY) & (F.abs(t - F.floor(t).cast("double") - F.lit(0.5)) > F.abs(t) * F.lit(NEAR_TIE) + F.lit(1e-9))
    slow = F.col(quantity), F.col(fraction)
    both = F.col("_v").isNotNull()
    rows = rows.withColumns({
        names[0]: F.when(both, _millionths(F.col("_v"))).otherwise(volume(*slow)),
        names[1]: F.when(clear, _millionths(F.floor(t + F.lit(0.5)))).otherwise(energy(*slow, factor)),
        names[0] + MILLIONTHS: F.col("_v"), names[0] + REST: F.when(~both, volume(*slow)),
        names[1] + MILLIONTHS: F.when(clear, F.floor(t + F.lit(0.5))), names[1] + REST: F.when(clear, None).otherwise(energy(*slow, factor)),
    })
    return rows.drop(q, f, "_v", "_e")
