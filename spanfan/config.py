"""Column names and fixed constants of the data model.

The range table, the hourly curve and the hourly target keep the column names
of the data model they come from, so a user can point the library at existing
tables without renaming. Every operator takes a ``RangeCols`` / ``CurveCols``
so other layouts work too.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must stay equal to the modelled pipeline for equal results) ---
# energy factor m3 -> kWh, applied in double precision to the rounded volume
M3_TO_KWH = 9.769
# forward horizon for open-ended ranges: 10 years of 365 days
HORIZON_DAYS = 10 * 365
# column types of the target table
QUANTITY_TYPE = "decimal(18,3)"
FRACTION_TYPE = "decimal(36,8)"
VOLUME_TYPE = "decimal(38,6)"
# relevance filter of the range table: case-insensitive equality, all must hold
RELEVANCE = (("commodity_type", "gas"), ("allocation_method", "PRF"))
# --- end of fixed values ---

# number of hash buckets of the entity key in the target layout (merge scope)
DEFAULT_KEY_BUCKETS = 64


@dataclass(frozen=True)
class RangeCols:
    """Columns of a range table: one row = entity + attributes valid on
    ``[start, end]``, both ends inclusive."""

    key: str = "point_of_delivery_ean"
    category: str = "profile_category_code"
    quantity: str = "sja"
    unit: str = "sj_unit_of_measure"
    start: str = "effective_from_date"
    end: str = "effective_to_date"
    seq: str = "__record_timestamp"
    extra: tuple[str, ...] = ()  # further columns, which must be functions of the others

    @property
    def payload(self) -> list[str]:
        """Columns carried from a record onto its days / hours."""
        return [self.quantity, self.unit, self.seq, *self.extra]


@dataclass(frozen=True)
class CurveCols:
    """Columns of an hourly curve: one row = category x hour."""

    category: str = "profile_category_code"
    hour_start: str = "supply_start_date_time_utc"
    fraction: str = "profile_fraction"
    hour: str = "supply_hour"
    day: str = "supply_date"


RANGE = RangeCols()
CURVE = CurveCols()

# columns and fixed types of the hourly target, in table order
TARGET_TYPES = (
    ("point_of_delivery_ean", "STRING"),
    ("profile_category_code", "STRING"),
    ("sja", QUANTITY_TYPE),
    ("sj_unit_of_measure", "STRING"),
    ("supply_start_date_time_utc", "TIMESTAMP_NTZ"),
    ("supply_end_date_time_utc", "TIMESTAMP_NTZ"),
    ("supply_hour", "INT"),
    ("profile_fraction", FRACTION_TYPE),
    ("offtake_volume_m3", VOLUME_TYPE),
    ("offtake_volume_kwh", VOLUME_TYPE),
    ("supply_year", "INT"),
    ("supply_month", "INT"),
    ("__record_timestamp", "TIMESTAMP_NTZ"),
)
TARGET_COLUMNS = [name for name, _ in TARGET_TYPES]
TARGET_KEY = ["point_of_delivery_ean", "profile_category_code", "supply_start_date_time_utc"]
