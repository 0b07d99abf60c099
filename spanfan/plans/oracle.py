"""Equivalent ANSI SQL (DuckDB dialect) of the workloads in ``workloads``.

The SQL restates each workload from first principles on the raw driver
tables: explode with ``generate_series``, dedup with ``row_number``,
the retracting merge as anti join + union. Column names and types match
the Spark results.
"""

from __future__ import annotations

import math

from ..functions import curve_shape as cs
from .workloads import (
    AS_OF,
    CHANGED_EVERY,
    DOUBLED_MONTH,
    HI,
    HORIZON_NEW,
    LO,
    NEW_KEY_OFFSET,
    NO_HOURS,
    RAISED_DAY,
    SHORT_HORIZON,
    YEAR,
    ZONE,
)

CAP = f"(DATE '{AS_OF}' + INTERVAL 3650 DAY)::DATE"
REL = "commodity_type ILIKE 'gas' AND allocation_method ILIKE 'PRF'"
TWO_PI = repr(2 * math.pi)
NORM = repr(cs.MEAN_SHAPE * cs.HOURS_PER_YEAR)

RANGES_V1 = """
r1 AS (
  SELECT CAST(o_custkey AS VARCHAR) AS point_of_delivery_ean,
         o_orderpriority AS profile_category_code,
         CAST(o_totalprice AS DECIMAL(18,3)) AS sja,
         'm3' AS sj_unit_of_measure,
         CASE WHEN o_orderstatus = 'O' THEN 'GAS' WHEN o_orderstatus = 'F' THEN 'gas' ELSE 'electricity' END
           AS commodity_type,
         'PRF' AS allocation_method,
         CAST(o_orderdate AS DATE) AS effective_from_date,
         CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS DATE) AS effective_to_date,
         TIMESTAMP '2023-01-01 00:00:00' + to_seconds(o_orderkey) AS __record_timestamp,
         o_orderkey, o_custkey
  FROM orders)"""

RANGES_V2 = f"""
r2 AS (
  SELECT point_of_delivery_ean, profile_category_code, sja, sj_unit_of_measure,
         CASE WHEN o_custkey % {CHANGED_EVERY} = 0 AND o_orderkey % 5 = 2 THEN 'electricity' ELSE commodity_type END
           AS commodity_type,
         allocation_method, effective_from_date,
         CASE WHEN o_custkey % {CHANGED_EVERY} = 0 AND o_orderkey % 5 = 0
              THEN CAST(effective_from_date + CAST((o_orderkey % 60) // 2 AS INTEGER) AS DATE)
              ELSE effective_to_date END AS effective_to_date,
         __record_timestamp
  FROM r1 WHERE NOT (o_custkey % {CHANGED_EVERY} = 0 AND o_orderkey % 5 = 1)
  UNION ALL
  SELECT point_of_delivery_ean, profile_category_code, CAST(sja * 2 AS DECIMAL(18,3)), sj_unit_of_measure,
         commodity_type, allocation_method, effective_from_date, effective_to_date,
         __record_timestamp + INTERVAL 365 DAY
  FROM r1 WHERE o_custkey % {CHANGED_EVERY} = 0 AND o_orderkey % 5 = 3
  UNION ALL
  SELECT CAST(o_custkey + {NEW_KEY_OFFSET} AS VARCHAR), profile_category_code, sja, sj_unit_of_measure,
         commodity_type, allocation_method, effective_from_date, effective_to_date,
         __record_timestamp + INTERVAL 730 DAY
  FROM r1 WHERE o_custkey % {CHANGED_EVERY} = {CHANGED_EVERY // 2} AND o_orderkey % 5 = 0)"""

RCOLS = ("point_of_delivery_ean, profile_category_code, sja, sj_unit_of_measure, commodity_type, "
         "allocation_method, effective_from_date, effective_to_date, __record_timestamp")

CURVE = f"""
spans AS (
  SELECT profile_category_code AS cat, min(effective_from_date) AS first_day, max(effective_to_date) AS last_day
  FROM r1 WHERE profile_category_code IS NOT NULL AND effective_from_date IS NOT NULL GROUP BY 1),
spine AS (
  SELECT cat AS profile_category_code,
         unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP) + INTERVAL 23 HOUR,
                                INTERVAL 1 HOUR)) AS supply_start_date_time_utc
  FROM spans),
shape AS (
  SELECT profile_category_code, supply_start_date_time_utc,
         (1.0 + {cs.SEASONAL_AMPLITUDE} * cos({TWO_PI} * (dayofyear(supply_start_date_time_utc) - {cs.SEASONAL_PEAK_DAY}) / {cs.YEAR_DAYS}))
         * (1.0
            + {cs.MORNING_PEAK_WEIGHT} * exp(-pow(hour(supply_start_date_time_utc)
                    - ({cs.MORNING_PEAK_HOUR} + CAST(ascii(profile_category_code) % 5 AS DOUBLE) * {cs.MORNING_OFFSET_STEP}), 2) / {cs.PEAK_WIDTH})
            + {cs.EVENING_PEAK_WEIGHT} * exp(-pow(hour(supply_start_date_time_utc) - {cs.EVENING_PEAK_HOUR}, 2) / {cs.PEAK_WIDTH}))
         / {NORM} AS frac,
         {cs.TEMP_MEAN} + {cs.TEMP_AMPLITUDE} * sin({TWO_PI} * (dayofyear(supply_start_date_time_utc) - {cs.TEMP_PHASE_DAY}) / {cs.YEAR_DAYS}) AS temp
  FROM spine),
curve AS (
  SELECT profile_category_code, supply_start_date_time_utc,
         CAST(frac AS DECIMAL(36,8)) AS profile_fraction,
         CAST(frac * {cs.TOP_FACTOR} AS DECIMAL(36,8)) AS profile_fraction_top,
         CAST(frac * (1.0 + greatest(0.0, {cs.RER_THRESHOLD} - temp) * {cs.RER_STEP}) AS DECIMAL(36,8)) AS profile_fraction_rer,
         CAST(temp AS DECIMAL(36,8)) AS realized_temperature,
         CAST(year(supply_start_date_time_utc) AS INTEGER) AS supply_year,
         CAST(month(supply_start_date_time_utc) AS INTEGER) AS supply_month,
         CAST(supply_start_date_time_utc AS DATE) AS supply_date,
         CAST(hour(supply_start_date_time_utc) AS INTEGER) AS supply_hour
  FROM shape)"""


CHANGED_CURVE = f"""
curve2 AS (
  SELECT * REPLACE (CAST(CASE
           WHEN ascii(profile_category_code) % 2 = 1 AND supply_year = {DOUBLED_MONTH[0]} AND supply_month = {DOUBLED_MONTH[1]}
             THEN profile_fraction * 2
           WHEN ascii(profile_category_code) % 2 = 0 AND supply_date = DATE '{RAISED_DAY}' THEN profile_fraction + 0.00000100
           ELSE profile_fraction END AS DECIMAL(36,8)) AS profile_fraction)
  FROM curve WHERE supply_date NOT BETWEEN DATE '{NO_HOURS[0]}' AND DATE '{NO_HOURS[1]}')"""


def _days(src: str, name: str, lo: str | None = None, hi: str | None = None) -> str:
    """Relevant, valid ranges of ``src`` exploded to (clipped) days."""
    lo_e = f"greatest(effective_from_date, DATE '{lo}')" if lo else "effective_from_date"
    hi_parts = ["effective_to_date", CAP] + ([f"DATE '{hi}'"] if hi else [])
    hi_e = f"least({', '.join(hi_parts)})"
    return f"""
{name} AS (
  SELECT point_of_delivery_ean, profile_category_code, sja, sj_unit_of_measure, __record_timestamp,
         CAST(unnest(generate_series(CAST(cf AS TIMESTAMP), CAST(ct AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS supply_date
  FROM (SELECT *, {lo_e} AS cf, {hi_e} AS ct FROM {src}
        WHERE {REL} AND point_of_delivery_ean IS NOT NULL AND effective_from_date IS NOT NULL
          AND (effective_to_date IS NULL OR effective_to_date >= effective_from_date)) x
  WHERE cf <= ct)"""


def _dedup_day(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * FROM {src}
  QUALIFY row_number() OVER (PARTITION BY point_of_delivery_ean, profile_category_code, supply_date
                             ORDER BY __record_timestamp DESC, sja DESC, sj_unit_of_measure DESC) = 1)"""


def _latest_record(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * FROM {src} WHERE {REL} AND point_of_delivery_ean IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY point_of_delivery_ean, profile_category_code
                             ORDER BY __record_timestamp DESC, sja DESC, sj_unit_of_measure DESC,
                                      commodity_type DESC, allocation_method DESC,
                                      effective_from_date DESC, effective_to_date DESC) = 1)"""


DAY_COLS = ("point_of_delivery_ean, profile_category_code, sja, sj_unit_of_measure, __record_timestamp, supply_date, "
            "CAST(year(supply_date) AS INTEGER) AS supply_year, CAST(month(supply_date) AS INTEGER) AS supply_month")


def _hourly(days: str, curve: str = "curve") -> str:
    """Target columns of ``days`` joined to ``curve`` on (category, day).

    Energy goes double -> VARCHAR -> decimal: Spark casts a double to a
    decimal through its shortest decimal string and rounds that half-up,
    which decides ties such as 62.6095 * 9.769 = 611.6322055."""
    return f"""
SELECT d.point_of_delivery_ean, d.profile_category_code, d.sja, d.sj_unit_of_measure,
       c.supply_start_date_time_utc,
       c.supply_start_date_time_utc + INTERVAL 1 HOUR AS supply_end_date_time_utc,
       c.supply_hour, c.profile_fraction,
       CAST(d.sja * c.profile_fraction AS DECIMAL(38,6)) AS offtake_volume_m3,
       CAST(CAST(CAST(CAST(d.sja * c.profile_fraction AS DECIMAL(38,6)) AS DOUBLE) * 9.769 AS VARCHAR) AS DECIMAL(38,6)) AS offtake_volume_kwh,
       c.supply_year, c.supply_month, d.__record_timestamp
FROM {days} d JOIN {curve} c
  ON d.profile_category_code = c.profile_category_code AND d.supply_date = c.supply_date"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


HOURLY_V1 = _with(RANGES_V1, CURVE, _days("r1", "d0"), _dedup_day("d0", "d1")) + ",\nh AS (" + _hourly("d1") + ")"
HOURLY_V2 = (
    _with(RANGES_V1, RANGES_V2, CURVE, _days("r2", "d0"), _dedup_day("d0", "d1")) + ",\nh AS (" + _hourly("d1") + ")"
)
BY_ENTITY_YEAR = """
SELECT point_of_delivery_ean, profile_category_code, supply_year, count(*) AS n_hours,
       sum(offtake_volume_m3) AS sum_m3, sum(offtake_volume_kwh) AS sum_kwh
FROM h GROUP BY 1, 2, 3"""

DIFF = f"""
added AS (SELECT {RCOLS} FROM r2 EXCEPT ALL SELECT {RCOLS} FROM r1),
removed AS (SELECT {RCOLS} FROM r1 EXCEPT ALL SELECT {RCOLS} FROM r2),
both_k AS (SELECT point_of_delivery_ean FROM added INTERSECT SELECT point_of_delivery_ean FROM removed),
diff AS (
  SELECT a.*, CASE WHEN a.point_of_delivery_ean IN (SELECT point_of_delivery_ean FROM both_k)
                   THEN 'update_postimage' ELSE 'insert' END AS _change_type
  FROM added a
  UNION ALL
  SELECT r.*, CASE WHEN r.point_of_delivery_ean IN (SELECT point_of_delivery_ean FROM both_k)
                   THEN 'update_preimage' ELSE 'delete' END
  FROM removed r),
keys AS (SELECT DISTINCT point_of_delivery_ean FROM diff WHERE {REL} AND point_of_delivery_ean IS NOT NULL)"""

# v1 history (h1) and the rebuild of changed keys from v2 (hn)
MERGE_INPUTS = (
    _with(RANGES_V1, RANGES_V2, CURVE, DIFF,
          _days("r1", "a0"), _dedup_day("a0", "a1"),
          _days("(SELECT * FROM r2 WHERE point_of_delivery_ean IN (SELECT point_of_delivery_ean FROM keys))", "b0"),
          _dedup_day("b0", "b1"))
    + ",\nh1 AS (" + _hourly("a1") + "),\nhn AS (" + _hourly("b1") + ")"
)
TKEY = "point_of_delivery_ean, profile_category_code, supply_start_date_time_utc"
VALUE_COLS = ["sja", "sj_unit_of_measure", "supply_end_date_time_utc", "supply_hour", "profile_fraction",
              "offtake_volume_m3", "offtake_volume_kwh", "supply_year", "supply_month", "__record_timestamp"]

EVENTS_LOCAL = f"""
WITH er AS (
  SELECT CAST(user_id AS VARCHAR) AS point_of_delivery_ean, event_type AS profile_category_code,
         CAST(value AS DECIMAL(18,3)) AS sja, 'm3' AS sj_unit_of_measure, 'gas' AS commodity_type,
         'PRF' AS allocation_method, CAST(ts AS DATE) AS effective_from_date,
         CAST(CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER) AS DATE) AS effective_to_date,
         ts AS __record_timestamp
  FROM events),
eh AS (
  SELECT event_type AS profile_category_code, date_trunc('hour', ts) AS supply_start_date_time_utc,
         sum(CAST(value AS DECIMAL(18,2))) AS hour_value, count(*) AS n_events
  FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2),
et AS (SELECT profile_category_code, sum(hour_value) AS total_value FROM eh GROUP BY 1),
curve AS (
  SELECT eh.profile_category_code, supply_start_date_time_utc,
         CAST(CAST(hour_value AS DOUBLE) / CAST(total_value AS DOUBLE) AS DECIMAL(36,8)) AS profile_fraction,
         n_events,
         CAST(year(ld) AS INTEGER) AS supply_year, CAST(month(ld) AS INTEGER) AS supply_month,
         ld AS supply_date, CAST(hour(supply_start_date_time_utc) AS INTEGER) AS supply_hour
  FROM (SELECT *, CAST(timezone('{ZONE}', timezone('UTC', supply_start_date_time_utc)) AS DATE) AS ld FROM eh) eh
  JOIN et ON eh.profile_category_code = et.profile_category_code),"""


def _merge_actions_sql() -> str:
    same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in VALUE_COLS)
    return MERGE_INPUTS + f""",
old AS (SELECT * FROM h1 WHERE point_of_delivery_ean IN (SELECT point_of_delivery_ean FROM keys)),
acts AS (
  SELECT coalesce(o.point_of_delivery_ean, n.point_of_delivery_ean) AS point_of_delivery_ean,
         CASE WHEN o.point_of_delivery_ean IS NULL THEN 'insert'
              WHEN n.point_of_delivery_ean IS NULL THEN 'delete'
              WHEN {same} THEN 'unchanged' ELSE 'update' END AS a
  FROM old o FULL OUTER JOIN hn n
    ON o.point_of_delivery_ean = n.point_of_delivery_ean AND o.profile_category_code = n.profile_category_code
   AND o.supply_start_date_time_utc = n.supply_start_date_time_utc)
SELECT point_of_delivery_ean,
       CAST(sum(CASE WHEN a = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS n_insert,
       CAST(sum(CASE WHEN a = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS n_update,
       CAST(sum(CASE WHEN a = 'delete' THEN 1 ELSE 0 END) AS BIGINT) AS n_delete,
       CAST(sum(CASE WHEN a = 'unchanged' THEN 1 ELSE 0 END) AS BIGINT) AS n_unchanged
FROM acts GROUP BY 1"""


def _seg_days() -> str:
    return _with(RANGES_V1, _days("r1", "d0"), _dedup_day("d0", "d1")) + f"\nSELECT {DAY_COLS} FROM d1"


WEIGHTED_PICK = """
SELECT c_custkey,
       CASE WHEN u < 0.6 THEN 'low' WHEN u < 0.85 THEN 'mid' ELSE 'high' END AS category
FROM (SELECT c_custkey, CAST((c_custkey * 7919) % 1000 AS DOUBLE) / 1000.0 AS u FROM customer)"""
BUCKETED_LENGTH = """
SELECT c_custkey,
       CAST(CASE WHEN b < 0.5 THEN 1 + floor(w * 29) WHEN b < 0.8 THEN 30 + floor(w * 170)
                 ELSE 200 + floor(w * 1300) END AS INTEGER) AS range_days
FROM (SELECT c_custkey, CAST((c_custkey * 7919) % 1000 AS DOUBLE) / 1000.0 AS b,
             CAST((c_custkey * 104729) % 997 AS DOUBLE) / 997.0 AS w FROM customer)"""
BY_MONTH = """
SELECT supply_year, supply_month, count(*) AS n_hours, sum(offtake_volume_m3) AS sum_m3,
       sum(offtake_volume_kwh) AS sum_kwh
FROM h GROUP BY 1, 2"""


SQL: dict[str, str] = {
    "range_explode_days": _with(RANGES_V1, _days("r1", "d0")) + f"\nSELECT {DAY_COLS} FROM d0",
    "range_clip_window": _with(RANGES_V1) + f"""
SELECT point_of_delivery_ean, profile_category_code, effective_from_date, effective_to_date, __record_timestamp,
       clip_from, clip_to, CAST(date_diff('day', clip_from, clip_to) + 1 AS INTEGER) AS n_days
FROM (SELECT *, greatest(effective_from_date, DATE '{LO}') AS clip_from,
             least(effective_to_date, {CAP}, DATE '{HI}') AS clip_to
      FROM r1 WHERE {REL} AND point_of_delivery_ean IS NOT NULL AND effective_from_date IS NOT NULL
        AND effective_from_date <= DATE '{HI}' AND (effective_to_date IS NULL OR effective_to_date >= DATE '{LO}')
        AND (effective_to_date IS NULL OR effective_to_date >= effective_from_date)) x
WHERE clip_from <= clip_to""",
    "inverted_range_guard": f"""
WITH lr AS (
  SELECT CAST(o_custkey AS VARCHAR) AS k, CAST(o_orderdate AS DATE) AS s, CAST(l_shipdate AS DATE) AS e
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
st AS (
  SELECT *, least(e, {CAP}) AS ct,
         CASE WHEN k IS NULL THEN 'null_key' WHEN s IS NULL THEN 'null_start'
              WHEN e IS NOT NULL AND e < s THEN 'inverted'
              WHEN least(e, {CAP}) IS NULL OR s > least(e, {CAP}) THEN 'outside' ELSE 'ok' END AS range_status
  FROM lr)
SELECT range_status, count(*) AS n_ranges,
       CAST(sum(CASE WHEN range_status = 'ok' THEN date_diff('day', s, ct) + 1 ELSE 0 END) AS BIGINT) AS n_days
FROM st GROUP BY 1""",
    "latest_per_day": _seg_days(),
    "latest_per_segment": _seg_days(),
    "latest_per_record": _with(RANGES_V1, _latest_record("r1", "lr"), _days("lr", "d0")) + f"\nSELECT {DAY_COLS} FROM d0",
    "curve_spine": _with(RANGES_V1, CURVE) + """
SELECT profile_category_code, supply_start_date_time_utc, supply_year, supply_month, supply_date, supply_hour FROM curve""",
    "seasonal_curve": _with(RANGES_V1, CURVE) + "\nSELECT * FROM curve",
    "curve_normalised": _with(RANGES_V1, CURVE) + """
SELECT profile_category_code, supply_year, sum(profile_fraction) AS sum_fraction, count(*) AS n_hours,
       abs(sum(profile_fraction) - 1) <= 0.02 AS within_tolerance
FROM curve GROUP BY 1, 2""",
    "curve_from_events": """
WITH eh AS (
  SELECT event_type AS profile_category_code, date_trunc('hour', ts) AS supply_start_date_time_utc,
         sum(CAST(value AS DECIMAL(18,2))) AS hour_value, count(*) AS n_events
  FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2),
et AS (SELECT profile_category_code, sum(hour_value) AS total_value FROM eh GROUP BY 1)
SELECT eh.profile_category_code, supply_start_date_time_utc,
       CAST(CAST(hour_value AS DOUBLE) / CAST(total_value AS DOUBLE) AS DECIMAL(36,8)) AS profile_fraction,
       n_events,
       CAST(year(supply_start_date_time_utc) AS INTEGER) AS supply_year,
       CAST(month(supply_start_date_time_utc) AS INTEGER) AS supply_month,
       CAST(supply_start_date_time_utc AS DATE) AS supply_date,
       CAST(hour(supply_start_date_time_utc) AS INTEGER) AS supply_hour
FROM eh JOIN et ON eh.profile_category_code = et.profile_category_code""",
    "allocate_local_day": EVENTS_LOCAL[:-1] + "," + _days("er", "d0")[1:] + "," + _dedup_day("d0", "d1")[1:]
    + "\n" + _hourly("d1"),
    "allocate_daily_total": _with(RANGES_V1, CURVE, _days("r1", "d0"), _dedup_day("d0", "d1")) + """,
dc AS (SELECT profile_category_code, supply_date, supply_year, supply_month,
              sum(profile_fraction) AS day_fraction, count(*) AS n_hours
       FROM curve GROUP BY 1, 2, 3, 4)
SELECT d.point_of_delivery_ean, d.profile_category_code, d.sja, d.supply_date, c.supply_year, c.supply_month,
       c.n_hours, c.day_fraction, CAST(d.sja * c.day_fraction AS DECIMAL(38,6)) AS day_volume_m3
FROM d1 d JOIN dc c ON d.profile_category_code = c.profile_category_code AND d.supply_date = c.supply_date""",
    "reconcile_entity_year": HOURLY_V1 + """
SELECT point_of_delivery_ean, profile_category_code, supply_year, n_hours,
       sum_m3, sum_kwh, max_quantity, year_hours, share,
       CASE WHEN n_hours < year_hours THEN 'partial' WHEN abs(share - 1) <= 0.02 THEN 'match' ELSE 'mismatch' END AS verdict
FROM (SELECT *, round(CAST(sum_m3 AS DOUBLE) / CAST(max_quantity AS DOUBLE), 6) AS share,
             CASE WHEN (supply_year % 4 = 0 AND supply_year % 100 <> 0) OR supply_year % 400 = 0 THEN 8784 ELSE 8760 END AS year_hours
      FROM (SELECT point_of_delivery_ean, profile_category_code, supply_year, count(*) AS n_hours,
                   sum(offtake_volume_m3) AS sum_m3, sum(offtake_volume_kwh) AS sum_kwh, max(sja) AS max_quantity
            FROM h GROUP BY 1, 2, 3))""",
    "year_row_counts": HOURLY_V1 + "\nSELECT supply_year, count(*) AS n_rows FROM h GROUP BY 1",
    "target_duplicate_keys": HOURLY_V1 + f"\nSELECT {TKEY}, count(*) AS n_rows FROM h GROUP BY {TKEY} HAVING count(*) > 1",
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "fanout_estimate": _with(RANGES_V1) + f"""
, c AS (
  SELECT ({REL}) AS rel,
         CASE WHEN point_of_delivery_ean IS NULL THEN 'null_key' WHEN effective_from_date IS NULL THEN 'null_start'
              WHEN effective_to_date IS NOT NULL AND effective_to_date < effective_from_date THEN 'inverted'
              WHEN least(effective_to_date, {CAP}) IS NULL OR effective_from_date > least(effective_to_date, {CAP}) THEN 'outside'
              ELSE 'ok' END AS st,
         date_diff('day', effective_from_date, least(effective_to_date, {CAP})) + 1 AS nd
  FROM r1)
SELECT count(*) AS n_rows,
       CAST(sum(CASE WHEN rel THEN 1 ELSE 0 END) AS BIGINT) AS n_relevant,
       CAST(sum(CASE WHEN rel AND st = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS n_expandable,
       CAST(sum(CASE WHEN rel AND st = 'ok' THEN nd ELSE 0 END) AS BIGINT) AS n_day_rows,
       CAST(sum(CASE WHEN rel AND st = 'ok' THEN nd ELSE 0 END) AS BIGINT) * 24 AS n_hour_rows,
       CAST(sum(CASE WHEN rel AND st = 'ok' THEN nd ELSE 0 END) AS DOUBLE)
         / CAST(sum(CASE WHEN rel AND st = 'ok' THEN 1 ELSE 0 END) AS DOUBLE) AS mean_days
FROM c""",
    "snapshot_diff": _with(RANGES_V1, RANGES_V2, DIFF) + """
SELECT *, CAST(2 AS BIGINT) AS _commit_version, TIMESTAMP '2000-01-03 00:00:00' AS _commit_timestamp FROM diff""",
    "snapshot_as_of": _with(RANGES_V1, RANGES_V2) + f"\nSELECT {RCOLS} FROM r2",
    "latest_version": _with(RANGES_V1, RANGES_V2, DIFF) + """,
log AS (SELECT CAST(1 AS BIGINT) AS version FROM r1 UNION ALL SELECT CAST(2 AS BIGINT) FROM diff)
SELECT max(version) AS latest_version FROM log""",
    "changed_keys": _with(RANGES_V1, RANGES_V2, DIFF) + "\nSELECT point_of_delivery_ean FROM keys",
    "rebuild_changed": MERGE_INPUTS + "\nSELECT * FROM hn",
    "retracting_merge": HOURLY_V2 + BY_ENTITY_YEAR,
    "merge_actions": _merge_actions_sql(),
    "retracted_rows": MERGE_INPUTS + f"""
SELECT o.* FROM h1 o
WHERE o.point_of_delivery_ean IN (SELECT point_of_delivery_ean FROM keys)
  AND NOT EXISTS (SELECT 1 FROM hn n WHERE n.point_of_delivery_ean = o.point_of_delivery_ean
                  AND n.profile_category_code = o.profile_category_code
                  AND n.supply_start_date_time_utc = o.supply_start_date_time_utc)""",
    "table_difference": _with(RANGES_V1, RANGES_V2) + f"""
SELECT *, 'left' AS side FROM (SELECT {RCOLS} FROM r1 EXCEPT ALL SELECT {RCOLS} FROM r2)
UNION ALL
SELECT *, 'right' AS side FROM (SELECT {RCOLS} FROM r2 EXCEPT ALL SELECT {RCOLS} FROM r1)""",
    "history_load_years": HOURLY_V1 + BY_MONTH,
    "history_load_windows": HOURLY_V1 + BY_MONTH,
    "stored_year_rows": HOURLY_V1 + f"""
SELECT supply_year, supply_month, count(*) AS n_rows FROM h WHERE supply_year = {YEAR} GROUP BY 1, 2""",
    "increment_equals_rebuild": HOURLY_V2 + BY_ENTITY_YEAR,
    "stream_late_commit": HOURLY_V2 + BY_ENTITY_YEAR,
    "stream_increment": HOURLY_V2 + BY_ENTITY_YEAR,
    "reload_equals_history": HOURLY_V2 + BY_ENTITY_YEAR,
    "weighted_pick": WEIGHTED_PICK,
    "bucketed_length": BUCKETED_LENGTH,
}


def _last_day_of_new_horizon() -> str:
    import datetime as dt

    return (dt.date.fromisoformat(HORIZON_NEW) + dt.timedelta(days=SHORT_HORIZON)).isoformat()


# spans of days of a (key, category, winner or kind) that follow each other
def _runs(src: str, extra: str) -> str:
    cols = "point_of_delivery_ean, profile_category_code" + extra
    return f"""
SELECT {cols}, min(supply_date) AS a, max(supply_date) AS b
FROM (SELECT *, supply_date - CAST(row_number() OVER (PARTITION BY {cols} ORDER BY supply_date) AS INTEGER) AS island FROM {src})
GROUP BY {cols}, island"""


SQL |= {
    "increment_delta": HOURLY_V2 + BY_ENTITY_YEAR,
    "increment_folded": HOURLY_V2 + BY_ENTITY_YEAR,
    "stream_delta": HOURLY_V2 + BY_ENTITY_YEAR,
    "reload_with_seam": HOURLY_V2 + BY_ENTITY_YEAR,
    "merge_bucketed": HOURLY_V2 + BY_ENTITY_YEAR,
    "reconcile_bucketed": SQL["reconcile_entity_year"],
    "snapshot_from_base": SQL["snapshot_as_of"],
    "table_fingerprint_diff": SQL["table_difference"],
    "curve_change_increment": _with(RANGES_V1, CURVE, CHANGED_CURVE, _days("r1", "d0", hi=_last_day_of_new_horizon()),
                                    _dedup_day("d0", "d1"))
    + ",\nh AS (" + _hourly("d1", "curve2") + ")" + BY_ENTITY_YEAR,
    "range_overlap": """
WITH a AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS point_of_delivery_ean, CAST(o_orderdate AS DATE) AS s,
                  CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS DATE) AS e FROM orders),
b AS (SELECT l_orderkey, l_linenumber, CAST(o_custkey AS VARCHAR) AS point_of_delivery_ean, CAST(o_orderdate AS DATE) AS s,
             CAST(l_shipdate AS DATE) AS e
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE))
SELECT point_of_delivery_ean, o_orderkey, l_orderkey, l_linenumber, greatest(a.s, b.s) AS overlap_from, least(a.e, b.e) AS overlap_to
FROM a JOIN b USING (point_of_delivery_ean) WHERE a.s <= b.e AND b.s <= a.e""",
    "validity_islands": _with(RANGES_V1, _days("r1", "d0"), _dedup_day("d0", "d1"))
    + "\nSELECT * RENAME (a AS valid_from, b AS valid_to) FROM (" + _runs("d1", ", sja, sj_unit_of_measure, __record_timestamp") + ")",
    "coverage_gaps": _with(RANGES_V1, CURVE, CHANGED_CURVE, _days("r1", "d0")) + f""",
d AS (SELECT DISTINCT point_of_delivery_ean, profile_category_code, supply_date FROM d0 WHERE profile_category_code IS NOT NULL),
u AS ({_runs("d", "")}),
g AS (SELECT point_of_delivery_ean, profile_category_code, CAST(b + 1 AS DATE) AS gap_from,
             CAST(lead(a) OVER (PARTITION BY point_of_delivery_ean, profile_category_code ORDER BY a) - 1 AS DATE) AS gap_to FROM u),
m AS (SELECT * FROM d WHERE (profile_category_code, supply_date) NOT IN (SELECT profile_category_code, supply_date FROM curve2))
SELECT *, CAST(gap_to - gap_from + 1 AS INTEGER) AS n_days, 'uncovered' AS kind FROM g WHERE gap_to IS NOT NULL
UNION ALL
SELECT point_of_delivery_ean, profile_category_code, a, b, CAST(b - a + 1 AS INTEGER), 'no_curve' FROM ({_runs("m", "")})""",
    "entity_codes": "SELECT c_custkey, '871' || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS point_of_delivery_ean FROM customer",
    "fanout_after_dedup": _with(RANGES_V1, _days("r1", "d0"), _dedup_day("d0", "d1")) + f""",
u AS ({_runs("d1", "")})
SELECT (SELECT count(*) FROM (SELECT DISTINCT point_of_delivery_ean, profile_category_code FROM d1)) AS n_entity_categories,
       (SELECT count(*) FROM u) AS n_spans, (SELECT count(*) FROM d1) AS n_day_rows_latest,
       (SELECT count(*) FROM d1) * 24 AS n_hour_rows_latest""",
}


def _allocate_year() -> str:
    return (_with(RANGES_V1, CURVE, _days("r1", "d0", LO, HI), _dedup_day("d0", "d1")) + _hourly("d1"))


for _name in ("allocate_year_equi", "allocate_year_range", "allocate_year_bucketed"):
    SQL[_name] = _allocate_year()
