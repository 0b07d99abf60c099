"""Input tables: Parquet readers and the mapping of the driver's tables onto
the range-table model.

The range model: key, category, quantity ``decimal(18,3)``, unit, relevance
columns, inclusive ``[start, end]`` dates and a sequence timestamp.

``orders`` as ranges (the stand-in used by tests, queries and bench):

* key = customer, category = order priority, quantity = total price
* start = order date, end = start + (order key mod 60) days (1..60 days)
* commodity = 'GAS' for open, 'gas' for finished, 'electricity' for pending
  orders, method 'PRF'; the relevance filter keeps open and finished orders
* sequence = 2023-01-01 + order key seconds (unique: no ties)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import QUANTITY_TYPE

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SEQ_BASE = "TIMESTAMP_NTZ'2023-01-01 00:00:00'"
ORDER_RANGE_DAYS = 60


class SchemaChange(ValueError):
    """A write whose columns differ from the stored table's."""


def schema_changes(stored: StructType, new: StructType) -> list[str]:
    """What differs, as text: added, missing and retyped columns (order and nullability do not count)."""
    old, now = ({f.name: f.dataType.simpleString() for f in s} for s in (stored, new))
    out = [f"added {c} {t}" for c, t in now.items() if c not in old] + [f"missing {c} {t}" for c, t in old.items() if c not in now]
    return out + [f"{c}: {old[c]} became {t}" for c, t in now.items() if c in old and old[c] != t]


def write_table(df: DataFrame, path: str, mode: str = "append", on_change: str = "refuse", partition_by: tuple[str, ...] = ()) -> None:
    """Append to or overwrite a Parquet table, with a rule for another schema.

    * ``refuse``: any difference raises ``SchemaChange`` before a file is touched;
    * ``add``: new columns are accepted (older rows read as null; read with ``mergeSchema``), missing ones are written as null, a
      changed type is refused;
    * ``replace`` (overwrite only): the table takes the new schema and partitioning.

    The rows are written to a folder beside the table first and moved in when they are complete, so an overwrite
    may read the table itself, and a failure before the swap leaves it as it was."""
    if mode not in ("append", "overwrite") or on_change not in ("refuse", "add", "replace") or (on_change, mode) == ("replace", "append"):
        raise ValueError(f"no write with mode {mode!r} and on_change {on_change!r}")
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    exists = fs.exists(p)
    if exists and on_change != "replace":
        stored = spark.read.option("mergeSchema", "true").parquet(path).schema
        changes = schema_changes(stored, df.schema)
        if on_change == "add":
            df = df.select(*df.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in stored if f.name not in df.columns])
            changes = [c for c in changes if not c.startswith(("added ", "missing "))]
        if changes:
            raise SchemaChange(f"{path}: " + "; ".join(changes))
        # one order in all files: a reader takes that of any of them
        df = df.select(*[f.name for f in stored], *[c for c in df.columns if c not in stored.names])
    if mode == "append":
        df.write.mode("append").partitionBy(*partition_by).parquet(path)
        return
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(*partition_by).parquet(beside)
    if exists:
        fs.delete(p, True)
    fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside), p)


def read_source(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table or view (``db.name``) or, if the name holds a slash, a Parquet folder."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ranges_from_orders(orders: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``orders`` in the range-table schema (see module doc); ``carry``
    keeps extra order columns after the range columns."""
    start = F.to_date(F.col("o_orderdate"))
    return orders.select(
        F.col("o_custkey").cast("string").alias("point_of_delivery_ean"),
        F.col("o_orderpriority").alias("profile_category_code"),
        F.col("o_totalprice").cast(QUANTITY_TYPE).alias("sja"),
        F.lit("m3").alias("sj_unit_of_measure"),
        F.when(F.col("o_orderstatus") == "O", "GAS")
        .when(F.col("o_orderstatus") == "F", "gas")
        .otherwise("electricity")
        .alias("commodity_type"),
        F.lit("PRF").alias("allocation_method"),
        start.alias("effective_from_date"),
        F.date_add(start, F.pmod(F.col("o_orderkey"), F.lit(ORDER_RANGE_DAYS)).cast("int")).alias("effective_to_date"),
        F.expr(f"timestampadd(SECOND, o_orderkey, {SEQ_BASE})").alias("__record_timestamp"),
        *carry,
    )


def ranges_from_events(events: DataFrame, max_days: int = 3) -> DataFrame:
    """``events`` in the range-table schema: key = user, category = event
    type, quantity = value, start = event day, end = start + (event id mod
    ``max_days``) days, sequence = event time."""
    start = F.to_date(F.col("ts"))
    return events.select(
        F.col("user_id").cast("string").alias("point_of_delivery_ean"),
        F.col("event_type").alias("profile_category_code"),
        F.col("value").cast(QUANTITY_TYPE).alias("sja"),
        F.lit("m3").alias("sj_unit_of_measure"),
        F.lit("gas").alias("commodity_type"),
        F.lit("PRF").alias("allocation_method"),
        start.alias("effective_from_date"),
        F.date_add(start, F.pmod(F.col("event_id"), F.lit(max_days)).cast("int")).alias("effective_to_date"),
        F.col("ts").cast("timestamp_ntz").alias("__record_timestamp"),
    )


def ranges_from_lineitem(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One range per line item from the order date to the ship date; about
    half of them end before they start (the inverted-range fixture)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    li = lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("o_custkey").cast("string").alias("point_of_delivery_ean"),
        F.col("o_orderpriority").alias("profile_category_code"),
        F.col("l_extendedprice").cast(QUANTITY_TYPE).alias("sja"),
        F.lit("m3").alias("sj_unit_of_measure"),
        F.lit("gas").alias("commodity_type"),
        F.lit("PRF").alias("allocation_method"),
        F.to_date("o_orderdate").alias("effective_from_date"),
        F.to_date("l_shipdate").alias("effective_to_date"),
        F.expr(f"timestampadd(SECOND, l_orderkey * 8 + l_linenumber, {SEQ_BASE})").alias("__record_timestamp"),
    )
