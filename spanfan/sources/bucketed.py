"""The target as a Spark bucketed table (catalog tables as source and target).

``save_bucketed`` writes rows (hours, or the segments that ``operators.allocate.segment_hours`` makes them of: a broadcast join, which
keeps the buckets) into a catalog table that is bucketed by key and category and sorted by hour or first day within a
bucket. Whatever groups or joins by these columns, with others or without, finds the rows where they are:
duplicate keys, reconciliation per entity and year, and the merge with changed keys in a table bucketed
the same way plan no Exchange of the target. Key columns come first in every grouping, as the
bucketing is by both.

The table has an explicit path (external), so dropping it leaves the files to their owner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CURVE, RANGE, CurveCols, RangeCols


def save_bucketed(rows: DataFrame, table: str, path: str, n_buckets: int, cols: RangeCols = RANGE, cc: CurveCols = CURVE,
                  mode: str = "overwrite") -> DataFrame:
    """Write ``rows`` bucketed by (key, category) and return the table. The rows are dealt by the bucketing before
    they are written, so a bucket is one file."""
    by = [cols.key, cols.category]
    (
        rows.repartition(n_buckets, *by)
        .write.mode(mode).format("parquet").option("path", path)
        .bucketBy(n_buckets, *by).sortBy(*by, cc.hour_start if cc.hour_start in rows.columns else "seg_from").saveAsTable(table)
    )
    return rows.sparkSession.table(table)


def bucketed_merge(spark: SparkSession, target: str, keys: str, rebuilt: str, cols: RangeCols = RANGE) -> DataFrame:
    """M1 on bucketed tables: the target's rows of other keys, and the rebuilt rows. ``target`` and ``keys`` (key and
    category, one row each) are bucketed alike, so the anti join is a sort-merge join of buckets in place.

    The two parts share no (key, category). Keep it so: Spark 4.1 takes the union of two bucketed scans for a table
    bucketed like them but does not put their buckets together, so a grouping by the bucket columns would not
    add up rows of both parts."""
    by = [cols.key, cols.category]
    kept = spark.table(target).join(spark.table(keys).hint("merge"), by, "left_anti")
    return kept.unionByName(spark.table(rebuilt).select(*kept.columns))


def changed_pairs(target: DataFrame, rebuilt: DataFrame, keys: DataFrame, cols: RangeCols = RANGE) -> DataFrame:
    """The (key, category) pairs that the changed ``keys`` have in the target or in the rebuilt rows."""
    by = [cols.key, cols.category]
    pairs = target.select(*by).distinct().unionByName(rebuilt.select(*by).distinct()).distinct()
    return pairs.join(keys.select(F.col(cols.key)).distinct(), cols.key, "left_semi")
