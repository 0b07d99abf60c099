"""Change log of a range table: production, snapshots and changed keys.

Without a table format that records changes, the log is a plain table of
row images with three extra columns (names as in the public change-feed
convention):

* ``_change_type``      - ``insert``, ``update_preimage``, ``update_postimage``, ``delete``
* ``_commit_version``   - bigint, increasing per commit
* ``_commit_timestamp`` - commit time

The range table has no primary key (several rows per entity), so changes are
computed and replayed as multisets (``EXCEPT ALL``), never keyed on the
entity alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RANGE, RELEVANCE, RangeCols
from ..functions.predicates import relevant

CHANGE_TYPE = "_change_type"
VERSION = "_commit_version"
COMMIT_TS = "_commit_timestamp"
META = [CHANGE_TYPE, VERSION, COMMIT_TS]
ADDING = ("insert", "update_postimage")
REMOVING = ("delete", "update_preimage")


def _stamp(df: DataFrame, change_type, version: int, commit_ts) -> DataFrame:
    ts = commit_ts if commit_ts is not None else dt.datetime(2000, 1, 1) + dt.timedelta(days=int(version))
    # via an ISO string: a Python datetime literal would pass through the
    # session time zone before becoming timestamp_ntz
    ts_lit = ts.isoformat(sep=" ") if isinstance(ts, dt.datetime) else str(ts)
    return (
        df.withColumn(CHANGE_TYPE, change_type if not isinstance(change_type, str) else F.lit(change_type))
        .withColumn(VERSION, F.lit(int(version)).cast("bigint"))
        .withColumn(COMMIT_TS, F.lit(ts_lit).cast("timestamp_ntz"))
    )


def initial_commit(snapshot: DataFrame, version: int = 0, commit_ts=None) -> DataFrame:
    """Every row of a first snapshot as an ``insert`` at ``version``."""
    return _stamp(snapshot, "insert", version, commit_ts)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = RANGE.key, version: int = 1,
                  commit_ts=None) -> DataFrame:
    """The commit that turns ``old`` into ``new``.

    One signed count per distinct row (``new`` +1, ``old`` -1, summed with a
    map-side combine) gives the multiset difference in a single shuffle:
    positive counts are inserts, negative ones deletes, each row repeated by
    its count. When the entity key has both kinds in the commit the rows are
    labelled update pre-/post-image. The key flags are one row per key,
    joined back (a key with many changes is streamed, never buffered)."""
    cols = old.columns
    signed = old.select(*cols, F.lit(-1).alias("_v")).unionByName(new.select(*cols, F.lit(1).alias("_v")))
    net = signed.groupBy(*cols).agg(F.sum("_v").alias("_n")).filter(F.col("_n") != 0)
    flags = net.groupBy(F.col(key).alias("_k")).agg(
        F.max(F.col("_n") > 0).alias("_add"), F.max(F.col("_n") < 0).alias("_rem")
    )
    j = net.join(flags, net[key].eqNullSafe(flags["_k"]), "left")
    both = F.col("_add") & F.col("_rem")
    label = F.when(F.col("_n") > 0, F.when(both, "update_postimage").otherwise("insert")).otherwise(
        F.when(both, "update_preimage").otherwise("delete")
    )
    # a row that changed n times is repeated in two steps of about sqrt(n), so no array grows with n
    n = F.abs(F.col("_n"))
    step = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    out = j.select(*cols, label.alias(CHANGE_TYPE), n.alias("_n"), step.alias("_step"),
                   F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(n / step).cast("long") - 1)).alias("_block"))
    size = F.least(F.col("_step"), F.col("_n") - F.col("_block") * F.col("_step"))
    out = out.select(*cols, CHANGE_TYPE, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_r"))
    return _stamp(out.drop("_r"), F.col(CHANGE_TYPE), version, commit_ts)


def as_of(log: DataFrame, version: int, keys: DataFrame | None = None, key: str = RANGE.key) -> DataFrame:
    """The table as of ``version``: rows added up to it minus rows
    removed up to it (multiset difference, no key needed). With ``keys`` only
    their rows are replayed: the log is restricted before the difference."""
    upto = log.filter(F.col(VERSION) <= F.lit(version))
    if keys is not None:
        upto = upto.join(keys.select(key).distinct(), key, "left_semi").select(*log.columns)
    data = [c for c in log.columns if c not in META]
    plus = upto.filter(F.col(CHANGE_TYPE).isin(*ADDING)).select(*data)
    minus = upto.filter(F.col(CHANGE_TYPE).isin(*REMOVING)).select(*data)
    return plus.exceptAll(minus)


def latest_version(log: DataFrame) -> DataFrame:
    """S3: one row, ``latest_version`` = highest committed version."""
    return log.agg(F.max(VERSION).alias("latest_version"))


def changed_keys(
    log: DataFrame,
    start_version: int | None = None,
    end_version: int | None = None,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    cols: RangeCols = RANGE,
) -> DataFrame:
    """X5 + F9: distinct entity keys touched by commits in
    ``[start_version, end_version]``.

    A change counts when *either* of its images is relevant: every image is a
    row of the log and is filtered on its own, so a pre-image keeps an entity
    that leaves the relevant set (e.g. gas -> electricity, hard delete).
    NULL keys are dropped. The result stays distributed."""
    f = log
    if start_version is not None:
        f = f.filter(F.col(VERSION) >= F.lit(start_version))
    if end_version is not None:
        f = f.filter(F.col(VERSION) <= F.lit(end_version))
    if relevance is not None:
        f = f.filter(relevant(relevance))
    return f.select(cols.key).filter(F.col(cols.key).isNotNull()).distinct()


def append_commit(commit: DataFrame, path: str) -> None:
    """Append one commit to a log folder (new files; readers see whole
    files, a streaming reader picks them up as a new batch)."""
    commit.write.mode("append").parquet(path)
