"""Streaming increment over a change-log folder.

Two steps, both restartable:

1. A Structured Streaming query reads the change-log folder as a file
   stream from ``start_version`` on, keeps changes where either image is
   relevant, and appends ``(key, _commit_version)`` to a Parquet sink with
   ``trigger(availableNow=True)``. Progress lives in the query checkpoint and
   the sink's commit log, so every log file is turned into keys exactly once,
   and a run with no new files adds nothing.
2. A batch step merges the keys of all sink files that it has not merged
   before: it rebuilds them from the newest state of the log and records the
   names of the files. A crash in between repeats an idempotent merge.

Files, not versions, say what is done: a commit that lands in several files, or
after a later one, brings its keys in a new sink file and is merged then. The
log is read after the stream has drained, so it holds every row whose key was
seen. History is loaded at a pinned version ``V`` and the stream starts *at*
``V`` (reading ``V`` again is harmless).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import RANGE, RELEVANCE, RangeCols
from ..functions.predicates import relevant
from ..plans.history import reload
from ..plans.increment import FOLD_SHARE, append_increment, apply_increment, fold
from ..sources.changes import VERSION, as_of
from ..sources.target import Target


def start_changed_keys_stream(
    spark: SparkSession,
    log_path: str,
    log_schema,
    keys_path: str,
    checkpoint: str,
    start_version: int,
    relevance: Iterable[tuple[str, str]] | None = RELEVANCE,
    cols: RangeCols = RANGE,
) -> StreamingQuery:
    """S4 + S13: change-log file stream -> changed keys sink (availableNow)."""
    feed = spark.readStream.schema(log_schema).parquet(log_path).filter(F.col(VERSION) >= F.lit(int(start_version)))
    if relevance is not None:
        feed = feed.filter(relevant(relevance))
    keys = feed.filter(F.col(cols.key).isNotNull()).select(cols.key, VERSION)
    return (
        keys.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(keys_path)
    )


def pending_keys(target: Target, keys_path: str, merged_path: str, cols: RangeCols = RANGE) -> DataFrame:
    """``(key, file)`` of the sink files that were not merged yet."""
    spark = target.spark
    sink = spark.read.parquet(keys_path).select(cols.key, F.col("_metadata.file_path").alias("file"))
    if not target.exists(merged_path):
        return sink
    return sink.join(spark.read.schema("file string").parquet(merged_path), "file", "left_anti").select(cols.key, "file")


def apply_pending(target: Target, log: DataFrame, keys_path: str, merged_path: str, curve: DataFrame,
                  as_of_date=None, cols: RangeCols = RANGE, merge: str = "rewrite", fold_share: float = FOLD_SHARE,
                  **kw) -> int | None:
    """S12 + M3: merge the keys of all new sink files, rebuilt from the newest
    version in ``log``. Returns that version (``None``: nothing to do). ``merge="delta"`` appends a
    delta batch and folds the buckets whose delta has reached ``fold_share`` of their base."""
    pending = pending_keys(target, keys_path, merged_path, cols)
    if pending.isEmpty():
        return None
    top = int(log.agg(F.max(VERSION)).first()[0])
    keys = pending.select(cols.key).distinct()
    ranges = as_of(log, top, keys, cols.key)
    if merge == "delta":
        append_increment(target, ranges, keys, curve, as_of=as_of_date, cols=cols, **kw)
        fold(target, fold_share, cols)
    else:
        apply_increment(target, ranges, curve, keys, as_of=as_of_date, cols=cols, **kw)
    pending.select("file").distinct().write.mode("append").parquet(merged_path)
    return top


def run_stream_increment(
    spark: SparkSession,
    target: Target,
    log_path: str,
    state_root: str,
    curve: DataFrame,
    start_version: int,
    **kw,
) -> int | None:
    """One scheduled run: drain the change log with ``availableNow``, then
    merge the pending keys. Safe to repeat."""
    keys_path = f"{state_root}/keys"
    q = start_changed_keys_stream(spark, log_path, spark.read.parquet(log_path).schema, keys_path,
                                  f"{state_root}/checkpoint", start_version, kw.get("relevance", RELEVANCE),
                                  kw.get("cols", RANGE))
    q.awaitTermination()
    if not target.exists(keys_path):
        return None
    # read now: the listing holds every file the stream has seen
    return apply_pending(target, spark.read.parquet(log_path), keys_path, f"{state_root}/merged", curve, **kw)


def reload_at(target: Target, log_path: str, state_root: str, curve: DataFrame, version: int, as_of_date=None, **kw) -> None:
    """M4, the whole runbook: rebuild the table from the log's state at ``version``, then set the seam: the stream's
    start version and a new, empty checkpoint with its own sink. The seam is written last, so a failed reload
    leaves the old stream in place (its increments are then repeated)."""
    spark = target.spark
    reload(target, as_of(spark.read.parquet(log_path), version), curve, as_of=as_of_date, **kw)
    checkpoint = f"{state_root.rstrip('/')}/from-{version}-{uuid.uuid4().hex[:8]}"
    seam = spark.range(1).select(F.lit(int(version)).cast("long").alias("version"), F.lit(checkpoint).alias("checkpoint"),
                                 F.current_timestamp().alias("at"))
    seam.write.mode("append").parquet(f"{state_root}/seam")


def seam_of(spark: SparkSession, state_root: str) -> tuple[int, str]:
    """Start version and state folder of the newest reload."""
    row = spark.read.parquet(f"{state_root}/seam").orderBy(F.desc("at")).first()
    return row["version"], row["checkpoint"]


def run_from_seam(spark: SparkSession, target: Target, log_path: str, state_root: str, curve: DataFrame, **kw) -> int | None:
    """A scheduled run that starts at the version of the newest reload, with its checkpoint."""
    version, state = seam_of(spark, state_root)
    return run_stream_increment(spark, target, log_path, state, curve, version, **kw)
