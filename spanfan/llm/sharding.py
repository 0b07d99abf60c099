"""Shards of near-equal bytes by Karmarkar-Karp differencing.

Documents with equal texts are one indivisible group. A partial partition is
a list of at most ``k`` (sum, groups) bins; the two with the largest spread
are combined again and again, the largest bin of one with the smallest of the
other, until one is left. Each task does this for its own groups; what it
leaves is again a partial partition (``k`` sums), and these are combined by
the same rule, which needs only tasks x ``k`` numbers on the driver.

A group that alone holds more than an even share of the bytes cannot fit into
any even shard. Fewer than ``k`` such groups can exist; they alone are cut
into blocks of about a quarter of a share, so a hot group does not break the
law. All other groups stay whole.

Slots are gapless without sorting a shard: each task numbers its rows per
shard, and the start of each (task, shard) is a running sum over their counts.

Cases: a null text has no bytes and is equal to the empty text; null or
repeated ``doc_id`` values are rows like others; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanfan.llm.common import read_table, stored

SHARDS = 40
OVERHEAD = 16


def differencing(parts: list[list[tuple[int, list]]], k: int) -> list[tuple[int, list]]:
    """Karmarkar-Karp over partial partitions, each a list of at most ``k`` bins
    ``(sum, members)`` in descending order (missing bins are empty)."""

    def spread(bins: list) -> int:
        return bins[0][0] - (bins[-1][0] if len(bins) == k else 0)

    heap = [(-spread(p), i, p) for i, p in enumerate(parts) if p]
    heapq.heapify(heap)
    made = len(parts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        meet = len(a) + len(b) - k  # bins that must share, smallest of a with largest free of b
        if meet > 0:
            joined = []
            pad = k - len(b)  # the largest bins of a meet the empty bins of b
            for i, (s, members) in enumerate(a):
                if i < pad:
                    joined.append((s, members))
                    continue
                t, other = b[k - 1 - i]
                big, small = (members, other) if len(members) >= len(other) else (other, members)
                big.extend(small)
                joined.append((s + t, big))
            joined.extend(b[: k - len(a)])  # the largest bins of b meet the empty bins of a
        else:
            joined = a + b
        joined.sort(key=lambda x: -x[0])
        heapq.heappush(heap, (-spread(joined), made, joined))
        made += 1
    return heap[0][2] if heap else []


def shard(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row."""
    t = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(t) + overhead).cast("long").alias("size"),
            F.crc32(t).alias("text_crc32"),
            F.unhex(F.sha2(t, 256)).alias("group"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    sizes = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(1.0, total / k)
    large = sizes.filter(F.col("bytes") > share).select(  # fewer than k rows
        "group", F.ceil(4 * F.col("bytes") / share).alias("blocks")
    )
    rows = rows.join(F.broadcast(large), "group", "left").withColumn(
        "block", F.coalesce(F.pmod(F.xxhash64("row"), F.col("blocks")), F.lit(0)).cast("long")
    ).drop("blocks")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.Table.from_batches(tables).combine_chunks()
        bytes_ = t.column("bytes").to_pylist()
        bins = differencing([[(b, [i])] for i, b in enumerate(bytes_)], k)
        at = np.zeros(len(bytes_), dtype=np.int64)
        for i, (_, members) in enumerate(bins):
            at[members] = i
        task = np.full(len(bytes_), TaskContext.get().partitionId(), dtype=np.int64)
        out = t.append_column("task", pa.array(task)).append_column("bin", pa.array(at))
        yield from out.to_batches(max_chunksize=50_000)

    blocks = rows.groupBy("group", "block").agg(F.sum("size").alias("bytes"))
    placed = stored(
        blocks.mapInArrow(local, "group binary, block long, bytes long, task long, bin long"), "shard-blocks"
    )
    # tasks x k sums: the bound of what reaches the driver, whatever the rows
    sums: dict[int, list[tuple[int, list]]] = {}
    for r in placed.groupBy("task", "bin").agg(F.sum("bytes").alias("b")).collect():
        sums.setdefault(r["task"], []).append((int(r["b"]), [(r["task"], r["bin"])]))
    parts = [sorted(sums[task], key=lambda x: (-x[0], x[1])) for task in sorted(sums)]
    bins = differencing(parts, k)
    moves = [(task, b, s) for s, (_, members) in enumerate(bins) for task, b in members]
    spark = docs.sparkSession
    names = F.broadcast(spark.createDataFrame(moves, "task long, bin long, shard int"))
    placed = placed.join(names, ["task", "bin"]).select("group", "block", "shard")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(k, dtype=np.int64)
        for b in batches:
            s = b.column(b.schema.get_field_index("shard")).to_numpy()
            order = np.argsort(s, kind="stable")
            n = np.bincount(s, minlength=k)
            first = np.cumsum(n) - n
            idx = np.empty(len(s), dtype=np.int64)
            idx[order] = np.arange(len(s)) - np.repeat(first, n) + np.repeat(seen, n)
            seen += n
            cols = [b.column(i) for i in range(b.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(np.full(len(s), task, dtype=np.int64)), pa.array(idx)],
                names=[*b.schema.names, "task", "idx"],
            )

    found = rows.join(placed, ["group", "block"]).select("doc_id", "size", "text_crc32", "shard")
    id_type = dict(rows.dtypes)["doc_id"]
    numbered = stored(
        found.mapInArrow(number, f"doc_id {id_type}, size long, text_crc32 long, shard int, task long, idx long"),
        "shard-numbered",
    )
    counts = numbered.groupBy("task", "shard").agg(F.count("*").alias("n"))  # tasks x k rows
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return numbered.join(F.broadcast(starts), ["task", "shard"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("idx")).alias("slot")
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes."""
    return shard(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
