"""Helpers shared by the operators: stored tables, links, components, Arrow text.

``stored`` cuts lineage with a Parquet table below ``spark.checkpoint.dir``.
``resolve`` turns buckets of candidate nodes into components without emitting
all pairs of a bucket; ``components`` is the distributed union-find.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.session import shuffles_removed, work_dir

# word pattern of the contracts: runs without space and control white space
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read from there. What was shuffled for it is removed."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# -- union-find -----------------------------------------------------------------


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``links(a, b)`` (longs, both directions equal) -> ``(node, comp)`` for every
    node that has a link; ``comp`` is the smallest node reachable.

    Alternating large-star / small-star steps. Minima are plain aggregates
    with map-side combine, so a node with many links is not gathered.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "cc-0",
    )
    state = None
    for i in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u <> v")
            .distinct()
        )
        edges = stored(small, f"cc-{i + 1}")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)


# -- buckets -> links -> components ---------------------------------------------------


def _labelled(members: DataFrame, comp: DataFrame) -> DataFrame:
    return (
        members.drop("comp")
        .join(comp, "node", "left")
        .withColumn("comp", F.coalesce("comp", "node"))
        .select(*members.columns)
    )


def _split_components(members: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components."""
    spans = members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    return members.join(spans.select("bucket"), "bucket", "left_semi")


def small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """``df`` (a few narrow columns), marked for broadcast if a count shows that it has at
    most ``max_rows`` rows; otherwise as it is, so that the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def split_buckets(members: DataFrame) -> DataFrame:
    """The distinct ``(bucket, node)`` rows (longs) of buckets with more than one node.

    One shuffle and sort; a task reads its rows in a stream and holds at most
    the first node of a bucket, whatever the bucket's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))  # a bucket with one node so far
        seen = None  # last row of a bucket that is known to have more
        for b in batches:
            bucket = np.concatenate([held[0], b.column(0).to_numpy()])
            node = np.concatenate([held[1], b.column(1).to_numpy()])
            fresh = np.ones(len(bucket), dtype=bool)
            fresh[1:] = (bucket[1:] != bucket[:-1]) | (node[1:] != node[:-1])
            if seen is not None and len(bucket):
                fresh[0] = (bucket[0], node[0]) != seen
            bucket, node = bucket[fresh], node[fresh]
            if not len(bucket):
                continue
            new = np.ones(len(bucket), dtype=bool)
            new[1:] = bucket[1:] != bucket[:-1]
            run_of = np.cumsum(new) - 1
            size = np.bincount(run_of)
            if seen is not None and bucket[0] == seen[0]:
                size[0] += 1
            many = (size > 1)[run_of]
            if many[-1]:
                held, seen = (bucket[:0], node[:0]), (bucket[-1], node[-1])
            else:
                held, seen = (bucket[-1:], node[-1:]), None
            if many.any():
                yield pa.RecordBatch.from_arrays([pa.array(bucket[many]), pa.array(node[many])], names=["bucket", "node"])

    dealt = members.select("bucket", "node").repartition("bucket").sortWithinPartitions("bucket", "node")
    return dealt.mapInArrow(run, "bucket long, node long")


def shared_buckets(members: DataFrame) -> DataFrame:
    """The ``(bucket, node)`` rows (longs, distinct) of buckets with more than one node, in DataFrame operations: one
    shuffle by bucket serves the least and greatest node and the join (an inner join with unique buckets: Spark moves a semi
    join below the repartition, and then the rows are made and shuffled once for either side)."""
    dealt = members.select("bucket", "node").repartition("bucket")
    many = dealt.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("bucket")
    return dealt.join(many.hint("shuffle_hash"), "bucket").select("bucket", "node")


BLOCKS = 32


def profiles(elements: DataFrame) -> DataFrame:
    """``node, n, m, blocks`` from ``elements(node, n, x)`` (the distinct set elements
    of some nodes, ``n`` the size of the set): ``m`` elements are in two sets or
    more, and ``blocks`` counts these by hash block. One shuffle by element
    serves the count and the join."""
    dealt = elements.repartition("x")
    again = dealt.groupBy("x").agg(F.count("*").alias("sets")).filter("sets > 1").select("x")
    shared = dealt.join(again, "x", "left_semi")
    block = [F.sum((F.pmod("x", F.lit(BLOCKS)) == i).cast("int")).cast("int") for i in range(BLOCKS)]
    return shared.groupBy("node").agg(F.max("n").alias("n"), F.count("*").alias("m"), F.array(*block).alias("blocks"))


def _could_link(left: str, right: str, percent: int) -> F.Column:
    """Exact upper bounds of the Jaccard similarity of two profiles: an element that
    no other set has is in no intersection, and an intersection is at
    most the smaller count in every block."""
    n = F.col(f"{left}.n") + F.col(f"{right}.n")
    m = F.least(F.col(f"{left}.m"), F.col(f"{right}.m"))
    low = F.zip_with(F.col(f"{left}.blocks"), F.col(f"{right}.blocks"), lambda x, y: F.least(x, y))
    o = F.aggregate(low, F.lit(0), lambda s, x: s + x)
    return (100 * m >= percent * (n - m)) & (100 * o >= percent * (n - o))


def shared_counts(sets: DataFrame) -> DataFrame:
    """``node, x, m`` from ``sets(node, x)`` (distinct elements as an array): ``m`` elements are in two sets or more. Sets
    without any are left out."""
    dealt = sets.select("node", F.explode("x").alias("e")).repartition("e")
    again = dealt.groupBy("e").agg(F.count("*").alias("sets")).filter("sets > 1").select("e")
    counts = dealt.join(again, "e", "left_semi").groupBy("node").agg(F.count("*").alias("m"))
    return sets.join(counts, "node")


def _alike(left: str, right: str, percent: int, cond: F.Column) -> F.Column:
    """Exact bounds by whole sets, the cheap ones first: ``x`` has the elements' hashes as ints and ``n`` their true number,
    so what an intersection of hashes lacks is at most what hashing lost of a set; ``m`` as in ``shared_counts``."""
    x, y, lost = F.col(f"{left}.x"), F.col(f"{right}.x"), F.col(f"{left}.n") - F.size(f"{left}.x")
    need = percent * (F.col(f"{left}.n") + F.col(f"{right}.n"))
    few = F.least(F.col(f"{left}.m") + lost, F.col(f"{right}.m") + F.col(f"{right}.n") - F.size(y))
    return ((100 + percent) * few >= need) & cond & ((100 + percent) * (F.size(F.array_intersect(x, y)) + lost) >= need)


def resolve(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    elements: Callable[[DataFrame], DataFrame],
    percent: int,
    may_link: Callable[[str, str], F.Column] | None = None,
    rounds: int = 2,
    name: str = "links",
    whole_stars: bool = False,
) -> DataFrame:
    """Components over the verified links between nodes that share a bucket.

    ``members(bucket, node, ...)``; ``verify(pairs(a, b))`` returns the rows
    of ``pairs`` that are links, that is, have a Jaccard similarity of
    ``percent``; ``elements(nodes)`` gives the sets of some nodes.

    In a round every bucket has one pivot and every node is compared with the
    first pivot among its buckets (a star: at most one pair per node). The
    first pivots are the nodes with the most bucket neighbours, later ones are drawn
    from a bucket's largest component. Buckets whose members are then in one
    component are done. What is left is settled exactly: in a bucket that
    still holds several components, every member outside the largest of
    them meets all members of other components, and is compared with those that an
    exact bound allows. So every pair that shares a bucket is compared,
    already connected, or too different. ``may_link(l, r)`` is a necessary
    condition on two aliases of ``members`` for the stars.

    With ``whole_stars`` every node meets the pivots of all its buckets in a round (at most one pair per member row), and a
    pivot then leaves its bucket: it has met all others. So a bucket of two is done after one round even if they are not
    alike, and only large buckets are left for the last step, where ``may_link``, which must be an exact bound, holds too.
    ``elements`` then gives a set as one row, ``node, x`` with ``x`` an array of int hashes, which are compared inside that
    join: it makes a row for each link, not for each pair that is nearly alike.
    """
    cond = may_link or (lambda left, right: F.lit(True))
    size = members.groupBy("bucket").agg(F.count("*").alias("c"))
    score = members.select("bucket", "node").join(size, "bucket").groupBy("node").agg(F.sum("c").alias("score"))
    members = stored(members.join(score, "node").withColumn("comp", F.col("node")), f"{name}-scored")
    links = comp = None
    done: list[DataFrame] = []  # (bucket, node) rows that have met their bucket

    def star(r: int) -> DataFrame:
        draw = F.xxhash64("node", F.lit(r))
        own = [c for c in members.columns if c != "bucket"]
        if r == 0:
            ranked = members.withColumn("h", F.struct((-F.col("score")).alias("s"), draw.alias("d")))
        else:
            of_comp = members.groupBy("bucket", "comp").agg(F.count("*").alias("c"))
            ranked = members.join(of_comp, ["bucket", "comp"]).withColumn("h", F.struct((-F.col("c")).alias("s"), draw.alias("d")))
        pivot = ranked.groupBy("bucket").agg(F.min(F.struct("h", *own)).alias("p")).select("bucket", "p.*")
        met = (
            members.alias("l").join(pivot.alias("r"), F.col("l.bucket") == F.col("r.bucket"))
            .filter((F.col("l.comp") != F.col("r.comp")) & cond("l", "r"))
            .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"), F.col("r.h").alias("h"))
        )
        if whole_stars:
            done.append(stored(pivot.select("bucket", "node"), f"{name}-pivots{r}"))
            return met.select("a", "b")
        return met.groupBy("a").agg(F.min(F.struct("h", "b")).alias("p")).select("a", F.col("p.b").alias("b"))

    def rest() -> DataFrame:
        sets = elements(members.select("node").distinct())
        if whole_stars:  # the size and the columns of ``may_link`` stay
            own = members.groupBy("node").agg(F.collect_list("bucket").alias("own"))
            known = stored(shared_counts(stored(sets, f"{name}-sets")).join(own, "node"), f"{name}-profiles")
            full = members.drop("score").join(known, "node").filter(100 * (F.col("m") + F.col("n") - F.size("x")) >= percent * F.col("n"))
            # a pair that shares several buckets is compared in the least of them only
            least = lambda left, right: F.array_min(F.array_intersect(f"{left}.own", f"{right}.own"))
            here = lambda left, right: F.col(f"{left}.bucket") == least(left, right)
            allowed = lambda left, right: _alike(left, right, percent, cond(left, right) & here(left, right))
        else:
            full = members.select("bucket", "node", "comp").join(stored(profiles(sets), f"{name}-profiles"), "node")
            allowed = lambda left, right: _could_link(left, right, percent)
        of_comp = members.groupBy("bucket", "comp").agg(F.count("*").alias("c"))
        main = of_comp.groupBy("bucket").agg(F.max(F.struct("c", "comp")).alias("x")).select("bucket", F.col("x.comp").alias("main"))
        outside = full.join(main, "bucket").filter("comp <> main")
        return (
            full.alias("l").join(outside.alias("r"), F.col("l.bucket") == F.col("r.bucket"))
            .filter((F.col("l.comp") != F.col("r.comp")) & allowed("l", "r"))
            .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
        )

    for r in range(rounds + 1):
        if comp is not None or done:
            if done:
                members = members.join(done.pop(), ["bucket", "node"], "left_anti").select(*members.columns)
            if comp is not None:
                members = _labelled(members, comp)
            members = stored(_split_components(members), f"{name}-split{r}")
        if members.isEmpty():
            break
        pairs = star(r) if r < rounds else rest()
        pairs = stored(
            pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-pairs{r}"
        )
        found = stored(verify(pairs), f"{name}-found{r}")
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty():
            comp = stored(components(links), f"{name}-comp{r}")
    if comp is None:
        return members.select("node", F.col("node").alias("comp")).limit(0)
    return comp


# -- Arrow text --------------------------------------------------------------------


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as a large_string array (null stays null)."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_string array; a null has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        offsets = np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``max_bytes`` of text (a longer
    single text stays whole), so that numpy temporaries are bounded."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = raw(text_column(batch, column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            stop = min(batch.num_rows, max(stop, start + 1))
            yield batch.slice(start, stop - start)
            start = stop
