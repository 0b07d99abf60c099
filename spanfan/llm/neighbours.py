"""Nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Every vector is projected on ``M`` Gaussian directions. For a pair at distance *r* the squared
projected distance over ``r ** 2`` follows the chi-square law with ``M`` degrees of freedom. A search
visits points in the order of their projected distance *p*, verifies them with the exact
distance, and stops when ``cdf(p**2 / r_k**2) >= confidence`` for the k-th nearest verified
so far, *r_k*: a point that is nearer than *r_k* would have come earlier with
that probability. So every true neighbour is found with at least this probability;
the tests measure the recall against brute force.

The kd-tree has two levels, so that neither the index nor the visits of a query meet in one task:

* the top, at most ``MAX_CELLS`` cells, is split at medians of a sample (``SAMPLE`` projected points a
  cell, by smallest hash; a documented bound that places cells, every point is indexed);
* a cell holds blocks of about ``BLOCK_BYTES`` of vectors, as many as its points need, so a crowded
  cell is many blocks. A task reads one block, builds its kd-tree, and streams queries past it.

Queries are a stated set, not collected or broadcast. They go in rounds to their nearest cell,
the next 8, the next 64 and so on, and only to cells that the stopping test leaves with the k-th distance of
the rounds before. Within a block leaves come in the order of their distance, in growing steps. The
queries of one block are cut into chunks, each with its own copy of the block.

Of equal vectors only the ``k + 1`` smallest ids can be in any answer, so the others are not indexed
(they stay queries). That is exact, and keeps a vector that a third of all rows share cheap.

Cases: vectors null, zero, or with null or non-finite entries and rows without ``vec_id`` take no part;
a shorter vector counts as padded with zeros; a row that repeats both id and vector is one candidate, other
vectors under the same id are further candidates (and queries), none of them for that id; ties go to the
smaller id; with fewer than *k* candidates all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanfan.llm.common import read_table, small, stored
from spanfan.llm.vectors import dimension, finite_vectors, lists, matrix

K = 10
M = 8  # projected dimensions (even, for the closed form of the chi-square law)
CONFIDENCE = 0.98
BLOCK_BYTES = 4 << 20
MAX_CELLS = 4096
SAMPLE = 64
LEAF = 128
QUERIES_PER_BLOCK = 50_000

FOUND = "query_id long, query long, vec_id long, score double"


def chi_square_cdf(x: float, m: int = M) -> float:
    """Chi-square distribution function for even ``m``."""
    term, total = 1.0, 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, m: int = M) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, m) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, m) < p else (low, mid)
    return high


def directions(d: int, m: int = M) -> np.ndarray:
    return np.random.default_rng(20_011).standard_normal((d, m))


class Tree:
    """kd-tree over projected points: equal parts at medians of the widest axis."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros((1 << depth) - 1, dtype=np.int64)
        self.value = np.zeros((1 << depth) - 1)
        parts = [np.arange(len(points))]
        for node in range(len(self.axis)):
            own = parts[node]
            if len(own):
                at = int(np.argmax(np.ptp(points[own], axis=0)))
                half = (len(own) - 1) // 2
                own = own[np.argpartition(points[own, at], half)]
                self.axis[node], self.value[node] = at, points[own[half], at]
                parts += [own[: half + 1], own[half + 1 :]]
            else:
                parts += [own, own]
        self.leaves = parts[len(self.axis) :]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.value[node])
        return node - len(self.axis)


def gaps(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of the point ``p`` to boxes."""
    return (np.maximum(np.maximum(low - p, p - high), 0) ** 2).sum(axis=1)


class Block:
    """The kd-tree of one block, and the search of a query in it."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, p: np.ndarray):
        tree = Tree(p, max(0, math.ceil(math.log2(max(1, len(p) / LEAF)))))
        order = np.concatenate(tree.leaves)
        self.ids, self.v, self.p = ids[order], v[order], p[order]
        sizes = np.array([len(x) for x in tree.leaves])
        begin = np.cumsum(sizes) - sizes
        full = sizes > 0
        self.begin, self.sizes = begin[full], sizes[full]
        self.low = np.minimum.reduceat(self.p, self.begin)
        self.high = np.maximum.reduceat(self.p, self.begin)

    def search(self, query_id: int, v: np.ndarray, p: np.ndarray, bound: float, k: int, quantile: float):
        """(distances, ids) of at most ``k`` rows within ``bound``, nearest first."""
        lead = gaps(p, self.low, self.high)
        order = np.argsort(lead, kind="stable")
        best, ids = np.zeros(0), np.zeros(0, dtype=np.int64)
        at, step = 0, 1
        while at < len(order) and lead[order[at]] <= quantile * bound * bound:
            leaves = order[at : at + step]
            sizes = self.sizes[leaves]
            skip = np.cumsum(sizes) - sizes
            rows = np.arange(sizes.sum()) + np.repeat(self.begin[leaves] - skip, sizes)
            near = ((self.p[rows] - p) ** 2).sum(axis=1) <= quantile * bound * bound
            rows = rows[near & (self.ids[rows] != query_id)]
            found = np.sqrt(((self.v[rows] - v) ** 2).sum(axis=1))
            best, ids = np.concatenate([best, found]), np.concatenate([ids, self.ids[rows]])
            top = np.lexsort((ids, best))[:k]
            best, ids = best[top], ids[top]
            if len(best) == k:
                bound = min(bound, float(best[-1]))
            at, step = at + step, 2 * step
        return best, ids


def _projected(vectors: DataFrame, d: int, tree: Tree | None = None) -> DataFrame:
    """``v`` padded, its projection ``p`` and its cell (0 without a tree), after the other columns."""
    names = [c for c in vectors.columns if c != "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = directions(d)
        for b in batches:
            v = matrix(b.column(b.schema.get_field_index("v")), d)
            p = v @ g
            cell = tree.cell(p) if tree else np.zeros(len(p), dtype=np.int64)
            own = [b.column(b.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*own, lists(v), lists(p), pa.array(cell.astype(np.int32))], names=[*names, "v", "p", "cell"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema if f.name != "v")
    return vectors.select(*names, "v").mapInArrow(run, f"{schema}, v array<double>, p array<double>, cell int")


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    return finite_vectors(df, vec_id, vector).filter(F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0))


class Index:
    """All candidates, dealt into cells and blocks: a stored table ``block, vec_id, v, p`` and the boxes
    of the cells (at most ``MAX_CELLS`` rows, on the driver)."""

    def __init__(self, vectors: DataFrame, d: int, k: int, block_bytes: int = BLOCK_BYTES):
        self.d = d
        same = Window.partitionBy("v").orderBy("vec_id")
        distinct = vectors.dropDuplicates(["v", "vec_id"]).withColumn("at", F.row_number().over(same)).filter(F.col("at") <= k + 1)
        points = stored(_projected(distinct.select("vec_id", "v"), self.d).drop("cell"), "neighbours-points")
        n = points.count()
        rows = max(64, block_bytes // (8 * self.d))
        depth = min(int(math.log2(MAX_CELLS)), math.ceil(math.log2(max(1, n / rows))))
        part = min(1.0, SAMPLE * (1 << depth) / n)
        draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < math.ceil(part * (1 << 20))
        sample = points.filter(draw).select("p").toArrow().column("p")
        self.tree = Tree(matrix(sample.combine_chunks(), M), depth)
        tree = self.tree

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.append_column("cell", pa.array(tree.cell(matrix(b.column(2), M)).astype(np.int32)))

        dealt = points.mapInArrow(cells, "vec_id long, v array<double>, p array<double>, cell int")
        edges = [f(F.col("p")[i]) for f in (F.min, F.max) for i in range(M)]
        boxes = dealt.groupBy("cell").agg(F.count("*").alias("n"), *edges).orderBy("cell").collect()
        self.cell = np.array([b[0] for b in boxes])
        self.low = np.array([b[2 : 2 + M] for b in boxes])
        self.high = np.array([b[2 + M :] for b in boxes])
        self.blocks = np.array([-(-b["n"] // rows) for b in boxes])
        self.first = np.cumsum(self.blocks) - self.blocks
        layout = points.sparkSession.createDataFrame(
            [(int(c), int(f), int(m)) for c, f, m in zip(self.cell, self.first, self.blocks)], "cell int, first int, blocks int"
        )
        block = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
        # at most MAX_CELLS rows
        self.rows = stored(dealt.join(F.broadcast(layout), "cell").select(block.alias("block"), "vec_id", "v", "p"), "neighbours-index")


def _visits(queries: DataFrame, index: Index, start: int, stop: int, quantile: float) -> DataFrame:
    """``query, bound, blocks``: the blocks of the cells of rank ``start`` to ``stop`` by distance that
    the stopping test leaves, for queries that have one."""
    low, high, first, count = index.low, index.high, index.first, index.blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, bound = matrix(b.column(1), M), b.column(2).to_numpy(zero_copy_only=False)
            at, found = [], []
            for i in range(len(p)):
                lead = gaps(p[i], low, high)
                cells = np.argsort(lead, kind="stable")[start:stop]
                cells = cells[lead[cells] <= quantile * bound[i] ** 2]
                if len(cells):
                    at.append(i)
                    found.append(np.concatenate([np.arange(first[c], first[c] + count[c]) for c in cells]))
            if at:
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(2).take(take), pa.array(found, pa.list_(pa.int32()))], names=["query", "bound", "blocks"]
                )

    return queries.select("query", "p", "bound").mapInArrow(run, "query long, bound double, blocks array<int>")


def _search(work: DataFrame, d: int, k: int, quantile: float) -> DataFrame:
    """Rows ``block, chunk, query (null: a row of the index), id, v, p, bound``, dealt and sorted with the
    index first -> at most ``k`` rows a query and block. A task holds one block and one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block, now = [], None, None
        for b in batches:
            group = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1)
            query = b.column(2)
            is_query = ~query.is_null().to_numpy(zero_copy_only=False)
            ids = b.column(3).to_numpy()
            v, p = matrix(b.column(4), d), matrix(b.column(5), M)
            bound = b.column(6).fill_null(0.0).to_numpy()
            query = query.fill_null(0).to_numpy()
            new = np.ones(len(ids), dtype=bool)
            new[1:] = (group[1:] != group[:-1]).any(axis=1) | (is_query[1:] != is_query[:-1])
            cuts = np.append(np.flatnonzero(new), len(ids))
            out = []
            for s, e in zip(cuts[:-1], cuts[1:]):
                if tuple(group[s]) != now:
                    held, block, now = [], None, tuple(group[s])
                if not is_query[s]:
                    held.append((ids[s:e].copy(), v[s:e].copy(), p[s:e].copy()))
                    continue
                if block is None:
                    block, held = Block(*[np.concatenate(x) for x in zip(*held)]), []
                for i in range(s, e):
                    best, found = block.search(ids[i], v[i], p[i], bound[i], k, quantile)
                    out.append((np.full(len(found), ids[i]), np.full(len(found), query[i]), found, best))
            if out:
                columns = [np.concatenate(x) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "query", "vec_id", "score"])

    dealt = work.repartition("block", "chunk").sortWithinPartitions("block", "chunk", F.col("query").asc_nulls_first())
    return dealt.select("block", "chunk", "query", "id", "v", "p", "bound").mapInArrow(run, FOUND)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, confidence: float = CONFIDENCE, block_bytes: int = BLOCK_BYTES,
            per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``vectors(vec_id, v)`` found for every row of
    ``queries(vec_id, v)``, itself excluded by its id."""
    spark = vectors.sparkSession
    quantile = chi_square_quantile(confidence)
    d = dimension(vectors)
    if not d:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = Index(vectors, max(d, dimension(queries)), k, block_bytes)
    numbered = queries.dropDuplicates(["v", "vec_id"]).select("vec_id", F.xxhash64("vec_id", "v").alias("query"), "v")
    asked = stored(_projected(numbered, index.d).drop("cell"), "neighbours-queries")
    chunks = -(-asked.count() // per_block)
    chunk = F.pmod(F.xxhash64("query"), F.lit(max(1, chunks))).cast("int")
    best, start, stop = None, 0, 1
    by_score = Window.partitionBy("query").orderBy("score", "vec_id")
    while start < len(index.cell):
        bounds = asked.select("query", "p").withColumn("bound", F.lit(float("inf")))
        if best is not None:
            last = best.groupBy("query").agg(F.when(F.count("*") == k, F.max("score")).alias("kth"))
            bounds = bounds.drop("bound").join(last, "query", "left").withColumn("bound", F.coalesce("kth", F.lit(float("inf"))))
        visits = stored(_visits(bounds, index, start, stop, quantile), f"neighbours-visits{start}")
        start, stop = stop, 9 * stop
        if visits.isEmpty():
            break
        wanted = visits.select(F.explode("blocks").alias("block"), chunk.alias("chunk")).distinct()
        there = index.rows.join(small(wanted), "block").select(
            "block", "chunk", F.lit(None).cast("long").alias("query"), F.col("vec_id").alias("id"), "v", "p", F.lit(None).cast("double").alias("bound")
        )
        here = visits.join(asked, "query").select(
            F.explode("blocks").alias("block"), chunk.alias("chunk"), "query", F.col("vec_id").alias("id"), "v", "p", "bound"
        )
        found = _search(there.unionByName(here), index.d, k, quantile)
        if best is not None:
            found = found.unionByName(best)
        best = stored(found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).drop("rank"), f"neighbours-best{start}")
    if best is None:  # no query
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return best.select("query_id", F.row_number().over(by_score).alias("rank"), "vec_id", "score")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found for every vector whose id is divisible by 100, among all others."""
    vectors = usable(read_table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"))
