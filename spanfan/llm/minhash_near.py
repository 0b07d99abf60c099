"""Near-duplicate documents by circulant MinHash.

A document's set holds its distinct shingles of five words (ASCII case
ignored), as 64-bit hashes. Circulant MinHash needs two permutations only:
the first spreads a shingle to a position on a circle of 2^32 places, the
second, circularly shifted by *k*, gives coordinate *k*. Both are bijective
mixing functions, so nothing is stored. 250 coordinates form 50 bands of 5; two
documents with Jaccard 0.75 share a band with probability 1 - 1.3e-6. Pairs
that share a band are confirmed on the full sets, built anew from the whole
texts, and linked pairs become components (``common.resolve``).

Equal sets are one node, so a large group of copies is counted in the first
aggregate. Before texts are fetched, a pair must pass two tests: the exact
size bound, and a bound on 250 one-bit coordinates that a linked pair misses
with probability below 1e-12.

Cases: a null or empty text, or one of blanks, has an empty set, links with nothing
and is kept; fewer than five words are one shingle; repeated rows and equal
sets are linked; a null ``doc_id`` takes part, and a component without any
``doc_id`` has a null ``component_id``; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm.common import raw, read_table, resolve, slices, small, split_buckets, stored, text_column

WORDS = 5
BANDS, ROWS = 50, 5
PERCENT = 75
# of 250 one-bit coordinates, a pair at 0.75 agrees on 219 on average (deviation 5.2)
MIN_AGREE = 180

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finalizer (a bijection of 64-bit values)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shingles:
    """Shingle sets of texts, computed over the bytes of a whole Arrow column."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.powers = self.inverses = np.ones(1, dtype=U)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            inverse = U(pow(int(BASE), -1, 1 << 64))
            for name, base in (("powers", BASE), ("inverses", inverse)):
                table = np.full(n + 1, base, dtype=U)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def word_hashes(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(64-bit hash of every word, words per row)."""
        data, offsets = raw(column)
        n = len(data)
        self._grow(n)
        low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        inside = ~((low == 32) | ((low >= 9) & (low <= 13)))
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        first = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        last = np.flatnonzero(inside & (~after | edge[1:])) + 1
        sums = np.zeros(n + 1, dtype=U)
        np.cumsum((low.astype(U) + U(1)) * self.powers[:n], out=sums[1:])
        hashes = _mix((sums[last] - sums[first]) * self.inverses[first] + (last - first).astype(U))
        per_row = np.bincount(np.searchsorted(offsets, first, side="right") - 1, minlength=len(offsets) - 1)
        return hashes, per_row

    def __call__(self, column: pa.Array) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of every row."""
        hashes, per_row = self.word_hashes(column)
        k = self.words
        wide = np.zeros(max(len(hashes) - k + 1, 0), dtype=U)
        for j in range(k):
            wide = _mix(wide * U(0x2545F4914F6CDD1D) + hashes[j : len(hashes) - k + 1 + j] + U(j + 1))
        out, at = [], 0
        for n in per_row.tolist():
            if n >= k:
                out.append(np.unique(wide[at : at + n - k + 1]))
            elif n:
                h = np.zeros(1, dtype=U)
                for j in range(n):
                    h = _mix(h * U(0x2545F4914F6CDD1D) + hashes[at + j] + U(1000 + j))
                out.append(h)
            else:
                out.append(np.zeros(0, dtype=U))
            at += n
        return out


def circulant(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Signatures (rows x coordinates) of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    place = (_mix(flat + U(0x5851F42D4C957F2D)) >> U(32)).astype(np.uint32)  # first permutation
    out = np.empty((coordinates, len(sets)), dtype=np.uint32)
    block = 1 << 15  # a block's temporaries stay in cache
    cuts = [0]
    for i in range(1, len(sets)):
        if starts[i] - starts[cuts[-1]] >= block:
            cuts.append(i)
    cuts.append(len(sets))
    ends = np.append(starts, len(flat))
    for lo, hi in zip(cuts, cuts[1:]):
        x = place[ends[lo] : ends[hi]]
        at = starts[lo:hi] - starts[lo]
        y, z = np.empty_like(x), np.empty_like(x)
        for k in range(coordinates):  # second permutation, shifted by k on the circle
            np.add(x, np.uint32(k), out=y)
            np.right_shift(y, 16, out=z)
            np.bitwise_xor(y, z, out=y)
            np.multiply(y, np.uint32(0x85EBCA6B), out=y)
            np.right_shift(y, 13, out=z)
            np.bitwise_xor(y, z, out=y)
            np.multiply(y, np.uint32(0xC2B2AE35), out=y)
            out[k, lo:hi] = np.minimum.reduceat(y, at)
    return out.T


def bands_of(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, rows).astype(U)
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=U), (len(signature), bands)).copy()
    for j in range(rows):
        acc = _mix(acc * U(0x2545F4914F6CDD1D) + parts[:, :, j])
    return acc.view(np.int64)


def bits_of(signature: np.ndarray) -> np.ndarray:
    """One bit per coordinate as four longs (256 bits, the rest 0)."""
    bits = np.zeros((len(signature), 256), dtype=np.uint8)
    bits[:, : signature.shape[1]] = (signature >> 7) & 1
    return np.packbits(bits, axis=1).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, tid, text`` -> ``doc_id, tid, n, key, bits, bands`` (key null for an empty set)."""
    schema = "doc_id long, tid binary, n long, key binary, bits array<long>, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for b in slices(batches):
            sets = shingles(text_column(b))
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            bits: list = [[0, 0, 0, 0]] * len(sets)
            bands: list = [[]] * len(sets)
            if full:
                signature = circulant([sets[i] for i in full], BANDS * ROWS)
                for i, x, y in zip(full, bits_of(signature), bands_of(signature)):
                    keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    bits[i], bands[i] = x, y
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                    pa.array(bits, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "tid", "n", "key", "bits", "bands"],
            )

    return docs.mapInArrow(run, schema)


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose full shingle sets have ``100 * common >= percent * union``."""
    need = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = texts.join(small(need), "node", "left_semi")
    rows = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for b in slices(batches, "text_a", 1 << 20):
            left, right = shingles(text_column(b, "text_a")), shingles(text_column(b, "text_b"))
            keep = []
            for x, y in zip(left, right):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return rows.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def set_elements(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, n, x``: the shingles of the nodes, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for b in slices(batches, max_bytes=1 << 18):
            sets = shingles(text_column(b))
            n = np.array([len(s) for s in sets], dtype=np.int64)
            cols = [np.repeat(b.column(0).to_numpy(), n), np.repeat(n, n), np.concatenate(sets).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["node", "n", "x"])

    wanted = texts.join(small(nodes, 1_000_000), "node", "left_semi").select("node", "text")
    return wanted.mapInArrow(run, "node long, n long, x long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, tid, n_shingles, component_id, winner`` for every row; ``tid`` is the
    digest of the text, ``winner`` the (doc_id, tid) of the row that stands for the component."""
    t = F.col(f"`{text}`")
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.unhex(F.md5(F.coalesce(t, F.lit("")))).alias("tid"), t.alias("text"))
    rows = stored(signatures(base).withColumn("rid", F.monotonically_increasing_id()), "near-rows")
    nodes = stored(
        rows.filter("key is not null")
        .groupBy("key")
        .agg(F.min("rid").alias("node"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("who"),
             F.min("tid").alias("tid"), F.min("n").alias("n")),
        "near-nodes",
    )
    # one row per node: rid is unique, so this join has no hot key
    own = rows.join(nodes.select(F.col("node").alias("rid"), F.col("node")), "rid")
    members = split_buckets(own.select(F.explode("bands").alias("bucket"), "node"))
    attrs = rows.select(F.col("rid").alias("node"), "n", *[F.col("bits")[i].alias(f"b{i}") for i in range(4)])
    members = stored(members.join(attrs, "node"), "near-members")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "tid")
    texts = stored(base.select("tid", "text").join(small(stored(wanted, "near-wanted")), "tid").groupBy("node").agg(F.min("text").alias("text")), "near-texts")

    def may_link(left: str, right: str) -> F.Column:
        n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
        differ = sum(F.bit_count(F.col(f"{left}.b{i}").bitwiseXOR(F.col(f"{right}.b{i}"))) for i in range(4))
        return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (BANDS * ROWS - differ >= MIN_AGREE)

    comp = resolve(
        members, lambda pairs: verified(pairs, texts), lambda nodes: set_elements(nodes, texts), PERCENT, may_link, name="near"
    )
    label = nodes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    best = label.groupBy("comp").agg(F.min("who").alias("winner"))
    by_key = label.join(best, "comp").select("key", F.struct("winner.doc_id", "winner.tid").alias("winner"))
    return rows.join(small(by_key), "key", "left").select(
        "doc_id", "tid", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("winner.doc_id")).alias("component_id"),
        "winner",
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component (smallest ``doc_id``), with its own columns.
    Rows that repeat both text and ``doc_id`` count as one document."""
    found = stored(near_duplicates(docs, text, doc_id), "near-found")
    same = F.col("winner.doc_id").eqNullSafe(F.col("doc_id")) & F.col("winner.tid").eqNullSafe(F.col("tid"))
    groups = found.filter("winner is not null").groupBy("doc_id", "tid").agg(F.count("*").alias("n"), F.max(same).alias("won"))
    lost = stored(groups.filter("not won or n > 1").select("doc_id", "tid", "won"), "near-lost")
    own = lambda c: F.col(f"row.`{c}`")  # noqa: E731  a row travels as one struct beside our columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", own(doc_id).cast("long").alias("doc_id"), F.unhex(F.md5(F.coalesce(own(text), F.lit("")))).alias("tid")
    )
    hit = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.tid") == F.col("r.tid"))
    rest = rows.alias("l").join(small(lost.drop("won")).alias("r"), hit, "left_anti").select("row")
    repeated = lost.filter("won")
    if not repeated.isEmpty():
        again = rows.alias("l").join(small(repeated).alias("r"), hit).select("l.*")
        rest = rest.unionByName(again.groupBy("doc_id", "tid").agg(F.first("row").alias("row")).select("row"))
    return rest.select(*[own(c).alias(c) for c in docs.columns])


def op5_minhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


OP5_SQL = r"""
with recursive w as (
  select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as i, len(ws) as n
  from (select doc_id, regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
        from documents)
),
win as (
  select doc_id, concat_ws(' ', w, lead(w, 1) over p, lead(w, 2) over p, lead(w, 3) over p, lead(w, 4) over p) as g,
         n < 5 and i = 1 or lead(w, 4) over p is not null as whole
  from w window p as (partition by doc_id order by i)
),
g as (select distinct doc_id, g from win where whole),
size as (select doc_id, count(*) as n from g group by 1),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from g a join g b using (g) where a.doc_id <> b.doc_id group by 1, 2),
links as (
  select x, y from common join size s on s.doc_id = x join size t on t.doc_id = y where 100 * c >= 75 * (s.n + t.n - c)
),
reach(doc_id, node) as (
  select doc_id, doc_id from documents union select r.doc_id, l.y from reach r join links l on l.x = r.node
),
label as (select doc_id, min(node) as component_id from reach group by 1)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join size using (doc_id) join label using (doc_id)
"""
