"""Removal of repeated byte strings by merging shard Burrows-Wheeler transforms.

Every byte covered by a ``LENGTH``-byte string that starts at two or more places
(texts are UTF-8 bytes, strings do not cross documents) is removed.

1.  *Deal.* Each ``LENGTH``-byte window belongs to the ``ANCHOR``-byte gram with the
    smallest hash inside it. Windows in a row with one anchor form a string of
    at most ``2 * LENGTH - ANCHOR`` bytes. Equal windows have equal anchors, so
    strings with different anchors never share a window, and each group of
    strings with one anchor can be settled alone. Anchors seen once drop out
    by count; equal strings of a group are one string with a count.
2.  *Shards.* A task packs whole groups into batches, splits a batch into
    shards, and builds the BWT of each (over the rotations of every string
    and its end mark).
3.  *Merge.* Two BWTs are merged by refining their interleave: at depth *d* a
    row's block says which *d* symbols it starts with, in either shard. The
    successor map of a BWT (the inverse of LF) composed with itself gives the
    row *d* symbols on, so the pair of the two blocks is the block at depth
    *2d*. The rows of either shard are already in order, so a round merges two
    sorted runs of block numbers; no suffix is sorted again. A boundary that
    appears in the round to depth *2d* marks a common prefix of *d* to *2d - 1*
    symbols. Blocks at depth ``LENGTH`` with two rows are the repeated intervals.
4.  *Spans.* The repeated windows of a string give its covered bytes, which are
    united by document.

A group of more than ``HOT`` different strings is not gathered in one task: its
windows are dealt once more, each by its own content (an anchor of
``LENGTH`` bytes), counted with map-side combine.

Documents are known by the 64-bit hash of their text under a seed that is checked
to be free of collisions. Windows and grams are told apart by 64-bit hashes in
step 1 only to deal them out; equality of strings rests on two independent 64-bit
hashes (anchor and string), the windows of step 3 on their bytes.

Cases: a null text has no bytes; short texts, and empty ones, lose nothing; a
null ``doc_id`` and repeated rows are rows like others (a repeated text of
``LENGTH`` bytes or more is removed whole in all rows); an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm.common import raw, read_table, slices, small, stored, text_column

LENGTH = 200
ANCHOR = 64
HOT = 20_000
SHIFT = 20  # a place is start << SHIFT | length
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
SEGMENT = 1 << 22


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Anchors:
    """Cuts byte texts into strings of windows with one anchor."""

    def __init__(self, length: int = LENGTH, anchor: int = ANCHOR):
        self.length, self.anchor = length, anchor
        self.powers = self.inverses = np.ones(1, dtype=U)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            for name, base in (("powers", BASE), ("inverses", U(pow(int(BASE), -1, 1 << 64)))):
                table = np.full(2 * n + 1, base, dtype=U)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def _sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, dtype=U)
        np.cumsum((data.astype(U) + U(1)) * self.powers[: len(data)], out=sums[1:])
        return sums

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Hash of every window of ``length`` bytes."""
        sums = self._sums(data)
        n = len(data) - self.length + 1
        return _mix((sums[self.length :] - sums[:n]) * self.inverses[:n])

    def cut(self, data: np.ndarray, offsets: np.ndarray):
        """(anchor hash, string hash, row, start in the row, length) of every string."""
        size, k = self.length, self.anchor
        n = len(data) - size + 1
        if n <= 0:
            return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
        sums = self._sums(data)
        grams = _mix((sums[k:] - sums[:-k]) * self.inverses[: len(data) - k + 1])
        places = U((1 << 24) - 1)  # smallest hash, then leftmost; chunks are below 2^24 bytes
        low = (grams & ~places) | np.arange(len(grams), dtype=U)
        span, width = 1, size - k + 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if width > span:
            low = np.minimum(low[: -(width - span)], low[width - span :])
        at = (low & places).astype(np.int64)
        across = np.zeros(len(data) + 2, dtype=np.int64)  # windows that leave their row
        begins, ends = offsets[:-1], offsets[1:]
        np.add.at(across, np.maximum(begins, ends - size + 1), 1)
        np.add.at(across, ends, -1)
        inside = np.cumsum(across)[:n] == 0
        new = inside.copy()
        new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
        first = np.flatnonzero(new)
        stop = inside.copy()
        stop[:-1] &= (at[1:] != at[:-1]) | ~inside[1:]
        last = np.flatnonzero(stop) + size
        row = np.searchsorted(offsets, first, side="right") - 1
        length = last - first
        strings = _mix((sums[last] - sums[first]) * self.inverses[first] + length.astype(U))
        return grams[at[first]].view(np.int64), strings.view(np.int64), row, first - offsets[row], length

    def texts(self, data: np.ndarray, offsets: np.ndarray):
        """``cut`` for texts of any length: a long one in segments that share a window's overlap."""
        if len(data) <= SEGMENT:
            yield self.cut(data, offsets)
            return
        for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            for s in range(a, max(b - self.length + 1, a), SEGMENT):
                part = data[s : min(b, s + SEGMENT + self.length - 1)]
                h, sh, row, start, length = self.cut(part, np.array([0, len(part)]))
                yield h, sh, row + r, start + (s - a), length


class Once:
    """True for the first ``times`` sights of a value (of the last million)."""

    def __init__(self, times: int):
        self.times, self.seen = times, {}

    def __call__(self, value: int) -> bool:
        if len(self.seen) > 1_000_000:
            self.seen = {}
        n = self.seen.get(value, 0)
        self.seen[value] = n + 1
        return n < self.times


def dealt(base: DataFrame) -> DataFrame:
    """``h, sh, rid, at`` of every string of every text. A task sends a text that
    it sees many times twice, which is enough to count it as repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, fresh = Anchors(), Once(2)
        for b in slices(batches, max_bytes=1 << 18):
            b = b.filter(pa.array([fresh(r) for r in b.column(0).to_pylist()], pa.bool_()))
            if not b.num_rows:
                continue
            rid = b.column(0).to_numpy()
            for h, sh, row, start, length in anchors.texts(*raw(text_column(b))):
                if len(h):
                    cols = [h, sh, rid[row], start << SHIFT | length]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h", "sh", "rid", "at"])

    return base.select("rid", "text").mapInArrow(run, "h long, sh long, rid long, at long")


# -- Burrows-Wheeler transforms ---------------------------------------------------------


class Bwt:
    """BWT of strings, each with an end mark (symbol 0; byte *x* is symbol *x* + 1).

    A row is a rotation of one string; ``string`` and ``place`` say where it starts."""

    def __init__(self, symbols: np.ndarray, string: np.ndarray, place: np.ndarray, block: np.ndarray | None = None):
        self.symbols, self.string, self.place, self.block = symbols, string, place, block

    @staticmethod
    def of(strings: list[bytes], first: int, depth: int) -> "Bwt":
        """Rows ordered by their first ``depth`` symbols (prefix doubling)."""
        lengths = np.array([len(s) + 1 for s in strings], dtype=np.int64)
        begins = np.cumsum(lengths) - lengths
        text = np.zeros(int(lengths.sum()), dtype=np.int64)
        mark = np.zeros(len(text), dtype=bool)
        mark[begins + lengths - 1] = True
        text[~mark] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + 1
        string = np.repeat(np.arange(len(strings)), lengths)
        begin, length = begins[string], lengths[string]
        place = np.arange(len(text)) - begin

        def ahead(d: int) -> np.ndarray:
            p = place + d
            return begin + np.where(p >= length, p % length, p)

        key = np.zeros(len(text), dtype=np.int64)
        d = min(7, depth)
        for j in range(d):
            key = key << 9 | text[ahead(j)]
        while True:
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            rank = np.empty(len(text), dtype=np.int64)
            rank[order] = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]]))
            if d >= depth:
                break
            step = min(d, depth - d)
            key = rank * len(text) + rank[ahead(step)]
            d += step
        before = np.where(place[order] == 0, begin[order] + length[order] - 1, order - 1)
        return Bwt(text[before].astype(np.uint16), string[order] + first, place[order], rank[order])

    def successors(self) -> np.ndarray:
        """Row of the rotation that starts one symbol later (the inverse of LF)."""
        return np.argsort(self.symbols, kind="stable")


def _joint(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense common numbers of two sorted key sequences."""

    def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.ones(len(x), dtype=bool)
        new[1:] = x[1:] != x[:-1]
        return x[new], np.cumsum(new) - 1

    (ua, ra), (ub, rb) = runs(a), runs(b)
    to_b = np.searchsorted(ub, ua)
    both = (to_b < len(ub)) & (ub[np.minimum(to_b, len(ub) - 1)] == ua)
    na = np.arange(len(ua)) + to_b - (np.cumsum(both) - both)
    shared = np.zeros(len(ub), dtype=bool)
    shared[to_b[both]] = True
    to_a = np.searchsorted(ua, ub)
    nb = np.arange(len(ub)) + to_a - (np.cumsum(shared) - shared)
    return na[ra], nb[rb]


def merge(a: Bwt, b: Bwt, depth: int) -> Bwt:
    """The BWT of both, by refining the interleave to ``depth`` symbols."""
    sa, sb = a.successors(), b.successors()
    ka, kb = a.symbols[sa].astype(np.int64), b.symbols[sb].astype(np.int64)  # first symbols
    ka, kb = _joint(ka, kb)
    d, ja, jb = 1, sa, sb  # j: the row d symbols on
    powers = [(1, sa, sb)]
    while d < depth:
        step = min(d, depth - d)
        if step < d:  # the last round overlaps: compose the way from known powers
            ja, jb, rest = None, None, step
            for p, pa_, pb_ in reversed(powers):
                if rest >= p:
                    ja, jb = (pa_, pb_) if ja is None else (pa_[ja], pb_[jb])
                    rest -= p
        width = int(max(ka[-1], kb[-1])) + 1
        ka, kb = _joint(ka * width + ka[ja], kb * width + kb[jb])
        d += step
        if d < depth:
            ja, jb = ja[ja], jb[jb]
            powers.append((d, ja, jb))
    # interleave: rows of a before rows of b in a block
    width = int(max(ka[-1], kb[-1])) + 1
    in_a, in_b = np.bincount(ka, minlength=width), np.bincount(kb, minlength=width)
    to_a = np.arange(len(ka)) + (np.cumsum(in_b) - in_b)[ka]
    to_b = np.arange(len(kb)) + np.cumsum(in_a)[kb]

    def laid(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.empty(len(x) + len(y), dtype=x.dtype)
        out[to_a], out[to_b] = x, y
        return out

    return Bwt(laid(a.symbols, b.symbols), laid(a.string, b.string), laid(a.place, b.place), laid(ka, kb))


def repeated_windows(strings: list[bytes], depth: int = LENGTH, shards: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of every window of ``depth`` bytes that occurs twice in ``strings``."""
    per = -(-len(strings) // max(1, min(shards, len(strings))))
    parts = [Bwt.of(strings[i : i + per], i, depth) for i in range(0, len(strings), per)]
    while len(parts) > 1:
        parts = [merge(*parts[i : i + 2], depth) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    whole = parts[0]
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    valid = whole.place <= lengths[whole.string] - depth
    many = np.bincount(whole.block)[whole.block] >= 2
    return whole.string[valid & many], whole.place[valid & many]


def covered(starts: np.ndarray, length: int = LENGTH) -> tuple[list[int], list[int]]:
    """Maximal covered runs of windows that begin at ``starts``."""
    s = np.sort(starts)
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:] > s[:-1] + length
    last = np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)
    return s[new].tolist(), (s[last] + length).tolist()


PARTIAL = "h long, sh long, lo array<long>, hi array<long>"


def settled(strings: DataFrame, batch_bytes: int = 1 << 20) -> DataFrame:
    """``strings(h, sh, bytes)`` -> covered runs of the strings that share a window
    with another string of their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch: list[tuple[int, int, bytes]] = []
        group: list[tuple[int, int, bytes]] = []
        size = 0

        def settle() -> pa.RecordBatch | None:
            if not batch:
                return None
            # alternate, so that the members of a group lie in different shards
            order = batch[0::2] + batch[1::2]
            which, start = repeated_windows([x[2] for x in order])
            by = np.argsort(which, kind="stable")
            which, start = which[by], start[by]
            cut = np.flatnonzero(np.diff(which)) + 1
            rows = []
            for w, s in zip(which[np.concatenate([[0], cut])] if len(which) else [], np.split(start, cut)):
                rows.append((order[w][0], order[w][1], *covered(s)))
            if not rows:
                return None
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["h", "sh", "lo", "hi"])

        def close() -> int:
            if len(group) < 2:
                return 0
            batch.extend(group)
            return sum(len(x[2]) for x in group)

        for b in batches:
            for h, sh, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                if group and group[-1][0] != h:
                    size += close()
                    group = []
                    if size >= batch_bytes:
                        out = settle()
                        batch, size = [], 0
                        if out is not None:
                            yield out
                if not group or group[-1][1] != sh:  # copies of a text send a string again
                    group.append((h, sh, data))
        close()
        out = settle()
        if out is not None:
            yield out

    return strings.repartition("h").sortWithinPartitions("h", "sh").mapInArrow(run, PARTIAL)


def settled_hot(strings: DataFrame) -> DataFrame:
    """As ``settled``, for groups too large for one task: windows dealt by content."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for b in batches:
            for h, sh, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                w = anchors.windows(np.frombuffer(data, dtype=np.uint8)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w), pa.array(np.full(len(w), h)), pa.array(np.full(len(w), sh)), pa.array(np.arange(len(w)))],
                    names=["w", "h", "sh", "start"],
                )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = [covered(np.array(x, dtype=np.int64)) for x in b.column(2).to_pylist()]
            lists = [pa.array(c, pa.list_(pa.int64())) for c in zip(*ends)] if ends else [pa.array([], pa.list_(pa.int64()))] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists], names=["h", "sh", "lo", "hi"])

    rows = strings.dropDuplicates(["h", "sh"]).mapInArrow(explode, "w long, h long, sh long, start long")
    many = rows.groupBy("h", "w").agg(F.count("*").alias("n")).filter("n >= 2").select("h", "w")
    hits = rows.join(many, ["h", "w"], "left_semi")
    return hits.groupBy("h", "sh").agg(F.collect_set("start").alias("s")).mapInArrow(runs, PARTIAL)


# -- the operator ------------------------------------------------------------------------


def numbered(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``doc_id, rid, text`` with a text number that is checked to be unique."""
    t = F.coalesce(F.col(text), F.lit(""))
    for seed in range(64):
        rid = F.xxhash64(t, F.lit(seed))
        clash = docs.select(rid.alias("rid"), F.md5(t).alias("d")).groupBy("rid").agg(F.min("d").alias("a"), F.max("d").alias("b"))
        if clash.filter("a <> b").isEmpty():
            return docs.select(F.col(doc_id).alias("doc_id"), rid.alias("rid"), t.alias("text"))
    raise RuntimeError("no seed without a collision")


def _start(at: str) -> Column:
    return F.shiftright(F.col(at), SHIFT)


def _end(at: str) -> Column:
    return F.shiftright(F.col(at), SHIFT) + F.col(at).bitwiseAND(F.lit((1 << SHIFT) - 1))


def _one_of_each(rows: DataFrame) -> DataFrame:
    """A task's repeated texts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = Once(1)
        for b in batches:
            yield b.filter(pa.array([fresh(r) for r in b.column(0).to_pylist()], pa.bool_()))

    return rows.select("rid", "text").mapInArrow(run, "rid long, text string")


def spans(base: DataFrame, hot: int = HOT) -> DataFrame:
    """``rid, runs``: covered byte runs ``(s, e)`` of every text that has any (they may overlap)."""
    occurrences = dealt(base)
    seen = occurrences.groupBy("h").agg(F.count("*").alias("n"), F.min("sh").alias("lo"), F.max("sh").alias("hi"))
    again = seen.filter("n >= 2").select("h", F.expr("lo = hi").alias("same"))
    rows = stored(occurrences.join(again, "h"), "suffix-rows")

    strings = stored(
        rows.filter("not same").groupBy("h", "sh").agg(F.count("*").alias("n"), F.min(F.struct("rid", "at")).alias("x"))
        .select("h", "sh", "n", "x.rid", "x.at"),
        "suffix-strings",
    )
    large = stored(strings.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("h"), "suffix-hot")
    wanted = strings.groupBy("rid").agg(F.collect_list(F.struct("h", "sh", "at")).alias("cuts"))  # one text's strings
    texts = _one_of_each(base.join(small(strings.select("rid").distinct(), 1_000_000), "rid", "left_semi"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for text, cuts in zip(text_column(b).cast(pa.large_binary()).to_pylist(), b.column(1).to_pylist()):
                at = [(c["at"] >> SHIFT, c["at"] & ((1 << SHIFT) - 1)) for c in cuts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c["h"] for c in cuts], pa.int64()), pa.array([c["sh"] for c in cuts], pa.int64()),
                     pa.array([text[s : s + n] for s, n in at], pa.binary())],
                    names=["h", "sh", "bytes"],
                )

    content = texts.join(wanted, "rid").select("text", "cuts").mapInArrow(extract, "h long, sh long, bytes binary")
    if large.isEmpty():
        partial = settled(content)
    else:
        content = stored(content, "suffix-content")
        many = small(large, 1_000_000)
        partial = settled(content.join(many, "h", "left_anti")).unionByName(settled_hot(content.join(many, "h", "left_semi")))

    whole = rows.filter("same").select("rid", _start("at").alias("s"), _end("at").alias("e"))
    copies = rows.filter("not same").join(strings.filter("n >= 2").select("h", "sh"), ["h", "sh"], "left_semi")
    copies = copies.select("rid", _start("at").alias("s"), _end("at").alias("e"))
    single = strings.filter("n = 1").join(partial, ["h", "sh"]).select(
        "rid", _start("at").alias("base"), F.explode(F.arrays_zip("lo", "hi")).alias("r")
    ).select("rid", (F.col("base") + F.col("r.lo")).alias("s"), (F.col("base") + F.col("r.hi")).alias("e"))
    out = whole.unionByName(copies).unionByName(single)
    return out.groupBy("rid").agg(F.collect_set(F.struct("s", "e")).alias("runs"))


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of every row."""
    base = numbered(docs, text, doc_id).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = stored(spans(base, hot), "suffix-spans")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for doc, text_, runs in zip(b.column(0).to_pylist(), text_column(b).cast(pa.large_binary()).to_pylist(), b.column(2).to_pylist()):
                kept, at, n, end = [], 0, 0, -1
                for s, e in sorted((r["s"], r["e"]) for r in runs):
                    if s > end:
                        n += 1
                        kept.append(text_[at:s])
                    end = max(end, e)
                    at = end
                kept.append(text_[at:])
                rest = b"".join(kept)
                out.append((doc, len(text_), len(text_) - len(rest), n, rest))
            types = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    rids = small(found.select("rid"), 1_000_000)
    hit = base.join(rids, "rid", "left_semi").join(found, "rid").select("doc_id", "text", "runs").mapInArrow(apply, KEPT)
    rest = base.join(rids, "rid", "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"),
    )
    return rest.unionByName(hit)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that occur elsewhere."""
    return remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


OP10_SQL = r"""
with d as (select doc_id, encode(coalesce(text, '')) as b, octet_length(encode(coalesce(text, ''))) as n from documents),
s as (select doc_id, b, unnest(range(0, greatest(n - 199, 0))) as s from d),
many as (select doc_id, s from (select doc_id, s, count(*) over (partition by md5(array_slice(b, s + 1, s + 200))) as c from s) where c > 1),
marked as (select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 200 then 0 else 1 end as new from many),
runs as (
  select doc_id, min(s) as a, max(s) + 200 as e
  from (select doc_id, s, sum(new) over (partition by doc_id order by s) as r from marked) group by doc_id, r
),
gaps as (select doc_id, a, e, coalesce(lag(e) over (partition by doc_id order by a), 0) as z from runs),
cut as (
  select doc_id, sum(e - a) as n_removed, count(*) as n_spans, max(e) as last,
         string_agg(case when a > z then hex(array_slice(b, z + 1, a)) else '' end, '' order by a) as kept
  from gaps join d using (doc_id) group by 1
)
select doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(case when kept is null then b else unhex(kept || case when n > last then hex(array_slice(b, last + 1, n)) else '' end) end)
         as kept_sha256
from d left join cut using (doc_id)
"""
