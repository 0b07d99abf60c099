r"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words with smallest period *q* and at least ``max(MIN_WORDS,
4 * q)`` words that no neighbouring word extends. ``collapse`` lists the runs of
every text and keeps the first period of each.

A batch of texts is one string over (text, word) letters, so nothing matches
across texts. At the scale ``t`` (a power of two) every position has the hash of its ``t``
words. Position *i* is in the synchronising set if the least hash of the positions
``i..i+t`` is that of *i* or of ``i+t``; positions in a highly periodic region
(``t`` words with a period of at most ``t/4``) have no hash. Membership
depends on the ``2t`` words after *i* only. For a run with ``t <= q < 2t``:

* some *s* among its first ``t`` positions is in the set. Otherwise its first ``3t-1`` words would
  lie in one highly periodic region, and by Fine and Wilf *q* would not be smallest;
* ``s + q`` is in the set too, with the same ``2t`` words, and these do not
  occur in between, for the same reason.

So it is enough to sort the set by these ``2t`` words: neighbours with equal context
at a distance in ``[t, 2t)`` propose that period, and the word by word
comparison ``w[i] == w[i+q]`` of that text gives the exact runs. Periods
below ``FIRST``, which no scale proposes, come from the highly periodic
regions found by that comparison over the whole batch. Runs of
all smaller scales mark the regions of the next.

There is no shuffle: memory is bounded by a slice of 2 MB of text or the longest text.

Cases: a null or empty text has no words, no run, and an empty collapsed text; rows that repeat
a text or ``doc_id`` are read one by one; a null ``doc_id`` stays null; an empty table gives
no rows; other columns are not read. In ``planted`` a null ``doc_id`` leaves the text as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm.common import SPACE, read_table, slices, text_column

MIN_WORDS = 6
FIRST = 8  # least period, and least scale, of the synchronising sets

U = np.uint64
NONE = U(0xFFFFFFFFFFFFFFFF)
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _after(x: np.ndarray, n: int, fill=U(0)) -> np.ndarray:
    """``x[i + n]`` at *i*; ``fill`` beyond the end."""
    out = np.full(len(x), fill, dtype=x.dtype)
    out[: max(len(x) - n, 0)] = x[n:]
    return out


def _doubled(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``2n`` words from those of ``n``."""
    return _mix(h * U(0x9E3779B97F4A7C15) + _after(h, n))


def periodic(w: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the maximal stretches of ``w`` that have period ``d`` and
    at least ``4 * d`` words."""
    equal = np.zeros(max(len(w) - d, 0) + 2, dtype=np.int8)
    equal[1:-1] = w[:-d] == w[d:]
    edge = np.flatnonzero(np.diff(equal))
    start, n = edge[::2], edge[1::2] - edge[::2]
    enough = n >= 3 * d
    return start[enough], n[enough] + d


def proposals(h: np.ndarray, twice: np.ndarray, regions: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances in ``[t, 2t)`` of neighbours in the synchronising set of scale
    ``t`` with equal context. ``h`` and ``twice`` are the hashes of ``t`` and ``2t`` words,
    ``regions`` marks highly periodic positions."""
    x = np.where(regions, NONE, h)
    least, n = x, 1
    while n < t:
        least, n = np.minimum(least, _after(least, n, NONE)), 2 * n
    least = np.minimum(least, _after(least, 1, NONE))
    chosen = np.flatnonzero((least != NONE) & ((least == x) | (least == _after(x, t, NONE))))
    context = twice[chosen]
    order = np.argsort(context, kind="stable")
    context, chosen = context[order], chosen[order]
    d = chosen[1:] - chosen[:-1]
    hit = (context[1:] == context[:-1]) & (d >= t) & (d < 2 * t)
    return chosen[:-1][hit], d[hit]


def find_runs(w: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Runs of the texts ``w[offsets[k]:offsets[k + 1]]`` (word numbers) as rows ``text, start,
    length, period``, ordered by text, start, period."""
    sizes = np.diff(offsets)
    letters = np.repeat(np.arange(len(sizes), dtype=np.int64) << 32, sizes) + w
    start, length, period = [], [], []

    def note(where: int, part: np.ndarray, d: int) -> None:
        s, n = periodic(part, d)
        start.append(s + where)
        length.append(n)
        period.append(np.full(len(s), d, dtype=np.int64))

    for d in range(1, FIRST):
        note(0, letters, d)
    at, h, t = np.arange(len(letters)), _mix(letters.astype(U)), 1
    while t < FIRST:
        h, t = _doubled(h, t), 2 * t
    while (sizes >= 4 * t).any():
        stay = np.repeat(sizes >= 4 * t, sizes)  # texts that can hold a run of this scale
        at, h, sizes = at[stay], h[stay], sizes[sizes >= 4 * t]
        marks = np.zeros(len(letters) + 1, dtype=np.int64)
        for s, n, d in zip(start, length, period):
            small = (4 * d <= t) & (n >= t)
            np.add.at(marks, s[small], 1)
            np.add.at(marks, s[small] + n[small] - t + 1, -1)
        twice = _doubled(h, t)
        place, distance = proposals(h, twice, np.cumsum(marks)[at] > 0, t)
        text = np.searchsorted(offsets, at[place], side="right") - 1
        for k, d in np.unique(np.stack([text, distance], axis=1), axis=0).tolist():
            note(offsets[k], letters[offsets[k] : offsets[k + 1]], d)
        h, t = twice, 2 * t

    start, length, period = map(np.concatenate, (start, length, period))
    # a stretch found with a multiple of its period has the same ends
    order = np.lexsort((period, length, start))
    order = order[_first(start[order], length[order]) & (length[order] >= MIN_WORDS)]
    order = order[np.lexsort((period[order], start[order]))]
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(offsets, start, side="right") - 1
    return np.stack([text, start - offsets[text], length, period], axis=1)


def _first(*keys: np.ndarray) -> np.ndarray:
    """True at rows that differ from the row before."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def collapse(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id, n_words``, the ``runs`` by start and period, and ``collapsed``, the words
    that no run contains after its first period, joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [(x or "").encode().split() for x in text_column(b).to_pylist()]  # at 0x20, 0x09 to 0x0D
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
            words = pa.array([x for one in texts for x in one], pa.binary()).dictionary_encode()
            rows = find_runs(words.indices.to_numpy().astype(np.int64), offsets)
            cut = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
            found, kept = [], []
            for k, own in enumerate(texts):
                runs = rows[cut[k] : cut[k + 1], 1:].tolist()
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                if runs:
                    stays = np.zeros(len(own) + 1, dtype=np.int64)
                    for s, n, p in runs:
                        stays[s + p] += 1
                        stays[s + n] -= 1
                    own = [own[i] for i in np.flatnonzero(np.cumsum(stays[:-1]) == 0).tolist()]
                kept.append(b" ".join(own).decode())
            struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(offsets)), pa.array(found, pa.list_(struct)), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, SCHEMA)


def planted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, text``: with h the CRC-32 of the decimal ``doc_id`` and g its tenth, texts with
    ``h % 10 = 0`` repeat, from word ``g % n`` on, the words before the fitting
    period; the others are unchanged."""
    d, t = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    g = F.floor(F.crc32(d.cast("string").cast("binary")) / 10)
    words = docs.select(
        d.alias("doc_id"), t.alias("text"), g.alias("g"),
        F.when(F.crc32(d.cast("string").cast("binary")) % 10 == 0, F.filter(F.split(t, SPACE), lambda w: w != "")).alias("w"),
    )
    n = F.size("w")
    a = F.pmod("g", n)
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    words = words.select(
        "doc_id", "text", "w", F.when(n > 0, a.cast("int")).alias("a"), F.when(n > 0, p.cast("int")).alias("p")
    )
    again = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return words.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(again, " ")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document with planted periods: their number, the one with the
    greatest exponent, and digests of all runs and of the collapsed text."""
    out = collapse(planted(read_table(spark, sf_dir, "documents")))
    best = F.reduce(
        "runs", F.get("runs", F.lit(0)),
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    out = out.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat(*[F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")]).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
