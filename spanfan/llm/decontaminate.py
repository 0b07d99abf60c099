"""Benchmark decontamination by pigeonhole edit matching.

Texts are normalised (lower case, everything but letters and digits to one
space). An item of *m* characters may occur in a document with up to
``k = m * PERCENT / 100`` edits. It is cut into ``k + 1`` pieces: an occurrence
with at most *k* edits leaves one piece untouched, so every occurrence has an
exact piece hit at its place. All pieces of a block of items are found in one
pass with an Aho-Corasick automaton; around each hit, Myers' bit-parallel
algorithm gives the smallest edit distance between the item and any substring.
An item too short for an edit (under 20 characters at 5 %) occurs as whole words only:
"yes" is not in "eyes", but in every text with the word "yes".

The benchmark is the stated query set: it is read in blocks of at most
``BLOCK_CHARS`` characters, each block is broadcast (so its size is bounded)
and run against all documents, whose rows are never shuffled.

Cases: a null or empty text, and an item without letters or digits, match
nothing; repeated rows and items match each on their own; a null ``doc_id``
is carried along; other columns of ``docs`` are kept by ``clean`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm.common import read_table, slices, stored, text_column

PERCENT = 5
BLOCK_CHARS = 8_000_000
OTHER = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return OTHER.sub(" ", text.lower()).strip() if text else ""


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of near-equal length with their offsets."""
    n = k + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(smallest edit distance of the pattern to a substring of ``text``, its end)."""
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best, at = m, 0
    for i, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, at = score, i + 1
        ph <<= 1
        mh <<= 1
        pv = (mh | ~(xv | ph)) & mask
        mv = ph & xv & mask
    return best, at


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], percent: int = PERCENT):
        import ahocorasick

        self.items = []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normalise(text)
            if not text:
                continue
            k = len(text) * percent // 100
            peq: dict[str, int] = {}
            for i, c in enumerate(text):
                peq[c] = peq.get(c, 0) | 1 << i
            for offset, piece in pieces(text, k):
                found.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, text, k, peq))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, edits, end in the normalised text) of the best occurrence of each item."""
        if not self.items or not text:
            return []
        windows: dict[int, list[list[int]]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for i, offset in where:
                _, item, k, _ = self.items[i]
                lo = max(0, end + 1 - length - offset - k)
                hi = min(len(text), end + 1 - length - offset + len(item) + k)
                own = windows.setdefault(i, [])
                if own and lo <= own[-1][1] and lo >= own[-1][0]:
                    own[-1][1] = max(own[-1][1], hi)
                else:
                    own.append([lo, hi])
        out = []
        for i, own in windows.items():
            item_id, item, k, peq = self.items[i]
            if k == 0:  # a short item: whole words only
                at = f" {text} ".find(f" {item} ")
                if at >= 0:
                    out.append((item_id, 0, at + len(item)))
                continue
            best = min((d, lo + at) for lo, hi in own for d, at in [myers(peq, len(item), text[lo:hi])])
            if best[0] <= k:
                out.append((item_id, *best))
        return out


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", chars: int = BLOCK_CHARS) -> Iterator[list]:
    """The items in blocks of bounded size (a longer single item is a block)."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_id).cast("long"), F.coalesce(F.col(text), F.lit(""))).toLocalIterator():
        if block and size + len(row[1]) > chars:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1])
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, item_id, n_edits, end_char`` (in the normalised text) for every document
    that holds an item within its error budget."""
    schema = "doc_id long, item_id long, n_edits long, end_char long"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spark, out, parts = docs.sparkSession, None, blocks(benchmark)
    block = next(parts, None)
    while block is not None:
        after = next(parts, None)
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for b in slices(batches):
                found = [
                    (doc, *m)
                    for doc, t in zip(b.column(0).to_pylist(), text_column(b).to_pylist())
                    for m in matcher(normalise(t))
                ]
                if found:
                    cols = [pa.array(c, pa.int64()) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "n_edits", "end_char"])

        part = rows.mapInArrow(run, schema)
        if out is not None or after is not None:  # of many blocks, one at a time is held
            part = stored(part, "decontaminate-matches")
            shared.destroy()
        out = part if out is None else out.unionByName(part)
        block = after
    return out if out is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no item, with their own columns."""
    names, position = docs.columns, docs.columns.index(text)
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])  # a row passes through Arrow by position
    parts = blocks(benchmark)
    block, first = next(parts, None), True
    while block is not None:
        after = next(parts, None)
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for batch in batches:
                texts = pa.RecordBatch.from_arrays([batch.column(position)], names=["text"])
                free = [not matcher(normalise(t)) for part in slices([texts]) for t in text_column(part).to_pylist()]
                yield batch.filter(pa.array(free, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if not first or after is not None:
            docs = stored(docs, "decontaminate-clean")
            shared.destroy()
        block, first = after, False
    return docs.toDF(*names)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item, with the item and its edits."""
    return matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
