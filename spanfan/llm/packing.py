"""Sum-of-squares online packing of documents into fixed token windows.

A document becomes its token ids plus one end id. Full windows are cut off
its front; what is left (less than a window) is placed online: among all
fill levels that have room, and a new window, take the one that makes the
sum over levels of (number of partly filled windows at that level) ** 2
smallest. The counts live in one level array per task. Windows that become
full are emitted. At the end of a task, or when more than ``max_open``
windows are open, the open ones are laid end to end and cut at the capacity,
and the very last rest is cut into powers of two, which need no padding. So
padding is zero whatever the number of tasks.

There is no shuffle: a task packs the rows of one input split, so a lost
executor costs its own splits only, and memory is bounded by ``max_open``
windows plus one batch.

Cases: a null or empty text has only the end id; a null or repeated
``doc_id`` is packed like any other row (one set of pieces per row); an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import struct
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm.common import raw, read_table, slices, text_column

CAPACITY = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Tokens:
    """Token ids of texts as little-endian uint32 bytes.

    The tokenizer drops white space and never joins across it, nor across the place where a mark follows a letter, so ids
    are kept per run between blanks, line ends and such places. Texts that are all
    in Latin-1 are put in lower case first, as the tokenizer would. ``_runs`` does both with numpy over the
    bytes of a slice, Arrow tells the runs apart, and numpy gathers the ids of the different ones.
    New runs of Latin-1 letters in lower case are encoded many at a time, joined by blanks: each is one
    word of the tokenizer, whose last token ends a word, and is in normal form
    already, so only the tokenizer's byte form and model are applied. Texts with what may be a special token are
    encoded whole.

    The kept ids stay with the worker process from task to task, in a module of their
    own; beyond ``max_bytes`` (their own size with Python's overhead, as estimated by ``COST``)
    or ``max_words`` runs they start anew. Results do not depend on what is kept.
    """

    AT_ONCE = 4096
    COST = 150  # bytes of one entry beside its characters and ids: two object heads and a dict slot
    MARK = np.isin(np.arange(256), list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))

    def __init__(self, path: str, max_words: int = 400_000, max_bytes: int = 64 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        holder = sys.modules.setdefault("spanfan_kept_token_ids", types.ModuleType("spanfan_kept_token_ids"))
        kept = holder.__dict__.setdefault("by_path", {})  # outlives the task: this package travels by value
        if path not in kept:
            kept[path] = *self._open(path), {"": b""}, [0]
        self.tokenizer, self.letters, self.ends, self.known, self.bytes = kept[path]
        self.max_words, self.max_bytes = max_words, max_bytes

    @staticmethod
    def _open(path: str):
        """The tokenizer, its byte form and model alone behind a split at blanks, and which ids end a word."""
        import tokenizers

        whole = tokenizers.Tokenizer.from_file(path)
        letters = tokenizers.Tokenizer(whole.model)
        split = tokenizers.pre_tokenizers
        letters.pre_tokenizer = split.Sequence([split.WhitespaceSplit(), split.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = np.zeros(whole.get_vocab_size(), dtype=bool)
        suffix = whole.model.end_of_word_suffix
        if suffix:
            ends[[i for t, i in whole.get_vocab().items() if t.endswith(suffix)]] = True
        return whole, letters, ends

    def _runs(self, texts: pa.Array) -> pa.Array:
        """The texts with line ends as blanks, Latin-1 ones in lower case, and a blank between a letter and a mark."""
        data, offsets = raw(texts)
        data = np.where(data == 10, np.uint8(32), data)
        before = np.concatenate([[np.uint8(0)], data[:-1]])  # a text starts with a whole character, never with half of one
        beyond = np.concatenate([[0], np.cumsum(data >= 0xC4)])[offsets]
        latin = np.repeat(beyond[1:] == beyond[:-1], np.diff(offsets))
        second = before == 0xC3  # of the two bytes of U+00C0 to U+00FF
        upper = (data >= 65) & (data <= 90) | second & (data <= 0x9E) & (data != 0x97)
        data = np.where(upper & latin, data + np.uint8(32), data)
        letter = ((data | np.uint8(32)) - np.uint8(97) < 26) | second & (data != 0x97) & (data != 0xB7)
        cut = np.zeros(len(data) + 1, dtype=np.int64)  # blanks before a byte
        cut[1:-1] = letter[:-1] & self.MARK[data[1:]]
        cut[offsets] = 0
        cut = np.cumsum(cut)
        out = np.full(len(data) + int(cut[-1]), 32, dtype=np.uint8)
        out[np.arange(len(data)) + cut[:-1]] = data
        return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((offsets + cut[offsets]).astype(np.int64)), pa.py_buffer(out))

    def _keep(self, words: list[str], ids: list[bytes]) -> None:
        self.known.update(zip(words, ids))
        self.bytes[0] += self.COST * len(words) + sum(map(len, words)) + sum(map(len, ids))

    def _encoded(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in encoded]

    def _joined(self, words: list[str]) -> None:
        """Words of Latin-1 letters in lower case."""
        for at in range(0, len(words), self.AT_ONCE):
            some = words[at : at + self.AT_ONCE]
            ids = np.array(self.letters.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = 4 * np.flatnonzero(self.ends[ids]) + 4
            if len(cuts) != len(some):  # a tokenizer without word ends
                self._keep(some, self._encoded(some))
                continue
            flat, stops = ids.tobytes(), cuts.tolist()
            self._keep(some, [flat[a:b] for a, b in zip([0, *stops], stops)])

    def _learn(self, new: list[str]) -> None:
        """Runs that are not known yet."""
        plain = [w for w in new if w.isalpha() and w.islower() and max(w) <= "\xff"]
        rest = list(set(new).difference(plain)) if len(plain) < len(new) else []
        self._joined(plain)
        self._keep(rest, self._encoded(rest))

    def __call__(self, texts: pa.Array | list[str]) -> list[bytes]:
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        special = pc.match_substring(texts, "<|")
        if pc.any(special).as_py():
            whole = iter(self._encoded(texts.filter(special).to_pylist()))
            rest = iter(self(texts.filter(pc.invert(special))))
            return [next(whole if x else rest) for x in special.to_pylist()]
        cut = pc.split_pattern(self._runs(texts), " ")
        runs = cut.flatten().dictionary_encode()
        names, known = runs.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        ids = list(map(known.get, names))
        new = [w for w, x in zip(names, ids) if x is None]
        if new:
            if len(known) > self.max_words or self.bytes[0] > self.max_bytes:
                known.clear()
                known[""], self.bytes[0] = b"", 0
                new = [w for w in names if w]
            self._learn(new)
            ids = [known[w] if x is None else x for w, x in zip(names, ids)]
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        start, at = np.cumsum(size) - size, runs.indices.to_numpy()
        n = size[at]
        end = np.cumsum(n)
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        out = flat[np.arange(n.sum()) + np.repeat(start[at] - (end - n), n)].tobytes()
        cuts = (4 * np.append(0, end)[np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy()))]).tolist()
        return [out[x:y] for x, y in zip(cuts, cuts[1:])]


class SumOfSquares:
    """Online packer; ``add`` and ``finish`` yield closed windows, each a list
    of pieces (row, start, length, ids, doc_tokens)."""

    def __init__(self, capacity: int = CAPACITY, max_open: int = 2048):
        self.capacity = capacity
        self.max_open = max_open
        self.levels = np.zeros(capacity + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def choose(self, r: int) -> int:
        """Level to place ``r`` tokens on; 0 is a new window."""
        n = self.levels
        best, cost = 0, 2 * int(n[r]) + 1
        at = np.flatnonzero(n[1 : self.capacity - r + 1]) + 1
        if len(at):
            change = 2 * (n[at + r] - n[at]) + 2
            if at[-1] + r == self.capacity:  # a full window leaves the count
                change[-1] = 1 - 2 * n[at[-1]]
            i = len(at) - 1 - int(np.argmin(change[::-1]))  # of equals the fullest
            if change[i] <= cost:
                best = int(at[i])
        return best

    def add(self, row, ids: bytes) -> Iterator[list]:
        n, cap = len(ids) // 4, self.capacity
        whole = n - n % cap
        for s in range(0, whole, cap):
            yield [(row, s, cap, ids[4 * s : 4 * (s + cap)], n)]
        r = n - whole
        if not r:
            return
        level = self.choose(r)
        if level:
            window = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append((row, whole, r, ids[4 * whole :], n))
        if level + r == cap:
            yield window
        else:
            self._put(level + r, window)
            if self.n_open > self.max_open:
                yield from self._merge()

    def _put(self, level: int, window: list) -> None:
        self.open.setdefault(level, []).append(window)
        self.levels[level] += 1
        self.n_open += 1

    def _merge(self) -> Iterator[list]:
        """Lay the open windows end to end, cut full ones, keep the rest open."""
        pieces = [p for level in sorted(self.open, reverse=True) for w in self.open[level] for p in w]
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        window, room = [], self.capacity
        for piece in pieces:
            while piece[2] >= room:
                head, piece = _cut(piece, room)
                window.append(head)
                yield window
                window, room = [], self.capacity
                if piece is None:
                    break
            if piece is not None:
                window.append(piece)
                room -= piece[2]
        if window:
            self._put(self.capacity - room, window)

    def finish(self) -> Iterator[list]:
        yield from self._merge()
        rest = [p for ws in self.open.values() for w in ws for p in w]
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        left = sum(p[2] for p in rest)
        while left:
            size = 1 << (left.bit_length() - 1)  # a power of two is not padded
            window, need = [], size
            while need:
                piece = rest.pop(0)
                if piece[2] > need:
                    piece, tail = _cut(piece, need)
                    rest.insert(0, tail)
                window.append(piece)
                need -= piece[2]
            yield window
            left -= size


def _cut(piece: tuple, n: int) -> tuple:
    row, start, length, ids, total = piece
    head = (row, start, n, ids[: 4 * n], total)
    return head, None if n == length else (row, start + n, length - n, ids[4 * n :], total)


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids`` (uint32, little-endian),
    ``doc_tokens, sequence_id, offset``."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = Tokens(path), SumOfSquares(capacity)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 33
        rows, held = [], 0

        def table() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        def windows():
            for part in slices(batches):
                ids = tokens(text_column(part).fill_null(""))
                for row, x in zip(part.column(0).to_pylist(), ids):
                    yield from packer.add(row, x + end)
            yield from packer.finish()

        for window in windows():
            at = 0
            for row, start, length, ids, total in window:
                rows.append((row, start, length, ids, total, sequence, at))
                at += length
            held += at
            sequence += 1
            if held >= 1 << 20:
                yield table()
                rows, held = [], 0
        if rows:
            yield table()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with the checksum of their ids."""
    pieces = pack(read_table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
